"""Readers for landed text files, JSON pages and tables."""

"""Relational operators built from DataFrame calls."""

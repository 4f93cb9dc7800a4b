"""Paths of the fixture files and help with files (a module of its own: there are two conftest.py)."""

import glob
import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def fx(*parts):
    return os.path.join(FIXTURES, *parts)


def spoil(path):
    """Make the data of files unreadable; from outside, and in their footers, they look unchanged."""
    for name in glob.glob(f"{path}/*.parquet"):
        size, times = os.path.getsize(name), os.stat(name)
        with open(name, "r+b") as out:
            out.seek(size - 8)
            footer = int.from_bytes(out.read(4), "little")
            out.seek(4)
            out.write(b"\xff" * (size - 12 - footer))
        os.utime(name, ns=(times.st_atime_ns, times.st_mtime_ns))
        check = f"{path}/.{os.path.basename(name)}.crc"
        if os.path.exists(check):
            os.remove(check)

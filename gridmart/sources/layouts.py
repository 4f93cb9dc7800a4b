"""Which header line each text file has, from the first bytes of the file only.

A scan by name needs every file's layout before it reads a cell.  The index holds
one row for each file: path, length and modification time (the key), and the first line that
is not blank.  A file whose key is in the index is not opened again; of a new or
changed one the driver opens the head through Hadoop's file system, as it does
for listing, many at a time, and writes the lines it finds in bounded groups.  So a scan
reads its text once, and for a known file the index costs nothing but the listing.

With an ``index_path`` the index is kept there from run to run; without one
it lives for one scan.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, read_version, scratch_path, write_version

INDEX = "file_path string, length long, modified timestamp, header string"
_KEY = ["file_path", "length", "modified"]
#: Files whose heads are held on the driver at once, and read at the same time.
GROUP, READERS = 5000, 16
#: A header line is looked for in so many bytes.
HEAD_BYTES = 1 << 20


class MissingHeaderError(RuntimeError):
    pass


def cells(line: str) -> list[str]:
    """The stripped cells of a header line."""
    return [c.strip() for c in next(csv.reader([line], delimiter="\t"), [])]


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, file_path, length, modified) of the files a reader of ``paths`` reads; no content is read."""
    return (spark.read.format("binaryFile").load(list(paths))
            .select("path", F.col("_metadata.file_path").alias("file_path"), "length",
                    F.col("modificationTime").alias("modified")))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file that is not blank, without a byte order mark; None if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(conf).open(hpath)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hpath)
        text = codec.createInputStream(stream) if codec else stream
        head = jvm.org.apache.commons.io.input.BoundedInputStream(text, HEAD_BYTES)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(head, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.lstrip("﻿").strip():
            line = reader.readLine()
    finally:
        stream.close()
    return line.lstrip("﻿") if line is not None else None


def _in_groups(rows: Iterable, size: int):
    group = []
    for row in rows:
        group.append(row)
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group


def _read_heads(spark: SparkSession, files: DataFrame, path: str) -> int:
    """Write the index rows of ``files`` to ``path``, a bounded group at a time; gives their number."""
    seen = 0
    with ThreadPoolExecutor(READERS) as pool:
        for group in _in_groups(files.toLocalIterator(), GROUP):
            lines = pool.map(lambda r: first_line(spark, r["path"]) if r["length"] else None, group)
            rows = [(r["file_path"], r["length"], r["modified"], line) for r, line in zip(group, lines, strict=True)]
            spark.createDataFrame(rows, INDEX).coalesce(1).write.mode("append").parquet(path)
            seen += len(rows)
    return seen


def file_layouts(spark: SparkSession, paths: Sequence[str], index_path: str | None = None) -> DataFrame:
    """The index rows of the files of ``paths``; only heads of files not in the index are read."""
    files = list_files(spark, paths)
    known = read_version(spark, index_path) if index_path else None
    todo = files if known is None else files.join(known, _KEY, "left_anti")
    fresh = scratch_path(spark, "layouts")
    found = _read_heads(spark, todo, fresh)
    new = spark.read.schema(INDEX).parquet(fresh) if found else spark.createDataFrame([], INDEX)
    if not index_path:
        return new
    if found:
        kept = new if known is None else known.join(new, "file_path", "left_anti").select(*new.columns).unionByName(new)
        write_version(kept, index_path)
        delete_path(spark, fresh)
    index = read_version(spark, index_path)
    return files.select(*_KEY).join(index, _KEY) if index is not None else new


def header_layouts(index: DataFrame, header_first: str, check_headers: bool = True) -> list[str]:
    """The distinct header lines of some files, sorted (few, however many the files).

    A file whose first line does not name ``header_first`` fails the call.
    """
    found = (index.where(F.col("header").isNotNull()).groupBy("header")
             .agg(F.min("file_path").alias("example")).collect())
    bare = [r["example"] for r in found if header_first not in cells(r["header"])]
    if bare and check_headers:
        raise MissingHeaderError(f"file without header line: {min(bare)}")
    return sorted(r["header"] for r in found if header_first in cells(r["header"]))

"""Helpers shared by the operators: input columns, staging, word hashes.

Words follow the fixed rule ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z
only; ``bytes.lower().split()`` is exactly that rule on UTF-8 bytes.
Word identity is a 64-bit hash where an operator says so.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.session import scratch_path

#: Documents are hashed in groups of about this many bytes.
GROUP_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null as empty), with further columns if asked.

    Other columns, whatever their names, are left behind here, so that they
    cannot clash with the names an operator makes.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


_scratch: list[list[str]] = []


@contextmanager
def scratch_of(paths: list[str]):
    """Notes in ``paths`` what is staged inside."""
    _scratch.append(paths)
    try:
        yield
    finally:
        _scratch.pop()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again.

    Cuts the lineage with files that outlive an executor, and fixes what a
    second evaluation could compute in another order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for noted in _scratch:
        noted.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fold_of(column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id: that of the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds


def numbered(df: DataFrame, group: str, row: str, out: str, chunk: int = 4096) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the order of ``row``.

    ``row`` is a staged ``monotonically_increasing_id()``.  Rows are numbered
    within (group, run of ``chunk`` rows) and shifted by the counts of the
    runs before, so a group of any size is spread over many tasks.
    """
    from pyspark.sql import Window
    run = F.struct(F.shiftright(F.col(row), 33).alias("part"),
                   F.floor(F.col(row).bitwiseAND((1 << 33) - 1) / chunk).alias("nth")).alias("_run")
    rows = df.withColumn("_run", run)
    before = (Window.partitionBy("_group").orderBy("_at")
              .rowsBetween(Window.unboundedPreceding, -1))
    sizes = (rows.groupBy(F.col(group).alias("_group"), F.col("_run").alias("_at"))
             .agg(F.count("*").alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(group, "_run").orderBy(row)
    return (rows.withColumn("_nth", F.row_number().over(inside) - 1)
            .join(sizes, (F.col(group) == F.col("_group")) & (F.col("_run") == F.col("_at")))
            .withColumn(out, (F.col("_nth") + F.col("_shift")).cast("long"))
            .drop("_run", "_nth", "_group", "_at", "_shift"))


def slices(batches, rows: int = 500):
    """Arrow batches cut into short ones, which bounds what is worked on at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column (nulls as empty)."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_group(data: bytes, powers: np.ndarray, inverses: np.ndarray):
    """Hash and start of each word of one buffer."""
    raw = np.frombuffer(data, dtype=np.uint8)
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[_LOWER[raw]] * powers[:len(raw)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverses[starts]
    return scrambled(value + (ends - starts).astype(np.uint64)), starts


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base; the usual size is kept, larger ones are made and dropped."""
    if n <= GROUP_BYTES:
        if not _TABLES:
            _TABLES[0] = (_powers(_BASE, GROUP_BYTES), _powers(_INVERSE, GROUP_BYTES))
        return _TABLES[0]
    return _powers(_BASE, n), _powers(_INVERSE, n)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and each text's first index (one more at the end)."""
    parts, counts, at = [], [], 0
    with np.errstate(over="ignore"):
        while at < len(texts):
            size, to = len(texts[at]) + 1, at + 1
            while to < len(texts) and size + len(texts[to]) < GROUP_BYTES:
                size, to = size + len(texts[to]) + 1, to + 1
            group = texts[at:to]
            hashes, starts = _hash_group(b"\n".join(group), *_power_tables(size))
            first = np.cumsum([0] + [len(t) + 1 for t in group])
            counts.append(np.diff(np.searchsorted(starts, first)))
            parts.append(hashes)
            at = to
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, dtype=np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)), bounds.astype(np.int64)


def shingle_sequence(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word shingles of one text, in order.

    A shorter text is one shingle, a text without words has none.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        width = min(n, size)
        value = np.full(n - width + 1, width, dtype=np.uint64)
        for k in range(width):
            value = scrambled(value * np.uint64(0xD6E8FEB86659FD93) + words[k:n - width + 1 + k])
    return value


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text."""
    return np.unique(shingle_sequence(words, size))


def packed(values: np.ndarray) -> bytes:
    """An array of whole numbers as compressed bytes, byte plane by byte plane."""
    a = np.ascontiguousarray(values)
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.zeros((0, 0), np.uint8)
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpacked(data: bytes, dtype) -> np.ndarray:
    """The array that ``packed`` was given."""
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)

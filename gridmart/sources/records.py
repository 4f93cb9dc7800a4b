"""Records of quoted text out of byte ranges, so that one big file is many tasks.

A newline inside quotes does not end a record, so whether a line begins a record depends on
all that stands before it.  Spark's text source cuts a file into byte ranges of whole lines.
For every line it is decided, without knowing what stands before it, in which state it ends
from either state it may begin in: outside quotes, or inside a quoted cell.
That is a function on two states, so a range is the composition of its lines' functions:

1. Every range computes its function for both states (lines without a quote character
   change nothing and stay in the JVM).
2. A prefix composition over a file's ranges, window functions over one row for each range that
   holds quotes, gives the state in which each range truly begins.
3. The ranges emit their whole records.  A record that runs over the end of a range is put
   together from its fragments, of which every range has two at most.  If there are any, the
   lines are scanned once more, and only those of such ranges leave the JVM.

What comes to the driver are the places where a record runs over the end of a range: a few numbers
for a range at most.  A record begins a quoted cell only by a quote right after a tab or at
its start; a quote elsewhere is an ordinary character, and so is what follows a closing quote.
A quote that is never closed takes the rest of the file.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staged_copy

# Whole cells: quoted ones with what follows the closing quote, or ones that begin without a quote.
_QUOTED_REST = r'[^"]*+(?:""[^"]*+)*+"[^\t]*+'
_CELLS = r'(?:(?:"' + _QUOTED_REST + r'|[^"\t][^\t]*+|)(?:\t|\z))*+\z'
#: A line that began outside quotes and ends a record; one that began inside and ends it.
ENDS_FROM_OUTSIDE = r"\A" + _CELLS
ENDS_FROM_INSIDE = r"\A" + _QUOTED_REST + r"(?:\z|\t" + _CELLS + ")"

SUMMARY = ("file long, start long, length long, quoted boolean, "
           "out_after int, in_after int, out_opened boolean, in_opened boolean")
WHOLE = "file long, record string"
FRAGMENT = "file long, owner long, start long, text string"
#: The range up to which an open record goes on, if no later range of the file holds a quote.
_END = (1 << 63) - 1


def _lines(spark: SparkSession, paths: Sequence[str], split: int | None = None) -> DataFrame:
    """The lines of the files with their file's number, their range, and how they change the state."""
    meta = F.col("_metadata")
    value = F.col("value")
    rows = (spark.read.option("lineSep", "\n").text(list(paths))
            .select("value", F.xxhash64(meta.file_path).alias("file"), meta.file_block_start.alias("start"),
                    meta.file_block_length.alias("length")))
    if split is not None:
        same = (F.col("start") % split == 0) & (F.col("length") <= split)
        value = F.when(same, value).otherwise(F.raise_error(F.lit(
            "the files were cut into other ranges than before; hold spark.sql.files.minPartitionNum")))
    quoted = F.col("value").contains('"')
    return rows.select(value.alias("value"), "file", "start", "length", quoted.alias("quoted"),
                       (quoted & ~F.col("value").rlike(ENDS_FROM_OUTSIDE)).alias("opens"),
                       (quoted & F.col("value").rlike(ENDS_FROM_INSIDE)).alias("closes"))


def states(opens: np.ndarray, closes: np.ndarray, begin: int) -> np.ndarray:
    """The state (0 outside, 1 inside quotes) before each line and after the last one.

    A line that closes from inside but does not open from outside ends outside whatever was before;
    one that opens and does not close ends inside; one that does both changes the
    state, one that does neither keeps it.
    """
    n = len(opens)
    swaps = np.cumsum(opens & closes)
    fixed = np.maximum.accumulate(np.where(opens != closes, np.arange(n), -1)) if n else np.zeros(0, dtype=np.int64)
    base = np.where(fixed >= 0, opens[fixed], begin).astype(np.int64)
    after = (base + swaps - np.where(fixed >= 0, swaps[fixed], 0)) % 2
    return np.concatenate([[begin], after])


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of SUMMARY for each range of a task, in whose order the lines come."""
    now: list | None = None

    def row(r: list) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int32()] * 2 + [pa.bool_()] * 2
        names = [c.split()[0] for c in SUMMARY.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(r, kinds, strict=True)], names=names)

    for batch in batches:
        columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("file", "start", "length", "quoted", "opens", "closes")]
        file, start, length, quoted, opens, closes = columns
        for a, b in _segments(file, start):
            key = [int(file[a]), int(start[a]), int(length[a])]
            if now is None or now[:3] != key:
                if now is not None:
                    yield row(now)
                now = [*key, False, 0, 1, False, False]
            now[3] |= bool(quoted[a:b].any())
            for k in (4, 5):
                path = states(opens[a:b], closes[a:b], now[k])
                now[k] = int(path[-1])
                now[k + 2] |= bool(((path[:-1] == 0) & (path[1:] == 1)).any())
    if now is not None:
        yield row(now)


def _segments(file: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of the runs of lines of one range."""
    if len(file):
        edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        yield from zip([0, *edges.tolist()], [*edges.tolist(), len(file)], strict=True)


def range_summaries(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """What each range that holds a quote does to either state, and each task's first range."""
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = _lines(spark, paths).withColumn("first", first).where("quoted OR first")
    return lines.select("file", "start", "length", "quoted", "opens", "closes").mapInArrow(_summarised, SUMMARY)


def crossings(summaries: DataFrame) -> DataFrame:
    """(file, after, upto, owner): ranges that begin behind ``after`` and no later than ``upto`` begin inside
    the record that the range ``owner`` opened."""
    w = Window.partitionBy("file").orderBy("start")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("out_after") == F.col("in_after")
    swap = (F.col("out_after") == 1) & (F.col("in_after") == 0)
    rows = (summaries.where("quoted").withColumn("swaps", F.sum(swap.cast("int")).over(upto))
            .withColumn("fixed", F.last(F.when(fixed, F.struct("out_after", "swaps")), ignorenulls=True).over(upto))
            .withColumn("state", F.coalesce((F.col("fixed.out_after") + F.col("swaps") - F.col("fixed.swaps")) % 2,
                                            F.col("swaps") % 2))
            .withColumn("before", F.lag("state", 1, 0).over(w)))
    opened = F.when(F.col("before") == 0, F.col("out_opened")).otherwise(F.col("in_opened"))
    return (rows.withColumn("owner", F.last(F.when(opened, F.col("start")), ignorenulls=True).over(upto))
            .withColumn("next", F.lead("start").over(w))
            .where("state = 1")
            .select("file", F.col("start").alias("after"), F.coalesce("next", F.lit(_END)).alias("upto"), "owner"))


class Begins:
    """In which state each range begins: inside whose record, if any."""

    def __init__(self, rows):
        self.files: dict[int, list[tuple[int, int, int]]] = {}
        for r in sorted(rows, key=lambda r: (r["file"], r["after"])):
            self.files.setdefault(r["file"], []).append((r["after"], r["upto"], r["owner"]))

    def owner(self, file: int, start: int) -> int | None:
        """The range that opened the record inside which this one begins, or None."""
        own = self.files.get(file, [])
        k = bisect_left(own, (start,)) - 1
        return own[k][2] if k >= 0 and own[k][0] < start <= own[k][1] else None


def _assembled(begins: Begins, fragments: bool):
    """Records out of the lines of a task: the whole ones, or the fragments of those that run over a range's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[int, int] | None = None
        state, owner, held = 0, None, []

        def fragment() -> list[tuple]:
            """What is held at the end of a range, or of the record that began before it."""
            return [(key[0], owner, key[1], "\n".join(held))] if held and key is not None else []

        for batch in batches:
            file, start, opens, closes = (batch[c].to_numpy(zero_copy_only=False) for c in ("file", "start", "opens", "closes"))
            whole, parts = [], []
            for a, b in _segments(file, start):
                here = (int(file[a]), int(start[a]))
                if here != key:
                    parts += fragment()
                    key, held, owner = here, [], begins.owner(*here)
                    state = 0 if owner is None else 1
                path = states(opens[a:b], closes[a:b], state)
                values = batch["value"].slice(a, b - a)
                if not path.any():
                    whole.append((here[0], values.to_pylist()))
                    continue
                records = []
                for line, before, after in zip(values.to_pylist(), path[:-1].tolist(), path[1:].tolist(), strict=True):
                    if before == 0 and after == 1:
                        owner = here[1]
                    held.append(line)
                    if after == 0:
                        if owner is not None and owner != here[1]:
                            parts += fragment()
                        else:
                            records.append("\n".join(held))
                        held, owner = [], None
                whole.append((here[0], records))
                state = int(path[-1])
            if fragments:
                yield from _fragments(parts)
            else:
                for number, records in whole:
                    if records:
                        yield pa.RecordBatch.from_arrays([pa.array([number] * len(records), pa.int64()),
                                                          pa.array(records, pa.string())], names=["file", "record"])
        if fragments:
            yield from _fragments(fragment())
    return run


def _fragments(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                         names=[c.split()[0] for c in FRAGMENT.split(", ")])


def quoted_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, record): the records of the files, quoted newlines kept; ``file`` is xxhash64 of the file's path."""
    with staged_copy(range_summaries(spark, paths), "ranges") as summaries:
        split, quoted = summaries.agg(F.max("length"), F.max("quoted")).first()
        found = crossings(summaries).collect()  # a row for a range at most
    if not quoted:
        return _lines(spark, paths).select("file", F.col("value").alias("record"))
    begins = Begins(found)
    columns = ["value", "file", "start", "opens", "closes"]
    lines = _lines(spark, paths, split).select(*columns)
    whole = lines.mapInArrow(_assembled(begins, False), WHOLE)
    if not found:
        return whole
    owners = sorted({(r["file"], r["owner"], r["upto"]) for r in found})
    wanted = F.broadcast(spark.createDataFrame(owners, "f long, a long, b long"))
    cut = lines.join(wanted, (F.col("file") == F.col("f")) & (F.col("start") >= F.col("a"))
                     & (F.col("start") <= F.col("b")), "left_semi")
    joined = (cut.mapInArrow(_assembled(begins, True), FRAGMENT).groupBy("file", "owner")
              .agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
              .select("file", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record")))
    return whole.unionByName(joined)


def record_cells(record: Column, width: int) -> Column:
    """The first ``width`` cells of a record as a struct ``_c0``, ``_c1``, ..."""
    schema = ", ".join(f"_c{i} string" for i in range(width))
    return F.from_csv(record, F.lit(schema), {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE"})

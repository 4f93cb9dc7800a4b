"""Repeated passages by a sparse suffix array over words.

Of each text only the suffixes at minimiser positions are kept: of every run of
``WORDS`` - ``GRAM`` + 1 neighbouring ``GRAM``-word grams the one with the least
hash.  A passage of ``WORDS`` words that occurs twice has such a run whole in
both places, and the choice depends on the passage alone, so both places keep a
suffix at the same point of it.

Suffixes whose gram occurs once are dropped first.  The others are sorted over
the cluster, by their gram and then by the words that follow; neighbours in
that order which lie in different documents are compared, and matches extended
to the right and to the left.  The same is done in the order of the words that
precede, read backwards, which finds partners that the first order separates.

What both orders may have missed is found by equality.  The nearest rows of
other documents share the most words that any has, on the right in one order and
on the left in the other; so they tell which windows of ``WORDS`` words around a
suffix can occur elsewhere at all.  Those of them that no match has found yet
are grouped by a hash of the whole window, together with one row for each chain
of matches, whatever stands between them in the orders.

Matches of ``WORDS`` words or more mark their words in both documents; marks of
a document are merged.  Sorting is by range, and rows of one suffix are ordered
by document, so a passage with very many places is spread over many tasks.

Words are compared by 32-bit hashes in context, grams by 64-bit hashes.

Cases: null, empty or short texts have no passage; passages that repeat only
within one document (or among rows of one id) are left alone; equal suffixes
are ordered by document id and place; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import (as_bytes, documents, packed, scrambled, slices, staged, table, tasks, unpacked,
                                 word_hashes)

#: Least length of a repeated passage, and length of the gram a suffix begins with, in words.
WORDS = 50
GRAM = 8
#: Slots of the bitmap of grams that occur twice (fixed size; a chance hit only costs a row).
SLOTS = 1 << 23
_SLOT_CHUNK = 1 << 16
SUFFIX = "gram long, after binary, before binary, doc_id long, place long"
#: Documents on either side in the sorted order that a suffix is compared with.
NEAR = 4
#: Windows around a suffix, as bits by the words they have on its left: all, and without the first and the last one,
#: which the nearest rows in one of the orders share if any row does.
_ALL = (1 << WORDS - GRAM + 1) - 1
_INNER = _ALL & ~1 & ~(1 << WORDS - GRAM)
SPANS = "doc_id long, start long, stop long"


def gram_sequence(words: np.ndarray) -> np.ndarray:
    """A hash of each run of ``GRAM`` (a power of two) words, by doubling."""
    value, width = words, 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            value = scrambled(value[:-width] * np.uint64(0xD6E8FEB86659FD93) + value[width:])
            width *= 2
    return value


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash (the first of equals) of each run of ``window`` grams."""
    if len(grams) < window:
        return np.zeros(0, dtype=np.int64)
    low = grams.copy()
    place = np.arange(len(grams))
    width = 1
    while width < window:  # least over runs of twice the width, at most the window
        step = min(width, window - width)
        later = low[step:] < low[:-step]
        place = np.where(later, place[step:], place[:-step])
        low = np.where(later, low[step:], low[:-step])
        width += step
    return np.unique(place)


def kept_suffixes(batch: pa.RecordBatch):
    """(position, words, places, gram hashes) of the texts that are long enough."""
    words, bounds = word_hashes(as_bytes(batch["text"]))
    for k in np.flatnonzero(np.diff(bounds) >= WORDS):
        own = words[bounds[k]:bounds[k + 1]]
        grams = gram_sequence(own)
        places = minimisers(grams, WORDS - GRAM + 1)
        yield int(k), own, places, grams[places]


def _slots(grams: np.ndarray) -> np.ndarray:
    return (scrambled(grams) % np.uint64(SLOTS)).astype(np.int64)


def _grams(batches):
    for batch in slices(batches):
        ids = batch["doc_id"].to_pylist()
        found = [(ids[k], grams) for k, _, _, grams in kept_suffixes(batch)]
        if found:
            # Each gram once for a document: two places in one document are no repeat.
            distinct = [np.unique(g) for _, g in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(distinct).view(np.int64)),
                 pa.array([i for (i, _), g in zip(found, distinct, strict=True) for _ in range(len(g))], pa.int64())],
                names=["gram", "doc_id"])


def _slot_parts(batches):
    for batch in batches:
        slots = np.unique(_slots(batch["gram"].to_numpy(zero_copy_only=False).view(np.uint64)))
        names, at = np.unique(slots // _SLOT_CHUNK, return_index=True)
        rows = [(n, packed(p % _SLOT_CHUNK)) for n, p in zip(names.tolist(), np.split(slots, at[1:]), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                names=["chunk", "slots"])


def _merged_slots(rows):
    import pandas as pd
    mine = np.unique(np.concatenate([unpacked(x, np.int64) for x in rows["slots"]]))
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "slots": [packed(mine)]})


def repeated_grams(texts: DataFrame) -> np.ndarray:
    """A bitmap that holds every gram kept in two documents or more."""
    twice = (texts.mapInArrow(_grams, "gram long, doc_id long").groupBy("gram")
             .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("gram"))
    bitmap = np.zeros(SLOTS, dtype=bool)
    parts = twice.mapInArrow(_slot_parts, "chunk int, slots binary").groupBy("chunk").applyInPandas(
        _merged_slots, "chunk int, slots binary")
    for r in parts.collect():  # at most SLOTS numbers
        bitmap[r["chunk"] * _SLOT_CHUNK + unpacked(r["slots"], np.int64)] = True
    return bitmap


def _context(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` words from each place on (zero beyond the end), as big-endian 32-bit hashes."""
    short = np.concatenate([(words >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.zeros(length, np.uint32)])
    return short[places[:, None] + np.arange(length)].astype(">u4")


def _contexts(bitmap):
    def run(batches):
        for batch in slices(batches):
            ids, out = batch["doc_id"].to_pylist(), []
            for k, words, places, grams in kept_suffixes(batch):
                hit = bitmap.value[_slots(grams)]
                places, grams = places[hit], grams[hit]
                if len(places):
                    after = _context(words, places, WORDS)
                    before = _context(words[::-1], len(words) - places, WORDS - GRAM)
                    out.extend(zip(grams.view(np.int64).tolist(), (x.tobytes() for x in after),
                                   (x.tobytes() for x in before), [ids[k]] * len(places), places.tolist(), strict=True))
            for at in range(0, len(out), 5000):
                yield _rows(out[at:at + 5000])
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["gram", "after", "before", "doc_id", "place"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _matched(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words of each row are equal."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def united(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans sorted by owner (numbered) and start: where each united span begins in them, and its end."""
    shift = owner * (int(stop.max(initial=0)) + 1)
    reach = np.maximum.accumulate(stop + shift)
    # A span opens with its owner, or where none before it reaches.
    first = np.flatnonzero(np.concatenate([[True], ((start + shift)[1:] > reach[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.append(first[1:], len(start)) - 1
    return first, (reach - shift)[last]


def _windows(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The bits from ``low`` to ``high``, both in it (none where low is above high)."""
    one = np.int64(1)
    return np.where(low <= high, (one << (high + 1)) - (one << np.minimum(low, high + 1)), 0)


def neighbour_matches(rows: pa.Table, order: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Rows doc_id, start, stop where sorted neighbours of different documents match long enough.

    Then, for the name of an order, rows doc_id, place, could, found, earlier: windows that the nearest rows do not
    rule out, those found, and those found with a row before.  Rows that need no more are left out.
    """
    n = rows.num_rows
    gram, doc, place = (rows[c].to_numpy() for c in ("gram", "doc_id", "place"))
    after = np.frombuffer(b"".join(rows["after"].to_pylist()), dtype=">u4").reshape(n, WORDS)
    before = np.frombuffer(b"".join(rows["before"].to_pylist()), dtype=">u4").reshape(n, WORDS - GRAM)
    begins = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])]))
    run = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
    mine, other, sizes = [], [], []
    for near in range(1, NEAR + 1):
        # The last row of the near-th run before, and the first of the near-th after.
        for partner, ok in ((begins[np.maximum(run - near + 1, 0)] - 1, run >= near),
                            (begins[np.minimum(run + near, len(begins) - 1)], run + near < len(begins))):
            at = np.flatnonzero(ok)
            at = at[(gram[at] == gram[partner[at]]) & (doc[at] != doc[partner[at]])]
            mine.append(at)
            other.append(partner[at])
            sizes.append(len(at))
    i, j = np.concatenate(mine), np.concatenate(other)
    right, left = _matched(after[i], after[j]), _matched(before[i], before[j])
    good = right + left >= WORDS
    still = np.zeros((0, 5), dtype=np.int64)
    if order:
        could, found, earlier = (np.zeros(n, dtype=np.int64) for _ in range(3))
        near = slice(0, sizes[0] + sizes[1])
        np.bitwise_or.at(could, i[near], _windows(WORDS - right[near], np.full_like(right[near], WORDS - GRAM))
                         if order == "after" else _windows(np.zeros_like(left[near]), left[near]))
        bits = _windows(WORDS - right[good], left[good])
        np.bitwise_or.at(found, i[good], bits)
        np.bitwise_or.at(found, j[good], bits)
        np.bitwise_or.at(earlier, np.maximum(i, j)[good], bits)
        could &= _INNER
        if order == "after":
            could &= ~earlier
        at = np.flatnonzero(could)
        still = np.stack([x[at] for x in (doc, place, could, found, earlier)], axis=1)
    i, j, right, left = i[good], j[good], right[good], left[good]
    both = [np.stack([doc[x], place[x] - left, place[x] + right], axis=1) for x in (i, j)]
    spans = np.concatenate(both)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    if not len(spans):
        return spans, still
    owner = np.cumsum(np.concatenate([[0], spans[1:, 0] != spans[:-1, 0]]))
    first, stop = united(owner, spans[:, 1], spans[:, 2])
    return np.stack([spans[first, 0], spans[first, 1], stop], axis=1), still


def _neighbours(order: str):
    """Of a sorted partition spans, and suffixes with windows to look for; its first and last documents go out as edges."""
    def run(batches):
        yield from _partition(batches, order)
    return run


def _partition(batches, order: str):
    part, held, edges = TaskContext.get().partitionId(), None, []

    def spans(rows: pa.Table) -> pa.RecordBatch:
        found, still = neighbour_matches(rows, order)
        n, m = len(found), len(still)
        columns = [np.concatenate([found[:, 0], still[:, 0]]), np.concatenate([found[:, 1], still[:, 1]])]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in columns), pa.array([*found[:, 2].tolist(), *[None] * m], pa.int64()),
             *(pa.nulls(n + m, k) for k in (pa.int64(), pa.binary(), pa.binary(), pa.int64())),
             *(pa.array([*[None] * n, *still[:, k].tolist()], pa.int64()) for k in (2, 3, 4))],
            names=[c.split()[0] for c in _OUT.split(", ")])

    first_done = False
    for batch in slices(batches, 2000):
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        yield spans(rows)
        doc = rows["doc_id"].to_numpy()
        turns = np.flatnonzero(doc[1:] != doc[:-1]) + 1
        if not first_done:
            edges.append(rows.slice(0, int(turns[NEAR - 1]) if len(turns) >= NEAR else len(doc)))
            first_done = True
        # The next batch is compared with the rows of the last documents.
        held = rows.slice(int(turns[-NEAR]) if len(turns) >= NEAR else 0)
    if held is not None:
        edges.append(held)
        for k, rows in enumerate(edges):
            kept = rows.to_pylist()
            yield _out([(r["doc_id"], r["place"], None, r["gram"], r["after"], r["before"], (part << 33) + (k << 32) + n,
                         _ALL, 0, 0)
                        for n, r in enumerate(kept)])


_OUT = "doc_id long, start long, stop long, gram long, after binary, before binary, edge long, could long, found long, earlier long"


def _out(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=[c.split()[0] for c in _OUT.split(", ")])


def _edge_matches(rows):
    import pandas as pd
    rows = rows.sort_values("edge").rename(columns={"start": "place"})
    found, _ = neighbour_matches(pa.Table.from_pandas(
        rows[["gram", "after", "before", "doc_id", "place"]], preserve_index=False))
    return pd.DataFrame(found, columns=["doc_id", "start", "stop"], dtype="int64")


def spans_in_order(suffixes: DataFrame, context: str) -> tuple[DataFrame, DataFrame]:
    """Spans from neighbours in the order of gram and one of the contexts, and what they leave open of each suffix.

    At the edges of partitions, where the nearest row can be far away, every window is open.
    """
    order = ["gram", context, "doc_id", "place"]
    found = staged(suffixes.repartitionByRange(tasks(suffixes), *order).sortWithinPartitions(*order)
                   .mapInArrow(_neighbours(context), _OUT), "neighbours")
    # The last documents of each partition meet the first ones of the next that has rows.
    edges = found.where("edge IS NOT NULL").withColumn("part", F.shiftright("edge", 33))
    parts = sorted(r["part"] for r in edges.select("part").distinct().collect())  # partitions of the sort
    nth = [F.lit(x) for k, part in enumerate(parts) for x in (part, k + 1)]
    place = F.create_map(*nth)[F.col("part")] if nth else F.lit(0)
    at_end = F.col("edge").bitwiseAND(1 << 32) != 0
    across = (edges.withColumn("boundary", F.when(at_end, place).otherwise(place - 1))
              .groupBy("boundary").applyInPandas(_edge_matches, SPANS))
    still = found.where("could IS NOT NULL").select("doc_id", F.col("start").alias("place"), "could", "found", "earlier")
    return found.where("stop IS NOT NULL").select("doc_id", "start", "stop").unionByName(across), still


def _window_hashes(batches):
    """Rows hash, doc_id, start, found of the windows in ``bits`` of each suffix."""
    with np.errstate(over="ignore"):
        odd = np.uint64(0x9E3779B97F4A7C15)
        powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(2 * WORDS, odd)))
    lefts = np.arange(WORDS - GRAM + 1)
    for batch in slices(batches, 2000):
        n = batch.num_rows
        after = np.frombuffer(b"".join(batch["after"].to_pylist()), dtype=">u4").reshape(n, WORDS)
        before = np.frombuffer(b"".join(batch["before"].to_pylist()), dtype=">u4").reshape(n, WORDS - GRAM)
        words = np.concatenate([before[:, ::-1], after], axis=1).astype(np.uint64)
        bits, known, doc, place = (batch[c].to_numpy() for c in ("bits", "found", "doc_id", "place"))
        sums = np.zeros((n, words.shape[1] + 1), dtype=np.uint64)
        ends = np.cumsum(np.concatenate([np.zeros((n, 1), np.int64), words == 0], axis=1), axis=1)
        with np.errstate(over="ignore"):
            np.cumsum(scrambled(words) * powers[:words.shape[1]], axis=1, out=sums[:, 1:])
            first = WORDS - GRAM - lefts
            value = scrambled((sums[:, first + WORDS] - sums[:, first]) * powers[lefts])  # all as if they began at the last
        # None that reaches beyond an end of its text.
        row, left = np.nonzero(((bits[:, None] >> lefts) & 1 == 1) & (ends[:, first + WORDS] == ends[:, first]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(value[row, left].view(np.int64)), pa.array(doc[row]), pa.array(place[row] - left),
             pa.array(((known[row] >> left) & 1).astype(bool))], names=["hash", "doc_id", "start", "found"])


def spans_by_window(suffixes: DataFrame, after: DataFrame, before: DataFrame) -> DataFrame:
    """Spans of windows that the orders leave open and that another document has too."""
    none = F.lit(0).cast("long")
    both = after.withColumn("left", none).withColumnRenamed("could", "right").unionByName(
        before.select("doc_id", "place", F.col("could").alias("left"), "found", none.alias("earlier"), none.alias("right")))
    bit = lambda c: F.coalesce(F.bit_or(c), F.lit(0)).alias(c)
    left, right = F.col("left"), F.col("right")
    bits = (left.bitwiseAND(right).bitwiseAND(F.bitwise_not("earlier")).bitwiseOR(right.bitwiseAND(1))
            .bitwiseOR(left.bitwiseAND(1 << WORDS - GRAM)))
    wanted = (both.groupBy("doc_id", "place").agg(*map(bit, ("left", "right", "found", "earlier")))
              .select("doc_id", "place", bits.alias("bits"), "found").where("bits <> 0"))
    windows = staged(suffixes.select("doc_id", "place", "after", "before").join(wanted, ["doc_id", "place"])
                     .mapInArrow(_window_hashes, "hash long, doc_id long, start long, found boolean"), "windows")
    shared = (windows.groupBy("hash").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.max("found").alias("any"))
              .where("a <> b OR any").select("hash"))
    return (windows.where("NOT found").join(shared, "hash", "left_semi")
            .select("doc_id", "start", (F.col("start") + WORDS).alias("stop")))


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans of a document as one (at most as many as its minimisers)."""
    def merge(batches):
        for batch in slices(batches, 200):
            column = batch["spans"]
            owner = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            start, stop = (x.to_numpy() for x in column.flatten().flatten())
            first, end = united(owner, start, stop)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(owner[first])), pa.array(start[first]), pa.array(end)],
                names=["doc_id", "start", "stop"])

    sets = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    return sets.mapInArrow(merge, SPANS)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start and stop (in words) of passages that occur in another document too."""
    texts = documents(docs).where("doc_id IS NOT NULL").select("doc_id", "text")
    bitmap = docs.sparkSession.sparkContext.broadcast(repeated_grams(texts))
    suffixes = staged(texts.mapInArrow(_contexts(bitmap), SUFFIX), "suffixes")
    (right, after), (left, before) = (spans_in_order(suffixes, x) for x in ("after", "before"))
    return merged(right.unionByName(left).unionByName(spans_by_window(suffixes, after, before)))


def op7_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share."""
    return repeated_passages(table(spark, sf_dir, "documents")).withColumn("n_words", F.col("stop") - F.col("start"))


QUERIES = {"op7_sparse_suffix": op7_sparse_suffix}

"""Set-similarity join on word shingles, light and heavy sets apart.

Two documents link when their shingle sets have Jaccard similarity of at least
``percent`` / 100.  Equal sets are one class from the start, so groups of exact
copies cost one set.  Between the classes:

* every set is ordered rare first, and only a prefix of it can decide; ``misses``
  is how many elements a partner may lack, size - ceil(percent * size / 100).
  Rarity comes from two sketches of fixed size over all documents: shingles of
  buckets that are loaded far above the mean come last, the others by how
  frequent their words are;
* a light set enumerates all 2-subsets of its first ``misses`` + 2 elements:
  two light sets that link share one of these subsets;
* a heavy set, and the light sets large enough to link with one, put their
  first ``misses`` + 1 elements into inverted lists, which heavy sets scan;
* the boundary is the size at which the rows of both ways, counted from the
  histogram of sizes, are least.

Sets that meet in a list or subset of up to ``SHORT`` sets are paired, and pairs
go whose sizes, or numbers of elements in each hash range (256 ranges, more for large sets, so that
a range holds four elements at most on average), rule the
similarity out.  In a longer list, up to ``LONG``, every set is compared in the same way with
the list's least one first, then with others tied to that, which joins a crowd of near copies with few rows
for each set however many lists they share; what is not tied by that is compared with all sets of the list within a task.  A list beyond ``LONG`` ties
all its sets to its least one, which is linear however long it is; the components of such lists are compared in blocks
in the same way.  The components of all ties are then compared set by set.
Groups beyond a block are compared in pairs of blocks, each a task.  A block alone yields
the ties or links inside it, at most one fewer than its sets; two blocks yield those between
parts that are not yet tied within either, for two blocks of near copies one.  So a group of thousands of
near copies yields about as many links as sets, not as pairs.  Verification is exact
up to 64-bit hashes of whole sets and 48 bits of a shingle's hash.

Cases: every row is a document by itself, and ids only name the result: rows that repeat an id
link by their own texts; the least known id of a component names it, so a row without an
id has the least id that its links reach, or null; null, empty or blank text has an empty set and links with nothing;
fewer words than the shingle size are one shingle; ties do not arise; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import (as_bytes, documents, packed, scrambled, shingle_hashes, shingle_sequence, slices,
                                 staged, table, unpacked, word_hashes)
from gridmart.llm.components import components, forest

#: Buckets of each of the two frequency sketches (4 MB in a broadcast).
SKETCH = 1 << 18
#: Most sets of a list that are paired, and of one that is compared by range counts in blocks;
#: longer lists are tied to their least set.
SHORT, LONG = 32, 4096
#: Sets of a list with which all others of it are compared first.
HUBS = 3
#: Hash ranges in which the elements of a set are counted, and elements of a range beyond which
#: a set has twice as many ranges.
RANGES, LOAD = 256, 4
_SKETCH_CHUNK = 1 << 12
#: Sets of a block when range counts, and when whole sets are compared; a pair of blocks is one group.
BLOCK, SET_BLOCK = 128, 256
#: Elements of all sets of a block of whole sets, on average.
ELEMENTS = 1 << 19
#: Size classes of the histogram: sizes within 5 % are one class.
_CLASS = 1.05


def needed(size: int, percent: int) -> int:
    """The least overlap that a set of this size has with any partner."""
    return -(-size * percent // 100)


def shingle_sets(batch: pa.RecordBatch, size: int):
    """(position, set) of the texts of a batch."""
    words, bounds = word_hashes(as_bytes(batch["text"]))
    for i in range(batch.num_rows):
        yield i, shingle_hashes(words[bounds[i]:bounds[i + 1]], size)


def class_of(own: np.ndarray) -> int:
    """The class of a set: 64 bits of a digest of its elements."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def range_counts(own: np.ndarray) -> bytes:
    """Elements of a set in each hash range (8 bits each)."""
    width = RANGES
    while len(own) > width * LOAD:
        width *= 2
    ranges = ((own >> np.uint64(20)) % np.uint64(width)).astype(np.int64)
    return np.minimum(np.bincount(ranges, minlength=width), 255).astype(np.uint8).tobytes()


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def _profiles(size: int):
    """Rows for each document (its set's size, class and range counts) and for the sketches."""
    names = ["row", "doc_id", "n_shingles", "class", "ranges", "chunk", "counts"]

    def run(batches):
        sketch = np.zeros(2 * SKETCH, dtype=np.int64)  # of words, then of shingles
        for batch in slices(batches):
            words, bounds = word_hashes(as_bytes(batch["text"]))
            sets = [shingle_hashes(words[a:b], size) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            sketch[:SKETCH] += np.bincount(_bucket(words), minlength=SKETCH)
            sketch[SKETCH:] += np.bincount(_bucket(np.concatenate(sets)), minlength=SKETCH) if sets else 0
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([class_of(x) for x in sets], pa.int64()), pa.array([range_counts(x) for x in sets], pa.binary()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        parts = [(k, sketch[k * _SKETCH_CHUNK:(k + 1) * _SKETCH_CHUNK]) for k in range(2 * SKETCH // _SKETCH_CHUNK)]
        parts = [(k, packed(p)) for k, p in parts if p.any()]
        n = len(parts)
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(n, pa.int64()) for _ in range(4)), pa.nulls(n, pa.binary()),
             pa.array([k for k, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], names=names)
    return run


def _sum_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(unpacked(x, np.int64) for x in rows["counts"])
    return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "counts": [packed(total)]})


def rarity(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of the load of each word bucket, and which shingle buckets are heavily loaded."""
    out = np.zeros(2 * SKETCH, dtype=np.int64)
    rows = profiles.where("chunk IS NOT NULL").select("chunk", "counts")
    for r in rows.groupBy("chunk").applyInPandas(_sum_counts, "chunk int, counts binary").collect():  # 4 MB
        out[r["chunk"] * _SKETCH_CHUNK:(r["chunk"] + 1) * _SKETCH_CHUNK] = unpacked(r["counts"], np.int64)
    mean = out[SKETCH:].mean()
    return np.log1p(out[:SKETCH]).astype(np.float32), out[SKETCH:] > mean + 8 * np.sqrt(mean)


def cost_boundary(sizes: dict[int, int], percent: int) -> int:
    """The size from which sets are heavy: least rows enumerated and scanned in all.

    ``sizes`` counts sets by the least size of a class of sizes.
    """
    order = sorted(sizes)
    misses = {s: s - needed(s, percent) for s in order}
    subsets = {s: sizes[s] * (misses[s] + 2) * (misses[s] + 1) // 2 for s in order}
    scans = {s: sizes[s] * (misses[s] + 1) for s in order}
    best, choice = None, 1
    for limit in [*order, (order[-1] + 1 if order else 1)]:
        cost = (sum(subsets[s] for s in order if s < limit)
                + sum(scans[s] for s in order if s * 100 >= limit * percent)
                + sum(scans[s] for s in order if s >= limit))
        if best is None or cost < best:
            best, choice = cost, limit
    return max(choice, 1)


def rare_first(words: np.ndarray, size: int, loads: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The set of a text, in the common order of rarity (ties by hash)."""
    every = shingle_sequence(words, size)
    own, first = np.unique(every, return_index=True)
    width = min(len(words), size)
    load = loads[_bucket(words)]
    # A shingle's words follow from it, so any of its places gives the same value.
    frequent = sum((load[k:k + len(every)] for k in range(width)), np.zeros(len(every), np.float32))
    return own[np.lexsort((own, frequent[first], heavy[_bucket(own)]))]


def _keys(size: int, percent: int, boundary: int, sketches):
    """The keys of each document: subsets of light sets, list entries for heavy ones."""
    def keys_of(own: np.ndarray):
        n = len(own)
        if n == 0 or n * 100 < (n + 1) * percent:  # no other set can link
            return []
        misses = n - needed(n, percent)
        first, mine = own[:misses + 2], []
        with np.errstate(over="ignore"):
            if n < boundary:
                a, b = np.triu_indices(len(first), 1)
                low, high = np.minimum(first[a], first[b]), np.maximum(first[a], first[b])
                mine.append(scrambled(low * np.uint64(0x9E3779B97F4A7C15) + high))
            if n * 100 >= boundary * percent:
                mine.append(first[:misses + 1])
        return np.concatenate(mine).view(np.int64)

    def run(batches):
        loads, heavy = sketches.value
        for batch in slices(batches):
            words, bounds = word_hashes(as_bytes(batch["text"]))
            sets = [rare_first(words[a:b], size, loads, heavy) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array([class_of(np.sort(x)) for x in sets], pa.int64()),
                 pa.array([keys_of(x) for x in sets], pa.list_(pa.int64()))], names=["row", "class", "keys"])
    return run


def may_link(n_u, n_v, ranges_u: np.ndarray, ranges_v: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and range counts leave a link open: an overlap is at most the sum of the lesser counts."""
    most = np.minimum(ranges_u, ranges_v).sum(axis=-1, dtype=np.int64)
    unsure = (ranges_u.max(axis=-1) >= 255) | (ranges_v.max(axis=-1) >= 255)  # counts that were cut
    return unsure | (most * 100 >= (n_u + n_v - most) * percent)


def folded(ranges: np.ndarray, width: int) -> np.ndarray:
    """Counts (a row for each set) over fewer ranges; a count that was cut stays one."""
    while ranges.shape[-1] > width:
        half = ranges.shape[-1] // 2
        ranges = ranges[..., :half].astype(np.uint16) + ranges[..., half:]
    return ranges


class Profiles:
    """Sizes and range counts of some sets, of any widths."""

    def __init__(self, sizes: np.ndarray, ranges: list[bytes]):
        self.sizes = sizes
        self.width = np.array([len(r) for r in ranges], dtype=np.int64)
        self.slot = np.zeros(len(ranges), dtype=np.int64)
        self.counts: dict[int, np.ndarray] = {}
        for width in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == width)
            self.slot[at] = np.arange(len(at))
            self.counts[width] = np.frombuffer(b"".join(ranges[k] for k in at), np.uint8).reshape(-1, width)

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """The counts of sets that have one width, over ``width`` ranges at most."""
        return folded(self.counts[int(self.width[at[0]])][self.slot[at]], width)

    def may_link(self, u: np.ndarray, v: np.ndarray, percent: int) -> np.ndarray:
        """``may_link`` of the sets at the places ``u`` and ``v``, pair by pair."""
        out = np.zeros(len(u), dtype=bool)
        low, high = np.minimum(self.sizes[u], self.sizes[v]), np.maximum(self.sizes[u], self.sizes[v])
        left = np.flatnonzero(low * 100 >= high * percent)
        pairs = self.width[u[left]] * (1 << 40) + self.width[v[left]]
        for key in np.unique(pairs):
            same = left[pairs == key]
            width = int(min(self.width[u[same[0]]], self.width[v[same[0]]]))
            for k in np.array_split(same, -(-len(same) * width >> 22) or 1):
                out[k] = may_link(self.sizes[u[k]], self.sizes[v[k]], self.rows(u[k], width), self.rows(v[k], width), percent)
        return out


def _possible(percent: int):
    """Pairs that may link."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                both = Profiles(np.concatenate([batch["n_u"].to_numpy(), batch["n_v"].to_numpy()]),
                                batch["ranges_u"].to_pylist() + batch["ranges_v"].to_pylist())
                good = both.may_link(np.arange(n), np.arange(n, 2 * n), percent)
                yield batch.select(["u", "v"]).filter(pa.array(good))
    return run


def _crossing(rows: pd.DataFrame) -> np.ndarray | None:
    """For a group of two blocks the block of each row; None for one block."""
    a, b = rows["a"].iloc[0], rows["b"].iloc[0]
    return None if a == b else rows["mine"].to_numpy()


def _possible_forest(percent: int):
    """Edges that connect the sets which may link, inside a block or between the parts of two blocks."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        node, block = rows["node"].to_numpy(), _crossing(rows)
        sets = Profiles(rows["n_shingles"].to_numpy(), rows["ranges"].tolist())
        parts = []
        for k in range(len(rows) - 1):
            rest = np.arange(k + 1, len(rows))
            j = rest[sets.may_link(np.full(len(rest), k), rest, percent)]
            parts.append(np.stack([np.full(len(j), k), j]))
        pairs = np.concatenate([np.zeros((2, 0), dtype=np.int64), *parts], axis=1)
        if block is not None:  # what is tied inside a block is known from the block's own group
            inside = block[pairs[0]] == block[pairs[1]]
            pairs = pairs[:, np.argsort(~inside, kind="stable")]
        edges = [(a, b) for a, b in forest(len(rows), pairs[0], pairs[1]) if block is None or block[a] != block[b]]
        return pd.DataFrame([(node[a], node[b]) for a, b in edges], columns=["u", "v"], dtype="int64")
    return run


def _sets_of(size: int, members):
    """(row, class, set) of the rows that may be the one chosen for their class."""
    def run(batches):
        bitmap = None if members is None else members.value
        for batch in batches:
            ids = batch["row"].to_numpy(zero_copy_only=False)
            at = np.flatnonzero(_is_set(bitmap, ids)) if bitmap is not None else np.arange(len(ids))
            for k in range(0, len(at), 500):
                part = batch.take(pa.array(at[k:k + 500]))
                sets = [own for _, own in shingle_sets(part, size)]
                yield pa.RecordBatch.from_arrays(
                    [part["row"], pa.array([class_of(x) for x in sets], pa.int64()),
                     pa.array([packed(np.diff(np.unique(x >> np.uint64(16)), prepend=np.uint64(0))) for x in sets], pa.binary())], names=["row", "class", "members"])
    return run


#: Bits of the bitmap of member rows for each member, and most bits (16 MB); a chance hit only costs a row.
MEMBER_BITS, MOST_BITS = 16, 1 << 27


def _slots(ids: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (scrambled(ids.astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _is_set(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    slot = _slots(ids, len(bitmap) * 8)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0


def member_bitmap(rows: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits, as bytes, of the numbers in ``rows`` (row), put together from one for each task."""
    def slots(batches):
        for batch in batches:
            mine = np.unique(_slots(batch["row"].to_numpy(zero_copy_only=False), bits) >> 3)
            byte = np.zeros(len(mine), dtype=np.uint8)
            slot = _slots(batch["row"].to_numpy(zero_copy_only=False), bits)
            np.bitwise_or.at(byte, np.searchsorted(mine, slot >> 3), np.left_shift(1, slot & 7).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(byte.astype(np.int32))], names=["at", "byte"])

    out = np.zeros(bits // 8, dtype=np.uint8)
    parts = rows.mapInArrow(slots, "at long, byte int").groupBy("at").agg(F.bit_or("byte").alias("byte"))
    packs = parts.groupBy((F.col("at") / 65536).cast("int").alias("pack")).agg(F.collect_list(F.struct("at", "byte")).alias("bytes"))
    for r in packs.toLocalIterator():
        pairs = np.array(r["bytes"], dtype=np.int64)
        out[pairs[:, 0]] = pairs[:, 1]
    return out


class Overlaps:
    """Inverted lists over some sets, for the overlaps of one of them with all."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes, self.percent = np.array([len(s) for s in sets]), percent
        every, self.entry = np.unique(np.concatenate(sets), return_inverse=True)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        order = np.argsort(self.entry, kind="stable")
        self.lists = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.starts = np.searchsorted(self.entry[order], np.arange(len(every) + 1))

    def linked(self, x: int, among: np.ndarray) -> np.ndarray:
        """The sets of the mask ``among`` that are linked with set ``x``."""
        mine = self.entry[self.bounds[x]:self.bounds[x + 1]]
        lengths = self.starts[mine + 1] - self.starts[mine]
        at = np.repeat(self.starts[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        overlap = np.bincount(self.lists[at + np.arange(lengths.sum())], minlength=len(self.sizes))
        return np.flatnonzero(among & (overlap > 0) & (
            overlap * 100 >= (self.sizes + self.sizes[x] - overlap) * self.percent))


def linked_forest(sets: list[np.ndarray], percent: int, block: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges between places that join all sets linked with each other, at most one fewer than sets.

    Each set is expanded once over the sets not reached yet.  With ``block`` (of each set, two blocks) sets
    are first joined inside their blocks, and only edges between parts of
    different blocks are given: one for two blocks of near copies.
    """
    n, overlaps = len(sets), Overlaps(sets, percent)
    part, edges = np.arange(n), []
    free = np.ones(n, dtype=bool)
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        queue = [root]
        while queue:
            x = queue.pop()
            among = free if block is None else free & (block == block[x])
            if not among.any():
                continue
            found = overlaps.linked(x, among)
            free[found] = False
            part[found] = root
            queue.extend(found.tolist())
            edges.extend((x, y) for y in found.tolist())
    if block is None:
        return edges
    between = []
    for x in range(n):
        among = (block != block[x]) & (part != part[x])
        if block[x] == block[0] and among.any():
            for y in overlaps.linked(x, among).tolist():
                if part[y] != part[x]:
                    between.append((x, y))
                    part[part == part[y]] = part[x]
    return between


def _verify(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy()
        edges = linked_forest([np.cumsum(unpacked(x, np.uint64)) for x in rows["members"]], percent, _crossing(rows))
        return pd.DataFrame([(node[a], node[b]) for a, b in edges], columns=["u", "v"], dtype="int64")
    return run


def candidate_ties(texts: DataFrame, classes: DataFrame, shingle: int, percent: int, boundary: int,
                   sketches: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Edges (u, v) between classes that share a subset or list; linked classes are connected by them."""
    chosen = classes.select(F.col("class").alias("node"), "rep", "n_shingles")
    keyed = staged(
        texts.mapInArrow(_keys(shingle, percent, boundary, texts.sparkSession.sparkContext.broadcast(sketches)),
                         "row long, class long, keys array<long>")
        .join(chosen, (F.col("row") == F.col("rep")) & (F.col("class") == F.col("node")))
        .select("node", F.col("n_shingles").alias("n"), F.explode("keys").alias("key")), "keys")
    lists = keyed.groupBy("key").agg(F.count("*").alias("length"), F.min("node").alias("hub"),
                                     F.max("node").alias("last")).where("hub <> last")
    shared = staged(keyed.join(lists.drop("last"), "key"), "lists")
    endless = shared.where(F.col("length") > LONG).where("node <> hub").select(
        F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    middle = middle_edges(classes, shared.where(F.col("length").between(SHORT + 1, LONG)).select("key", "node", "hub"), percent)
    short = shared.where(F.col("length") <= SHORT)
    a, b = (short.select("key", F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in "uv")
    pairs = (a.join(b, "key").where("u < v")
             .where(F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent)
             .select("u", "v", "n_u", "n_v").distinct())
    possible = possible_pairs(classes, pairs.select("u", "v"), percent).unionByName(middle)
    if endless.isEmpty():
        return possible
    return possible.unionByName(possible_edges(classes, staged(components(endless), "endless"), percent))


def possible_pairs(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) which may link."""
    for x in "uv":
        pairs = pairs.join(classes.select(F.col("class").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                          F.col("ranges").alias(f"ranges_{x}")), x)
    return pairs.select("u", "v", "n_u", "n_v", "ranges_u", "ranges_v").mapInArrow(_possible(percent), "u long, v long")


def _rest_forest(percent: int):
    """Edges that connect a block of a list's sets, which are not tied to its least one, with all sets of the list."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        node, tied = rows["node"].to_numpy(), np.flatnonzero(rows["tied"].to_numpy())
        own = rows["mine"].to_numpy() == rows["b"].to_numpy()
        sets = Profiles(rows["n_shingles"].to_numpy(), rows["ranges"].tolist())
        every, parts = np.arange(len(rows)), [np.zeros((2, 0), dtype=np.int64)]
        for k in np.flatnonzero(own).tolist():
            others = every[~own | (every > k)]
            j = others[sets.may_link(np.full(len(others), k), others, percent)]
            parts.append(np.stack([np.full(len(j), k), j]))
        known = np.stack([np.full(len(tied), tied[0] if len(tied) else 0), tied])  # one part from the start
        pairs = np.concatenate([known, *parts], axis=1)
        edges = [(a, b) for a, b in forest(len(rows), pairs[0], pairs[1]) if own[a] or own[b]]
        return pd.DataFrame([(node[a], node[b]) for a, b in edges], columns=["u", "v"], dtype="int64")
    return run


def middle_edges(classes: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) that connect the sets of each list (key, node, hub) which may link."""
    marked = lists.select("key", "node", (F.col("node") == F.col("hub")).alias("tied"))
    hubs = lists.sparkSession.createDataFrame([], "u long, v long")
    for number in range(HUBS):  # the least set, then others that are tied to it
        chosen = F.max_by("node", F.xxhash64("node", F.lit(number)))
        hub = marked.where("tied").groupBy("key").agg(chosen.alias("hub"), F.count("*").alias("n"))
        hub = hub.where(F.lit(number == 0) | (F.col("n") > 1)).drop("n")
        found = staged(possible_pairs(classes, marked.where("NOT tied").join(hub, "key").select(
            F.col("node").alias("u"), F.col("hub").alias("v")).distinct(), percent), "hubs")
        mark = found.select(F.col("u").alias("node"), F.col("v").alias("hub"), F.lit(True).alias("near"))
        marked = staged(marked.join(hub, "key", "left").join(mark, ["node", "hub"], "left").select(
            "key", "node", (F.col("tied") | F.col("near").isNotNull()).alias("tied")), "marked")
        hubs = hubs.unionByName(found)
    rest = marked.where("NOT tied").groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    groups = (marked.join(rest, "key")
              .withColumn("mine", F.when(F.col("tied"), -1).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
              .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"))
    of = classes.select(F.col("class").alias("node"), "n_shingles", "ranges")
    return hubs.unionByName(groups.join(of, "node").groupBy("key", "b").applyInPandas(_rest_forest(percent), "u long, v long"))


def block_pairs(groups: DataFrame, block: int, elements: int | None = None) -> DataFrame:
    """Each row (node, component, ...) with its block (mine) and every pair of blocks (a, b) of its component that
    it is compared in; a = b is a block by itself.

    A block has about ``block`` nodes at most, and sets of about ``elements``
    elements (column ``n_shingles``) in all.
    """
    size = F.count("*") / block
    if elements:
        size = F.greatest(size, F.sum("n_shingles") / elements)
    sizes = groups.groupBy(F.col("component").alias("of")).agg(F.ceil(size).cast("int").alias("blocks"))
    return (groups.join(sizes, F.col("component") == F.col("of"))
            .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*groups.columns, "mine", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b")))


def possible_edges(classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) that connect the nodes of each group (node, component) which may link."""
    of = classes.select(F.col("class").alias("node"), "n_shingles", "ranges")
    return block_pairs(groups, BLOCK).join(of, "node").groupBy("component", "a", "b").applyInPandas(
        _possible_forest(percent), "u long, v long")


def verified_links(texts: DataFrame, classes: DataFrame, candidates: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Edges (u, v) of linked classes that join all that are linked within each candidate component."""
    chosen = candidates.join(classes.select(F.col("class").alias("node"), "rep", "n_shingles"), "node")
    number, members = candidates.count(), None
    if number * MEMBER_BITS <= MOST_BITS:
        bits = max(1 << 16, 1 << max(0, int(number * MEMBER_BITS - 1).bit_length()))
        members = texts.sparkSession.sparkContext.broadcast(member_bitmap(chosen.select(F.col("rep").alias("row")), bits))
    else:  # too many for a bitmap: only their texts go on
        texts = texts.join(chosen.select(F.col("rep").alias("row")).distinct(), "row", "left_semi").select(*texts.columns)
    sets = texts.mapInArrow(_sets_of(shingle, members), "row long, class long, members binary")
    filled = block_pairs(chosen, SET_BLOCK, ELEMENTS).join(
        sets, (F.col("rep") == F.col("row")) & (F.col("node") == F.col("class")))
    return filled.select("component", "a", "b", "mine", "node", "members").groupBy("component", "a", "b").applyInPandas(
        _verify(percent), "u long, v long")


def numbered_rows(docs: DataFrame) -> Column:
    """A number of a row that follows from its id and text, so that it is the same in every scan."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def _grouped(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """row, doc_id, n_shingles and component (a class; null for an empty set) of every row."""
    texts = documents(docs).withColumn("row", numbered_rows(docs))
    profiles = staged(texts.mapInArrow(
        _profiles(shingle), "row long, doc_id long, n_shingles long, class long, ranges binary, chunk int, counts binary"), "profiles")
    rows = profiles.where("n_shingles IS NOT NULL").select("row", "doc_id", "n_shingles", "class", "ranges")
    full = rows.where("n_shingles > 0")
    classes = staged(full.groupBy("class", "n_shingles").agg(F.min("row").alias("rep"),
                                                        F.first("ranges").alias("ranges")), "classes")
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(_CLASS)))
    sizes = {r["least"]: r["n"] for r in classes.groupBy(level.alias("level")).agg(
        F.min("n_shingles").alias("least"), F.count("*").alias("n")).collect()}  # some hundred size classes
    boundary = cost_boundary(sizes, percent)
    ties = candidate_ties(texts, classes, shingle, percent, boundary, rarity(profiles))
    candidates = staged(components(ties), "candidates")
    found = components(verified_links(texts, classes, candidates, shingle, percent))
    by_class = found.select(F.col("node").alias("class"), "component")
    return (full.join(by_class, "class", "left")
            .select("row", "doc_id", "n_shingles", F.coalesce("component", "class").alias("component"))
            .unionByName(rows.where("n_shingles = 0").select("row", "doc_id", "n_shingles", F.lit(None).cast("long").alias("component"))))


def jaccard_groups(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id (least id reachable by links) of every row."""
    rows = staged(_grouped(docs, shingle, percent), "groups")
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = rows.where("component IS NOT NULL").join(least, "component").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(rows.where("component IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


#: Rows whose numbers are broadcast at most (16 bytes each).
BROADCAST_ROWS = 1 << 20


def one_of_each_group(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rows of ``docs``, unchanged, of which each group keeps one: that of the least id.

    Rows without an id come after the others.  Only rows whose own text is linked to that of the kept
    one go; rows without a shingle are in no group and stay.  Of rows that repeat both
    id and text one stays.
    """
    groups = staged(_grouped(docs, shingle, percent).where("component IS NOT NULL"), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0)).alias("id"), "row")
    kept = groups.groupBy("component").agg(F.min(first)["row"].alias("kept"))
    gone = staged(groups.join(kept, "component").where("row <> kept").select(
        F.col("row").alias("_row"), F.col("doc_id").alias("_id")).distinct(), "gone")
    again = staged(groups.groupBy("row", "doc_id").count().where("count > 1").select(
        F.col("row").alias("_row"), F.col("doc_id").alias("_id")), "again")

    def among(rows: DataFrame, marked: DataFrame, how: str) -> DataFrame:
        same = (numbered_rows(rows) == F.col("_row")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
        few = marked.count() <= BROADCAST_ROWS
        return rows.join(F.broadcast(marked) if few else marked, same, how)

    left = among(docs, gone, "left_anti")
    if again.isEmpty():
        return left
    single = (among(left, again, "left_semi").select(F.struct("*").alias("doc"))
              .groupBy(F.col("doc.doc_id"), F.col("doc.text")).agg(F.first("doc").alias("doc")).select("doc.*"))
    return among(left, again, "left_anti").unionByName(single)


def op10_size_aware_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 3-word shingles, linked at Jaccard 0.9."""
    return jaccard_groups(table(spark, sf_dir, "documents"), 3, 90)


QUERIES = {"op10_size_aware_join": op10_size_aware_join}

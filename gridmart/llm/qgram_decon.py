"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared by their letters and digits in lower case, so case, spacing
and punctuation do not matter.  A passage of n characters may differ by
n // ``BUDGET`` edits.  By the q-gram lemma a region within e edits of it shares
at least n + 1 - q * (e + 1) of the passage's q-grams, all on e + 1 neighbouring
diagonals.  Shared q-grams are counted in bands of 2 * (e + 1) diagonals that
overlap by half, so every such group of diagonals lies whole in a band; bands
that reach the count are verified by banded alignment of the whole passage.

A benchmark item is one passage; one longer than ``LONGEST`` characters is every
window of that length, ``STEP`` characters apart, the last one at its end.  So
that quotes of a part are found too, the windows of ``PIECE`` characters of longer
items are passages as well.  The least quote that is found for certain has
``PIECE`` + ``STEP`` - 1 = 255 letters and digits (about 50 words), within the edits
of the window in it; of shorter items all is to be quoted.
Items are taken in groups whose q-grams number about ``GROUP_GRAMS``, a bound
on what is broadcast; each group is one pass over all documents.

Q-grams are compared by the low bytes of their characters; verification
compares whole characters.

Cases: null or empty texts match nothing; a passage too short to share a q-gram
within its budget has a smaller budget (0 at least), one shorter than q
characters is not searched for; equal items match each; of several places the
one of the longest passage, then with the fewest edits, then the first, is reported; repeated documents are
reported each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.characters import code_points, byte_grams, holds, in_groups
from gridmart.llm.common import documents, table

Q = 8
BUDGET = 10
LONGEST = 512
PIECE = 192
STEP = 64
GROUP_GRAMS = 1 << 21
#: Zeros between texts, more than any budget, so that no alignment spans two texts.
GAP = LONGEST // BUDGET + 2
FOUND = "doc_id long, item_id long, start long, stop long, edits int"
_SLOTS = 20


def allowed_edits(n: int) -> int:
    """The edits a passage of n characters may have, with at least one shared q-gram required."""
    return max(0, min(n // BUDGET, (n - Q) // Q))


def cuts(n: int) -> list[tuple[int, int]]:
    """(from, to) of the passages of an item of n characters."""
    out = [(0, n)] if n <= LONGEST else []
    for size in (LONGEST, PIECE):
        if n > size:
            out += [(at, at + size) for at in (*range(0, n - size, STEP), n - size)]
    return out


class Passages:
    """Passages of benchmark items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.codes = [], []
        for item, text in items:
            codes, _ = code_points([text], 0)
            kept = codes[holds("isalnum", codes)]
            for at, to in cuts(len(kept)) if len(kept) >= Q else ():
                self.items.append(item)
                self.codes.append(kept[at:to])
        lengths = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = np.array([allowed_edits(n) for n in lengths], dtype=np.int64)
        self.least = np.maximum(1, lengths + 1 - Q * (self.edits + 1))
        grams = [byte_grams(c, Q) for c in self.codes]
        every = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, dtype=np.int64)
        order = np.argsort(every, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.grams, self.first, self.often = np.unique(every[order], return_index=True, return_counts=True)
        self.slots = np.zeros(1 << _SLOTS, dtype=bool)
        self.slots[(self.grams >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True

    def regions(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(passage, first diagonal of a band) that share enough q-grams with ``codes``."""
        grams = byte_grams(codes, Q)
        at = np.flatnonzero(self.slots[(grams >> np.uint64(64 - _SLOTS)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            return []
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        good = self.grams[found] == grams[at]
        at, found = at[good], found[good]
        often = self.often[found]
        if not often.sum():
            return []
        entry = np.repeat(self.first[found] - np.concatenate([[0], np.cumsum(often)[:-1]]), often) + np.arange(often.sum())
        owner = self.owner[entry]
        step = self.edits[owner] + 1
        band = (np.repeat(at, often) - self.place[entry] + LONGEST) // step
        keys = (owner << 32) + band
        # A hit lies in its own band and in the one that began a step earlier.
        keys, places = np.concatenate([keys, keys - 1]), np.concatenate([self.place[entry]] * 2)
        bands, counts = np.unique(keys, return_counts=True)
        bands = bands[counts >= self.least[bands >> 32]]
        if not len(bands):
            return []
        enough = bands[np.minimum(np.searchsorted(bands, keys), len(bands) - 1)] == keys
        # A q-gram of the passage counts once in a band, however often the text has it.
        bands, counts = np.unique(np.unique(keys[enough] * LONGEST + places[enough]) // LONGEST, return_counts=True)
        owner = bands >> 32
        bands, owner = (x[counts >= self.least[owner]] for x in (bands, owner))
        first = (bands & ((1 << 32) - 1)) * (self.edits[owner] + 1) - LONGEST
        return list(zip(owner.tolist(), first.tolist(), strict=True))

    def matches(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(passage, start, stop, edits) of passages found in ``codes``."""
        out = []
        for passage, diagonal in self.regions(codes):
            n, edits = len(self.codes[passage]), int(self.edits[passage])
            low = max(0, diagonal - edits)
            region = codes[low:diagonal + 2 * (edits + 1) + n + edits]
            found = aligned(self.codes[passage], region, edits)
            if found:
                out.append((passage, low + found[0], low + found[1], found[2]))
        return out


def best_end(passage: np.ndarray, region: np.ndarray, anchored: bool) -> tuple[int, int]:
    """Fewest edits between the passage and a part of the region, and where that part first ends.

    With ``anchored`` the part begins where the region does.
    """
    width = np.arange(len(region) + 1)
    row = width.copy() if anchored else np.zeros(len(region) + 1, dtype=np.int64)
    for k, code in enumerate(passage, 1):
        new = np.empty_like(row)
        new[0] = k
        new[1:] = np.minimum(row[:-1] + (region != code), row[1:] + 1)
        row = np.minimum.accumulate(new - width) + width
    end = int(np.argmin(row))
    return int(row[end]), end


def aligned(passage: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """(start, stop, edits) of the best place of the passage in the band's region, within the budget."""
    at = region.tobytes().find(passage.tobytes())
    if at >= 0 and at % region.itemsize == 0:
        return at // region.itemsize, at // region.itemsize + len(passage), 0
    edits, end = best_end(passage, region, anchored=False)
    if edits > budget:
        return None
    back = region[max(0, end - len(passage) - edits):end][::-1]
    _, length = best_end(passage[::-1], back, anchored=True)
    return end - length, end, edits


def found_in(passages: Passages, texts: list[str]):
    """(text, item, start, stop, edits): the best place of each item in each text, in code points."""
    for at, to in in_groups(texts):
        codes, starts = code_points(texts[at:to], GAP)
        places = np.flatnonzero(holds("isalnum", codes) | (codes == 0))
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for passage, start, stop, edits in passages.matches(codes[places]):
            if stop <= start:
                continue
            first, last = int(places[start]), int(places[stop - 1]) + 1
            doc = int(np.searchsorted(starts, first, side="right")) - 1
            key = (at + doc, passages.items[passage])
            value = (-len(passages.codes[passage]), edits, first - int(starts[doc]), last - int(starts[doc]))
            best[key] = min(best.get(key, value), value)
        for (doc, item), (_, edits, start, stop) in sorted(best.items()):
            yield doc, item, start, stop, edits


def passage_groups(benchmark: DataFrame):
    """The items in groups of bounded size, each as broadcast passages."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
                             ).where("length(text) >= 1")
    length = F.length("text")  # a character lies in as many passages at most
    often = F.when(length <= PIECE, 1).when(length <= LONGEST, 2 + PIECE // STEP).otherwise((LONGEST + PIECE) // STEP + 2)
    size = items.agg(F.sum(length * often)).first()[0] or 0
    count = -(-size // GROUP_GRAMS)
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()  # about GROUP_GRAMS q-grams
        yield benchmark.sparkSession.sparkContext.broadcast(
            Passages(sorted((r["item_id"] if r["item_id"] is not None else -1, r["text"]) for r in rows)))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, start, stop, edits."""
    out = docs.sparkSession.createDataFrame([], FOUND)
    for passages in passage_groups(benchmark):
        def search(batches, passages=passages):
            for batch in batches:
                ids = batch["doc_id"].to_pylist()
                rows = [(ids[doc], *rest) for doc, *rest in found_in(passages.value, batch["text"].to_pylist())]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int32() if k == 4 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))],
                        names=["doc_id", "item_id", "start", "stop", "edits"])
        out = out.unionByName(documents(docs).mapInArrow(search, FOUND))
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, in whose text no item is found."""
    for passages in passage_groups(benchmark):
        def keep(batches, passages=passages):
            for batch in batches:
                bad = {doc for doc, *_ in found_in(passages.value, [t or "" for t in batch["text"].to_pylist()])}
                yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_()))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op8_qgram_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in any document."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op8_qgram_decon": op8_qgram_decon}

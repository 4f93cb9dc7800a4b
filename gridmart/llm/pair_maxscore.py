"""Ranked lexical search by MaxScore with bounds of term pairs.

Documents are indexed in blocks; a block's postings hold the terms that any query
has (the others are only counted for the lengths).  From the corpus-wide counts
each term gets its weight.  The terms of a query are paired by weight, neighbours
together, and every block stores, besides each term's maximum impact, each pair's
intersection list and its joint maximum, the most that one document gets
from both terms.

A document gets from a pair at most the larger of the joint maximum and the two
single maxima, which is less than their sum wherever the pair never meets in
full.  A query takes these bounds together: pairs whose bounds in all stay
below the score of the k-th best document so far bring no candidates
(MaxScore's non-essential part, made longer by the tighter bounds).  Of further pairs whose
*single* maxima still fit under that score, only the intersection list brings
candidates.  Candidates are completed from the greatest bound down and dropped
as soon as what is left cannot lift them.  The k-th score goes from block to
block within a task; tasks' lists are merged in two steps.

Terms are the maximal runs of ASCII letters and digits and of all other
non-ASCII characters; only A-Z are lower-cased.  They are told apart by 64-bit
hashes.  Scores are whole numbers; see ``Model`` for the formula.

Queries are taken in groups of about ``GROUP_BYTES`` of text, a bound on what is
broadcast; each group is one pass over the documents.

Cases: null or empty texts have no terms, neither find nor are found; each row
of either table counts by itself, so repeated documents rank beside each other and a
repeated item is answered twice; equal scores rank by id, a null id last; a null item id
is kept; a text of any length is read in runs; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.llm.block_dictionary import grouped
from gridmart.llm.common import as_bytes, documents, packed, scrambled, staged, table, unpacked

#: UTF-8 bytes of the queries answered in one pass.
GROUP_BYTES = 1 << 23
#: UTF-8 bytes of text in a block, and those that are split into terms at once.
BLOCK_BYTES = 12 << 20
RUN_BYTES = 1 << 20
#: Lists of the tasks are merged in so many parts before the last ranking.
PARTS = 64
_SLOTS = 20

_TERM = np.zeros(256, dtype=bool)
_TERM[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0xD1342543DE82EF95)

POSTINGS = ("n_docs long, n_terms long, ids binary, known binary, lengths binary, "
            "terms binary, sizes binary, places binary, often binary")
BOUNDED = POSTINGS + ", maxima binary, pairs binary, pair_sizes binary, pair_places binary, joint binary"
HITS = "item int, item_id long, doc_id long, score long"


def term_runs(data: bytes):
    """(hashes, first bytes) of the terms of a buffer, in runs that end outside a term."""
    raw, at = np.frombuffer(data, dtype=np.uint8), 0
    while at < len(raw):
        to = min(len(raw), at + RUN_BYTES)
        while to < len(raw):  # on to the next byte outside a term
            gap = np.flatnonzero(~_TERM[raw[to:to + 4096]])
            to = to + int(gap[0]) if len(gap) else min(len(raw), to + 4096)
            if len(gap):
                break
        part = raw[at:to]
        inside = _TERM[part]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        starts, lengths = edge[::2], edge[1::2] - edge[::2]
        if len(starts):
            letters = _LOWER[part[inside]]
            first = np.cumsum(lengths) - lengths
            powers = np.full(int(lengths.max()), _BASE, dtype=np.uint64)
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)
            place = np.arange(len(letters)) - np.repeat(first, lengths)
            value = np.add.reduceat(_VALUES[letters] * powers[place], first)
            yield scrambled(value + lengths.astype(np.uint64)), starts + at
        at = to


def distinct_terms(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the terms of one text."""
    found = [hashes for hashes, _ in term_runs(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


class Queries:
    """The items of a group: ids, and distinct terms as places in the sorted ``hashes``."""

    def __init__(self, items: list[tuple[int | None, str]]):
        own = [distinct_terms(text.encode()) for _, text in items]
        self.ids = [item for item, _ in items]
        self.hashes = np.unique(np.concatenate(own)) if own else np.zeros(0, dtype=np.uint64)
        self.terms = [np.searchsorted(self.hashes, h) for h in own]
        self._slots = np.zeros(1 << _SLOTS, dtype=bool)
        self._slots[(self.hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are terms of a query, and their places."""
        at = np.flatnonzero(self._slots[(hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        good = self.hashes[place] == hashes[at]
        return at[good], place[good]


def query_groups(benchmark: DataFrame):
    """The items in groups of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("length(text) >= 1")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // GROUP_BYTES)
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()  # about GROUP_BYTES
        queries = Queries(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda i: (i[0] is None, i)))
        if len(queries.hashes):
            yield queries


def _binary(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], pa.int64() if k < 2 else pa.binary()) for k in range(len(names))], names=names)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def build_index(docs: DataFrame, queries: Queries) -> DataFrame:
    """Postings of the queries' terms, a row for each block of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        for _, part in grouped(batches, BLOCK_BYTES):
            ids, texts = part["doc_id"].to_pylist(), as_bytes(part["text"])
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            lengths = np.zeros(len(texts), dtype=np.int64)
            pairs = []
            for hashes, first in term_runs(b"\n".join(texts)):
                doc = np.searchsorted(starts, first, side="right") - 1
                lengths += np.bincount(doc, minlength=len(texts))
                at, term = shared.value.find(hashes)
                pairs.append((term.astype(np.uint64) << np.uint64(32)) | doc[at].astype(np.uint64))
            joint = np.concatenate(pairs) if pairs else np.zeros(0, dtype=np.uint64)
            joint, often = np.unique(joint, return_counts=True)
            terms, sizes = np.unique((joint >> np.uint64(32)).astype(np.int32), return_counts=True)
            places = (joint & np.uint64(0xFFFFFFFF)).astype(np.int64)
            yield _binary([(int((lengths > 0).sum()), int(lengths.sum()),
                            packed(np.array([i or 0 for i in ids], dtype=np.int64)),
                            packed(np.array([i is not None for i in ids], dtype=np.int8)), packed(lengths), packed(terms),
                            packed(sizes.astype(np.int32)), packed(np.diff(places, prepend=0).astype(np.int32)),
                            packed(often.astype(np.int32)))], _names(POSTINGS))

    return staged(documents(docs).mapInArrow(run, POSTINGS), "postings")


@dataclass
class Model:
    """Corpus-wide counts, term weights, and the queries as pairs of terms.

    A term in ``df`` of N documents weighs w = floor(1000 ln((2N + 2) / (2 df + 1))).
    A document of n terms, of L in all documents, has m = 50 + 50 n N div L, and gets
    w ((10^9 tf) div (1000 tf + 20 m)) for a term that it holds tf times.
    """

    n_docs: int
    n_terms: int
    weights: np.ndarray
    #: Pairs of terms, each once; the units of every query are (first, second or -1, pair or -1).
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), dtype=np.int64))
    units: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, index: DataFrame, queries: Queries) -> Model:
        totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        size = len(queries.hashes)

        def counted(batches):
            df = np.zeros(size, dtype=np.int64)
            for batch in batches:
                for terms, sizes in zip(batch["terms"].to_pylist(), batch["sizes"].to_pylist(), strict=True):
                    df[unpacked(terms, np.int32)] += unpacked(sizes, np.int32)
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

        rows = (index.select("terms", "sizes").mapInArrow(counted, "term long, df long")
                .groupBy("term").agg(F.sum("df").alias("df")).collect())  # the queries' terms at most
        n_docs, weights = totals[0] or 0, np.zeros(size, dtype=np.int64)
        for r in rows:
            weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        model = cls(n_docs, totals[1] or 0, weights)
        model._pair(queries)
        return model

    def _pair(self, queries: Queries) -> None:
        numbers: dict[tuple[int, int], int] = {}
        for terms in queries.terms:
            own = terms[self.weights[terms] > 0]  # others add nothing to any score
            own = own[np.argsort(-self.weights[own], kind="stable")].tolist()
            units = []
            for a, b in zip(own[::2], own[1::2], strict=False):
                a, b = min(a, b), max(a, b)
                units.append((a, b, numbers.setdefault((a, b), len(numbers))))
            if len(own) % 2:
                units.append((own[-1], -1, -1))
            self.units.append(np.array(units, dtype=np.int64).reshape(-1, 3))
        self.pairs = np.array(list(numbers), dtype=np.int64).reshape(-1, 2)

    def impacts(self, term: np.ndarray, often: np.ndarray, length: np.ndarray) -> np.ndarray:
        """What each posting adds to its document's score."""
        m = 50 + (50 * length * self.n_docs) // self.n_terms
        return self.weights[term] * ((1_000_000_000 * often) // (1000 * often + 20 * m))


class Postings:
    """One block of the index, with its impacts."""

    def __init__(self, row: dict, model: Model):
        self.terms = unpacked(row["terms"], np.int32).astype(np.int64)
        sizes = unpacked(row["sizes"], np.int32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.places = np.cumsum(unpacked(row["places"], np.int32).astype(np.int64))
        lengths = unpacked(row["lengths"], np.int64)
        self.n = len(lengths)
        often = unpacked(row["often"], np.int32).astype(np.int64)
        self.impact = model.impacts(np.repeat(self.terms, sizes), often, lengths[self.places])
        self.at = np.full(len(model.weights) + 1, -1, dtype=np.int64)  # the last one stands for no term
        self.at[self.terms] = np.arange(len(self.terms))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, impacts) of a term."""
        k = self.at[term]
        a, b = (self.first[k], self.first[k + 1]) if k >= 0 else (0, 0)
        return self.places[a:b], self.impact[a:b]


def with_bounds(index: DataFrame, model: Model) -> DataFrame:
    """The index with the maximum of each term, and each pair's intersection list and joint maximum."""
    shared = index.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Postings(row, shared.value)
                maxima = np.maximum.reduceat(block.impact, block.first[:-1]) if len(block.terms) else block.impact
                found, sizes, lists, joint = [], [], [], []
                pairs = shared.value.pairs
                for number in np.flatnonzero((block.at[pairs] >= 0).all(axis=1)).tolist():
                    (places, own), (others, theirs) = (block.of(t) for t in pairs[number])
                    k = np.minimum(np.searchsorted(others, places), len(others) - 1)
                    both = np.flatnonzero(others[k] == places)
                    if len(both):
                        found.append(number)
                        sizes.append(len(both))
                        lists.append(places[both])
                        joint.append(int((own[both] + theirs[k[both]]).max()))
                every = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
                yield _binary([(*row.values(), packed(maxima), packed(np.array(found, dtype=np.int32)),
                                packed(np.array(sizes, dtype=np.int32)), packed(np.diff(every, prepend=0).astype(np.int32)),
                                packed(np.array(joint, dtype=np.int64)))], _names(BOUNDED))

    return staged(index.mapInArrow(run, BOUNDED), "bounds")


class Bounded(Postings):
    """One block with its bounds, as dense arrays by term and by pair."""

    def __init__(self, row: dict, model: Model):
        super().__init__(row, model)
        self.ids = unpacked(row["ids"], np.int64)
        self.unknown = unpacked(row["known"], np.int8) == 0
        self.maximum = np.zeros(len(model.weights) + 1, dtype=np.int64)
        self.maximum[self.terms] = unpacked(row["maxima"], np.int64)
        found, sizes = (unpacked(row[c], np.int32).astype(np.int64) for c in ("pairs", "pair_sizes"))
        self.joint = np.zeros(len(model.pairs) + 1, dtype=np.int64)
        self.joint[found] = unpacked(row["joint"], np.int64)
        every = np.cumsum(unpacked(row["pair_places"], np.int32).astype(np.int64))
        ends = np.cumsum(sizes)
        self.lists = {p: every[b - n:b] for p, n, b in zip(found.tolist(), sizes.tolist(), ends.tolist(), strict=True)}

    def search(self, units: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of all documents that reach ``least`` (1 at least)."""
        none = np.zeros(0, dtype=np.int64)
        single = np.maximum(self.maximum[units[:, 0]], self.maximum[units[:, 1]])
        whole = np.maximum(single, self.joint[units[:, 2]])
        order = np.argsort(whole, kind="stable")
        sums = np.cumsum(whole[order])
        free = int(np.searchsorted(sums, least))  # their bounds together stay below ``least``
        if free == len(order):
            return none, none
        rest = order[free:]
        rest = rest[np.argsort(single[rest], kind="stable")]
        half = int(np.searchsorted((sums[free - 1] if free else 0) + np.cumsum(single[rest]), least))
        score = np.zeros(self.n, dtype=np.int64)
        wanted = np.zeros(self.n, dtype=bool)
        for unit in rest[half:]:
            for term in units[unit, :2]:
                places, impact = self.of(term)
                wanted[places] = True
                score[places] += impact
        for unit in rest[:half]:
            wanted[self.lists.get(int(units[unit, 2]), none)] = True
        places = np.flatnonzero(wanted)
        found = score[places]
        later = np.concatenate([rest[:half], order[:free]])
        later = later[np.argsort(-whole[later], kind="stable")]
        left = int(whole[later].sum())
        for unit in later:
            keep = found + left >= least
            places, found = places[keep], found[keep]
            if not len(places):
                break
            for term in units[unit, :2]:
                mine, impact = self.of(term)
                if len(mine):
                    k = np.minimum(np.searchsorted(mine, places), len(mine) - 1)
                    found = found + np.where(mine[k] == places, impact[k], 0)
            left -= int(whole[unit])
        keep = found >= least
        return places[keep], found[keep]


class Best:
    """The best documents of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        none = np.zeros(0, dtype=np.int64)
        self.rows = [(none, none.astype(bool), none) for _ in range(queries)]

    def least(self, query: int) -> int:
        """The score that a document needs to be among the best."""
        scores = self.rows[query][0]
        return max(1, int(scores[-1])) if len(scores) == self.k else 1

    def add(self, query: int, *new: np.ndarray) -> None:
        score, unknown, ids = (np.concatenate([a, b]) for a, b in zip(self.rows[query], new, strict=True))
        order = np.lexsort((ids, unknown, -score))[:self.k]
        self.rows[query] = score[order], unknown[order], ids[order]


def search(bounded: DataFrame, model: Model, queries: Queries, k: int) -> DataFrame:
    """Each task's best documents for each query."""
    context = bounded.sparkSession.sparkContext
    shared, ids = context.broadcast(model), queries.ids

    def run(batches):
        units = shared.value.units
        best = Best(len(units), k)
        for batch in batches:
            for row in batch.to_pylist():
                block = Bounded(row, shared.value)
                for query, own in enumerate(units):
                    if len(own):
                        places, scores = block.search(own, best.least(query))
                        if len(places):
                            best.add(query, scores, block.unknown[places], block.ids[places])
        for query, (scores, unknown, docs) in enumerate(best.rows):
            if len(scores):
                n = len(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, query, dtype=np.int32)), pa.array([ids[query]] * n, pa.int64()),
                     pa.array(docs, mask=unknown), pa.array(scores)], names=["item", "item_id", "doc_id", "score"])

    return bounded.mapInArrow(run, HITS)


def ranked(docs: DataFrame, benchmark: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for queries in query_groups(benchmark):
        index = build_index(docs, queries)
        model = Model.of(index, queries)
        if not model.n_terms:
            continue
        hits = search(with_bounds(index, model), model, queries, k)
        parts = Window.partitionBy("item", "_part").orderBy(*order)
        hits = (hits.withColumn("_part", F.spark_partition_id() % PARTS)
                .withColumn("_nth", F.row_number().over(parts)).where(F.col("_nth") <= k).drop("_part", "_nth"))
        last = hits.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        out = out.unionByName(last.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
    return out


def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


QUERIES = {"op11_pair_maxscore": op11_pair_maxscore}

_TERMS = r"""unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

SQL = {"op11_pair_maxscore": f"""
with words as (select doc_id, {_TERMS} as term from documents),
lengths as (select doc_id, count(*) as n from words group by doc_id),
totals as (select count(*) as docs, cast(sum(n) as bigint) as terms from lengths),
wanted as (select distinct item_id, {_TERMS} as term from benchmark),
postings as (select doc_id, term, count(*) as tf from words semi join wanted using (term) group by doc_id, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from postings, totals group by term, docs),
scores as (
  select item_id, doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) as bigint) as score
  from wanted join postings using (term) join weights using (term) join lengths using (doc_id), totals
  group by item_id, doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
      from scores where score > 0)
where rank <= 50
"""}

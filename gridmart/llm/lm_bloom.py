"""N-gram language model in a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale; an n-gram
at level q is entered q times, as (n-gram, 1) to (n-gram, q), so that its count
is read back by probing levels until one is absent.  The filter is built in
segments by Spark, one range of n-gram hashes each.  A segment has ``EVENT_BITS``
bits for each event it really holds, whatever the size of the corpus, so the
rate of chance hits stays the same; and nobody ever holds the whole filter: the
distinct n-grams of each block of documents go to the tasks that hold their
segments, and the levels read there come back to the blocks.

A word after its predecessor has probability
(c(pair) + mass * p(word)) / (c(predecessor) + mass), where p(word) is the
add-``ADD`` estimate and every count comes from probes.  A pair counts no more
often than either of its words.

The base score is exact: word counts of the whole corpus come back to the blocks
with the levels.  Words are told apart by 63-bit hashes.

Cases: null or empty text is its end token alone; repeated rows are scored
each; a null id falls into the fold of the empty text; an empty table gives no
rows; with no training document all counts are 0; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.block_dictionary import grouped
from gridmart.llm.common import (as_bytes, documents, fold_of, packed, scrambled, staged, table, tasks, unpacked,
                                 word_hashes)

#: Bytes of text that are worked on at once (about 40 times as much memory).
BLOCK_BYTES = 5 << 20
#: Bits of the filter for an event.
EVENT_BITS = 8.0
#: Ratio of quantisation levels.
RATIO = 1.5
ADD = 0.1
#: Weight of the word estimate in the estimate of a pair.
MASS = 200.0
#: Hashes of the marks before the first and after the last word.
BEGIN = np.uint64(0x5BF03635DCD1B8F1)
END = np.uint64(0xA24BAED4963EE407)

SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
BLOCKS = "block long, docs array<binary>"
KEYS = "block long, bucket int, keys binary, counts binary"
LEVELS = "block long, bucket int, levels binary, words binary, n long, v long, distinct long"
_ONE = np.uint64(1)


def _levels() -> np.ndarray:
    """Least count of each level, up to 10**15."""
    out = [1]
    while out[-1] < 10 ** 15:
        out.append(max(out[-1] + 1, int(np.ceil(RATIO ** len(out)))))
    return np.array(out, dtype=np.int64)


LEAST = _levels()
#: The count that a level stands for: the middle of its counts (level 0: none).
MEANING = np.concatenate([[0.0], (LEAST[:-1] + LEAST[1:] - 1) / 2.0])


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised counts, from 1."""
    return np.searchsorted(LEAST, counts, side="right")


def word_keys(words: np.ndarray) -> np.ndarray:
    """Keys of single words (even)."""
    return scrambled(words ^ np.uint64(0x632BE59BD9B4E019)) & ~_ONE


def pair_keys(words: np.ndarray) -> np.ndarray:
    """Keys of neighbouring words (odd)."""
    return keys_of_pairs(words[:-1], words[1:])


def keys_of_pairs(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Keys of pairs of words (odd)."""
    return scrambled(before * np.uint64(0xD1342543DE82EF95) + scrambled(after)) | _ONE


def marked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with both marks around each text, and where each text begins."""
    words, bounds = word_hashes(texts)
    n = len(texts)
    out = np.empty(len(words) + 2 * n, dtype=np.uint64)
    starts = bounds + 2 * np.arange(n + 1)
    inner = np.ones(len(out), dtype=bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    out[inner] = words
    out[starts[:-1]], out[starts[1:] - 1] = BEGIN, END
    return out, starts


def _event(keys: np.ndarray, level: int, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Filter word and the three bits in it for (key, level)."""
    mixed = scrambled(keys + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
    bits = ((_ONE << (mixed & np.uint64(63))) | (_ONE << ((mixed >> np.uint64(6)) & np.uint64(63)))
            | (_ONE << ((mixed >> np.uint64(12)) & np.uint64(63))))
    return (mixed >> np.uint64(18)) % sizes, bits


def segment(keys: np.ndarray, levels: np.ndarray, bits_per_event: float) -> np.ndarray:
    """The filter words that hold the given keys at the given levels."""
    size = np.uint64(max(1, int(np.ceil(levels.sum() * bits_per_event / 64))))
    out = np.zeros(int(size), dtype=np.uint64)
    level = 1
    while len(keys):
        at, bits = _event(keys, level, size)
        np.bitwise_or.at(out, at.astype(np.int64), bits)
        keys, levels = keys[levels > level], levels[levels > level]
        level += 1
    return out


class Filter:
    """Segments of filter words in a row, found by the high bits of a key."""

    def __init__(self, segments: list[np.ndarray], shift: int):
        self.shift = np.uint64(shift)
        self.sizes = np.array([len(s) for s in segments], dtype=np.uint64)
        self.starts = np.concatenate([[0], np.cumsum([len(s) for s in segments])[:-1]]).astype(np.int64)
        self.words = np.concatenate(segments)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels read by repeated membership probes."""
        out = np.zeros(len(keys), dtype=np.int64)
        alive = np.arange(len(keys))
        part = (keys >> self.shift).astype(np.int64)
        starts, sizes = self.starts[part], self.sizes[part]
        level = 1
        while len(alive) and level < len(MEANING):
            at, bits = _event(keys, level, sizes)
            hit = (self.words[starts + at.astype(np.int64)] & bits) == bits
            alive, keys, starts, sizes = alive[hit], keys[hit], starts[hit], sizes[hit]
            out[alive] = level
            level += 1
        return out

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts."""
        return MEANING[self.levels(keys)]


def _levels(rows: pd.DataFrame) -> pd.DataFrame:
    """The levels of one segment's n-grams and the exact counts of its words, for each block that has them.

    The segment is built here.
    """
    own = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in rows["keys"]]
    ends = np.cumsum([len(x) for x in own])[:-1]
    keys, at = np.unique(np.concatenate(own), return_inverse=True)
    totals = np.zeros(len(keys), dtype=np.int64)
    np.add.at(totals, at, np.concatenate([unpacked(x, np.int32) for x in rows["counts"]]).astype(np.int64))
    learned, words = totals > 0, (keys & _ONE) == 0
    with np.errstate(over="ignore"):
        made = Filter([segment(keys[learned], level_of(totals[learned]), EVENT_BITS)], 64)
        levels = made.levels(keys).astype(np.int8)
        base = words & (keys != word_keys(np.array([BEGIN]))[0])  # the base knows no mark before the text
    first = np.arange(len(rows)) == 0
    return pd.DataFrame({
        "block": rows["block"], "bucket": rows["bucket"], "levels": [packed(levels[x]) for x in np.split(at, ends)],
        "words": [packed(totals[x[words[x]]]) for x in np.split(at, ends)], "n": np.where(first, totals[base].sum(), 0),
        "v": np.where(first, np.count_nonzero(totals[base]), 0),
        "distinct": np.where(first, np.count_nonzero(learned & words), 0)})


def chain_scores(place: np.ndarray, starts: np.ndarray, single: np.ndarray, pair: np.ndarray, tokens: int,
                 distinct: int, mass: float) -> np.ndarray:
    """log10 probability of each text: places of its marked words, counts of the words and of neighbours."""
    unigram = (single + ADD) / (tokens + ADD * (distinct + 1))
    before, after = place[:-1], place[1:]
    pair = np.minimum(pair, np.minimum(single[before], single[after]))
    logs = np.log10((pair + mass * np.minimum(unigram[after], 1.0)) / (single[before] + mass))
    logs = np.append(logs, 0.0)
    logs[starts[1:] - 1] = 0.0  # from one text's end to the next one's begin
    return np.add.reduceat(logs, starts[:-1]) if len(starts) > 1 else np.zeros(0)


def text_scores(words: np.ndarray, starts: np.ndarray, model: Filter, tokens: int, distinct: int,
                mass: float) -> np.ndarray:
    """log10 probability of each text, given its marked words."""
    vocabulary, place = np.unique(words, return_inverse=True)
    return chain_scores(place, starts, model.counts(word_keys(vocabulary)), model.counts(pair_keys(words)), tokens,
                        distinct, mass)


class Ngrams:
    """The distinct n-grams of a block: their sorted keys, and where they stand."""

    def __init__(self, vocabulary: np.ndarray, place: np.ndarray, starts: np.ndarray):
        #: Words that have a next one in their text, and which distinct pair each begins.
        self.inside = np.delete(np.arange(len(place) - 1), starts[1:-1] - 1)
        pairs, self.which = np.unique((place[self.inside].astype(np.uint64) << np.uint64(32))
                                      | place[self.inside + 1].astype(np.uint64), return_inverse=True)
        with np.errstate(over="ignore"):
            self.keys, rank = np.unique(np.concatenate([word_keys(vocabulary), keys_of_pairs(
                vocabulary[(pairs >> np.uint64(32)).astype(np.int64)],
                vocabulary[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)])]), return_inverse=True)
        #: Places among the keys of the words of the vocabulary and of the distinct pairs.
        self.words, self.pairs = rank[:len(vocabulary)], rank[len(vocabulary):]


def _encode(batches):
    """Blocks of documents: distinct words, and the places of all marked words among them."""
    for number, part in grouped(batches, BLOCK_BYTES):
        with np.errstate(over="ignore"):
            words, starts = marked(as_bytes(part["text"].combine_chunks()))
        vocabulary, place = np.unique(words, return_inverse=True)
        ids = part["doc_id"].to_pylist()
        arrays = [np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids], dtype=np.int8),
                  part["held_out"].to_numpy().astype(np.int8), np.diff(starts, prepend=0), place.astype(np.int32),
                  np.diff(vocabulary, prepend=np.uint64(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([[packed(a) for a in arrays]], pa.list_(pa.binary()))],
            names=["block", "docs"])


def _decoded(arrays: list[bytes]):
    """What ``_encode`` packed: ids, whether known, whether held out, bounds, places, vocabulary."""
    ids, known, held, starts, place, vocabulary = (unpacked(x, t) for x, t in zip(
        arrays, [np.int64, np.int8, np.int8, np.int64, np.int32, np.uint64], strict=True))
    return ids, known, held != 0, np.cumsum(starts), place, np.cumsum(vocabulary, dtype=np.uint64)


def _keys(shift: int):
    """The n-grams of each block with their training counts, split by the segments of the filter."""
    def run(batches):
        for batch in batches:
            for block, arrays in zip(batch["block"].to_pylist(), batch["docs"], strict=True):
                _, _, held, starts, place, vocabulary = _decoded(arrays.as_py())
                grams = Ngrams(vocabulary, place, starts)
                training = np.repeat(~held, np.diff(starts))
                counts = np.zeros(len(grams.keys), dtype=np.int32)
                np.add.at(counts, grams.words, np.bincount(place[training], minlength=len(vocabulary)).astype(np.int32))
                np.add.at(counts, grams.pairs, np.bincount(grams.which[training[grams.inside]],
                                                           minlength=len(grams.pairs)).astype(np.int32))
                names, at = np.unique((grams.keys >> np.uint64(shift)).astype(np.int64), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(names), pa.int64()), pa.array(names, pa.int32()),
                     pa.array([packed(np.diff(k, prepend=np.uint64(0))) for k in np.split(grams.keys, at[1:])], pa.binary()),
                     pa.array([packed(c) for c in np.split(counts, at[1:])], pa.binary())],
                    names=["block", "bucket", "keys", "counts"])
    return run


def _scored(n: int, v: int, distinct: int, mass: float):
    """Scores of the documents of a block, given the levels and counts that came back to it."""
    def run(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        ids, known, held, starts, place, vocabulary = _decoded(docs["docs"].iloc[0])
        grams, found = Ngrams(vocabulary, place, starts), found.sort_values("bucket")
        value = MEANING[np.concatenate([unpacked(x, np.int8) for x in found["levels"]])]
        count = np.zeros(len(value), dtype=np.int64)
        count[(grams.keys & _ONE) == 0] = np.concatenate([unpacked(x, np.int64) for x in found["words"]])
        count = count[grams.words]
        pair = np.zeros(len(place) - 1)
        pair[grams.inside] = value[grams.pairs][grams.which]
        score = chain_scores(place, starts, value[grams.words], pair, n, distinct, mass)
        owner = np.repeat(np.arange(len(ids)), np.diff(starts) - 1)
        place = np.delete(place, starts[:-1])
        whole = lambda x: np.bincount(owner, weights=x, minlength=len(ids))
        return pd.DataFrame({
            "doc_id": pd.Series(pd.arrays.IntegerArray(ids, known == 0)), "held_out": held,
            "n_tokens": np.diff(starts) - 1, "n_known": whole(count[place] > 0).astype(np.int64),
            "train_tokens": np.int64(n), "base_score": whole(np.log10((count + ADD) / (n + ADD * (v + 1)))[place]),
            "score": score})
    return run


def score_documents(docs: DataFrame, folds: int = 10, mass: float = MASS) -> DataFrame:
    """Base and model scores of all documents; those of fold 0 are held out of training."""
    texts = documents(docs).withColumn("held_out", fold_of(F.col("doc_id"), folds) == 0)
    wide = max(5, (2 * tasks(docs)).bit_length())
    blocks = staged(texts.mapInArrow(_encode, BLOCKS), "blocks")
    levels = staged(blocks.mapInArrow(_keys(64 - wide), KEYS).groupBy("bucket").applyInPandas(_levels, LEVELS), "levels")
    n, v, distinct = (x or 0 for x in levels.agg(F.sum("n"), F.sum("v"), F.sum("distinct")).first())
    found = levels.select("block", "bucket", "levels", "words")
    return (blocks.groupBy("block").cogroup(found.groupBy("block"))
            .applyInPandas(_scored(n, v, distinct, mass), SCORED))


def op1_lm_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learning from nine folds of ten."""
    return score_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op1_lm_bloom": op1_lm_bloom}

"""Language identification by mixture inference.

Each language is a distribution over hashed letter trigrams, counted over all
labelled texts outside the held-out fold.  A document is taken as a mixture:
expectation-maximisation estimates what share of its trigrams each language
gave.  Languages are then taken in the order of their shares, refitted, for as
long as each one more raises the likelihood by more than ``PENALTY`` times the
logarithm of the number of trigrams.  The prediction is the largest share, the
score is that share.

Every label is learned.  The learned table holds, for each of 2**15 buckets, the
labels that have it and how often.

Cases: null text, or text without a letter, is ``und`` with score 0, as is any
text when nothing could be learned (``keep_identified`` then keeps every text
that has a letter); equal shares go to the label first in the
alphabet; repeated rows are predicted each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.characters import code_points, gram_hashes, holds, in_groups
from gridmart.llm.common import documents, fold_of, packed, slices, table, unpacked

BUCKETS = 1 << 15
#: Labels whose counts a task holds at once.
LANGUAGES = 256
ROUNDS = 12
PENALTY = 2.0
UNKNOWN = "und"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_CHUNK = 2048
_SMOOTHING = 0.3


def trigram_buckets(texts: list[str]):
    """For each text the buckets of its letter trigrams (other characters are one blank)."""
    for at, to in in_groups(texts):
        codes, starts = code_points(texts[at:to], 3)
        letter = holds("isalpha", codes)
        kept = letter | np.concatenate([[False], letter[:-1]]) | (codes == 0)
        short = np.where(letter, codes, np.where(codes == 0, 0, 32))[kept]
        grams = (gram_hashes(short, 3) >> np.uint64(64 - 15)).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(kept)])
        blank = np.concatenate([[0], np.cumsum(letter)])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if blank[b] == blank[a]:  # no letter
                yield np.zeros(0, dtype=np.int64)
            else:  # with one zero after the text as its right edge
                yield grams[before[a]:max(before[a] + 1, before[b] - 4)]


def _counts(batches):
    """Rows (lang, chunk, counts) of the trigrams of one task's labelled texts."""
    def rows():
        out = [(lang, c, packed(t[c * _CHUNK:(c + 1) * _CHUNK])) for lang, t in total.items() if t.any()
               for c in range(BUCKETS // _CHUNK)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.string(), pa.int32(), pa.binary()], strict=True)],
                names=["lang", "chunk", "counts"])
        total.clear()

    total: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for lang, buckets in zip(batch["lang"].to_pylist(), trigram_buckets(batch["text"].to_pylist()), strict=True):
            if lang not in total and len(total) >= LANGUAGES:
                yield from rows()
            total[lang] = total.get(lang, 0) + np.bincount(buckets, minlength=BUCKETS)
    yield from rows()


def _sums(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(unpacked(x, np.int64) for x in rows["counts"])
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "chunk": rows["chunk"].iloc[:1], "counts": [packed(total)]})


class Model:
    """Trigram probabilities by language."""

    def __init__(self, labels: list[str], counts: np.ndarray):
        """``counts`` of each label (a row) and bucket."""
        self.labels = labels
        self._keep(*np.nonzero(counts), counts[np.nonzero(counts)])

    @classmethod
    def of(cls, labels: list[str], label: np.ndarray, bucket: np.ndarray, often: np.ndarray) -> Model:
        """From the counts that are not zero."""
        model = cls.__new__(cls)
        model.labels = labels
        model._keep(label, bucket, often)
        return model

    def _keep(self, label: np.ndarray, bucket: np.ndarray, often: np.ndarray) -> None:
        whole = np.bincount(label, weights=often, minlength=len(self.labels)) + _SMOOTHING * BUCKETS
        self.rest = _SMOOTHING / whole
        order = np.argsort(bucket, kind="stable")
        self.label, self.value = label[order].astype(np.int32), ((often + _SMOOTHING) / whole[label])[order]
        self.first = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))

    def chance(self, there: np.ndarray) -> np.ndarray:
        """Probabilities of the buckets ``there``, a row for each label."""
        out = np.repeat(self.rest[:, None], len(there), axis=1)
        sizes = self.first[there + 1] - self.first[there]
        column = np.repeat(np.arange(len(there)), sizes)
        at = np.arange(len(column)) + np.repeat(self.first[there] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        out[self.label[at], column] = self.value[at]
        return out

    @staticmethod
    def shares(chance: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, float]:
        """Mixture shares of the rows of ``chance``, and the log likelihood."""
        share = np.full(len(chance), 1.0 / len(chance))
        for _ in range(ROUNDS if len(chance) > 1 else 0):
            share = share * (chance @ (often / (share @ chance)))
            share /= share.sum()
        return share, float(often @ np.log(share @ chance))

    def predict(self, buckets: np.ndarray) -> tuple[str, float]:
        """The language of the largest share and that share."""
        if not len(buckets) or not self.labels:
            return UNKNOWN, 0.0
        all_counts = np.bincount(buckets, minlength=BUCKETS)
        there = np.flatnonzero(all_counts)
        often = all_counts[there].astype(np.float64)
        chance = self.chance(there)
        share, _ = self.shares(chance, often)
        order = np.argsort(-share, kind="stable")
        price = PENALTY * np.log(len(buckets) + 1.0)
        best, score = np.ones(1), self.shares(chance[order[:1]], often)[1]
        for k in range(2, len(order) + 1):
            found, likelihood = self.shares(chance[order[:k]], often)
            if likelihood - score <= price:
                break
            best, score = found, likelihood
        top = int(np.argmax(best))
        return self.labels[order[top]], float(best[top])


def learn(texts: DataFrame) -> Model:
    """The model of labelled texts (columns text, lang)."""
    labelled = texts.where("lang IS NOT NULL")
    labels = sorted(r["lang"] for r in labelled.select("lang").distinct().collect())
    at = {label: k for k, label in enumerate(labels)}
    sums = (labelled.select("lang", "text").mapInArrow(_counts, "lang string, chunk int, counts binary")
            .groupBy("lang", "chunk").applyInPandas(_sums, "lang string, chunk int, counts binary"))
    parts = [(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))]
    for r in sums.toLocalIterator():  # only what is not zero is kept
        counts = unpacked(r["counts"], np.int64)
        there = np.flatnonzero(counts)
        parts.append((np.full(len(there), at[r["lang"]], dtype=np.int32), (there + r["chunk"] * _CHUNK).astype(np.int32),
                      counts[there]))
    return Model.of(labels, *map(np.concatenate, zip(*parts, strict=True)))


def training_texts(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """text and lang of the documents that the model may learn from."""
    return docs.where(fold_of(F.col("doc_id").cast("long"), folds) != held).select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))


def identify(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Language and score of all documents; fold ``held`` is not learned from."""
    model = docs.sparkSession.sparkContext.broadcast(learn(training_texts(docs, folds, held)))

    def predict(batches):
        for batch in slices(batches):
            found = [model.value.predict(x) for x in trigram_buckets(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return documents(docs).withColumn("held_out", fold_of(F.col("doc_id"), folds) == held).mapInArrow(predict, PREDICTED)


def keep_identified(docs: DataFrame, least_share: float) -> DataFrame:
    """The rows, unchanged, whose language is known and has at least that share of the text.

    When no label could be learned nothing is known of any text, and those that have a letter stay.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(training_texts(docs, 3, 1)))

    def keep(batches):
        for batch in slices(batches):
            grams = trigram_buckets([t or "" for t in batch["text"].to_pylist()])
            if model.value.labels:
                found = [model.value.predict(x) for x in grams]
                stays = [lang != UNKNOWN and share >= least_share for lang, share in found]
            else:
                stays = [len(x) > 0 for x in grams]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op9_mixture_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {"op9_mixture_langid": op9_mixture_langid}

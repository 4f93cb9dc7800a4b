"""The language model's exact base score and sane model score; language identification."""

import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from gridmart.llm import lm_bloom, mixture_langid


def words(text):
    return [*(text or "").encode().lower().split(), b" end"]


def held(doc, folds):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % folds


def check_base(rows, docs):
    counts = collections.Counter()
    for doc, text in docs:
        if held(doc, 10):
            counts.update(words(text))
    n, v = sum(counts.values()), len(counts)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows)
    want = sorted(((d is None, d or 0), len(words(t)), sum(counts[w] > 0 for w in words(t)),
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 6)) for d, t in docs)
    assert got == want
    assert all(r["train_tokens"] == n and r["held_out"] == (held(r["doc_id"], 10) == 0) for r in rows)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_base_score_odd_rows(odd, odd_rows):
    check_base(lm_bloom.score_documents(odd).collect(), [(r[0], r[1]) for r in odd_rows])


def test_base_score_and_held_out_gain(small_documents):
    rows = lm_bloom.score_documents(small_documents).collect()
    check_base(rows, [(r["doc_id"], r["text"]) for r in small_documents.collect()])
    mine = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)


def test_scores_empty(nothing):
    assert lm_bloom.score_documents(nothing).count() == 0


def filter_of(keys, counts, bits):
    """A filter of two segments, by the highest bit of a key."""
    levels, high = lm_bloom.level_of(counts), keys >> np.uint64(63) == 1
    return lm_bloom.Filter([lm_bloom.segment(keys[h], levels[h], bits) for h in (~high, high)], 63)


def test_filter_reads_back_quantised_counts():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    counts = rng.integers(1, 3000, len(keys))
    with np.errstate(over="ignore"):
        made = filter_of(keys, counts, 10.0)
        read = made.counts(keys)
        absent = made.counts(np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64)))
    assert (read >= counts / 1.6).all()  # never below the level, chance hits may raise it
    assert np.mean(np.abs(read / counts - 1) < 0.5) > 0.9
    assert np.mean(absent > 0) < 0.1


def test_probabilities_sum_to_about_one():
    """Over the vocabulary and one unseen word, after a known word."""
    text = (b"the cat sat on the mat and the dog sat on the rug " * 20).strip()
    with np.errstate(over="ignore"):
        hashes, starts = lm_bloom.marked([text])
        keys, counts = np.unique(np.concatenate([lm_bloom.word_keys(hashes), lm_bloom.pair_keys(hashes)]), return_counts=True)
        model = filter_of(keys, counts, 40.0)
        vocabulary = [b"the", b"cat", b"sat", b"on", b"mat", b"and", b"dog", b"rug", b"unseen"]
        n = len(text.split()) + 1
        total = 0.0
        alone = lm_bloom.text_scores(*lm_bloom.marked([b"the"]), model, n, 9, 5.0)[0]
        assert alone < 0
        for word in vocabulary:
            one, two = lm_bloom.word_hashes([word])[0], lm_bloom.word_hashes([b"the " + word])[0]
            pair = model.counts(lm_bloom.pair_keys(two))[0]
            of = [model.counts(lm_bloom.word_keys(x))[0] for x in (one, two[:1])]
            total += (min(pair, *of) + 5.0 * (of[0] + 0.1) / (n + 1.0)) / (of[1] + 5.0)
    assert 0.7 < total < 1.3


def test_language_accuracy_on_held_out(small_documents):
    rows = mixture_langid.identify(small_documents).collect()
    lang = {r["doc_id"]: r["lang"] for r in small_documents.collect()}
    mine = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and len(mine) > 30
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in mine]) > 0.95
    assert all(0 < r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (held(r["doc_id"], 3) == 1) for r in rows)


def test_language_odd_rows(odd, nothing):
    rows = mixture_langid.identify(odd).collect()
    assert len(rows) == odd.count()
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert unknown == {1, 2, 3, 4}
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert mixture_langid.identify(nothing).count() == 0
    kept = mixture_langid.keep_identified(odd, 0.4)
    assert kept.columns == odd.columns and kept.where("doc_id IN (1, 2, 3, 4)").count() == 0


def test_mixture_shares():
    counts = np.zeros((2, mixture_langid.BUCKETS))
    counts[0, :100], counts[1, 100:200] = 50, 50
    model = mixture_langid.Model(["a", "b"], counts)
    assert model.predict(np.arange(100))[0] == "a"
    lang, share = model.predict(np.concatenate([np.arange(30), np.arange(100, 170)]))
    assert lang == "b" and abs(share - 0.7) < 0.05


def test_chance_hits_do_not_depend_on_the_corpus():
    """Keys that were never added are hit as often in a small segment as in a large one, and added ones always."""
    rng, rates = np.random.default_rng(6), []
    for size in (3000, 300000):
        keys = np.unique(rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64))
        rng.shuffle(keys)
        levels = rng.integers(1, 6, size)
        made = lm_bloom.Filter([lm_bloom.segment(keys[:size], levels, lm_bloom.EVENT_BITS)], 64)
        assert (made.levels(keys[:size]) >= levels).all()
        rates.append((made.levels(keys[size:]) > 0).mean())
    assert max(rates) < 0.06 and abs(rates[0] - rates[1]) < 0.015


def test_every_label_is_learned(spark):
    """With more than 256 labels the rarest one is predicted too."""
    text = lambda k: " ".join(chr(0x4E00 + 7 * k + j) * 3 for j in range(7))
    learned = iter(d for d in range(5000) if held(d, 3) != 1)
    rows = [(next(learned), text(k), f"l{k:03}") for k in range(300) for _ in range(1 if k == 299 else 2)]
    df = spark.createDataFrame([*rows, (9000, text(299), None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in mixture_langid.identify(df).where("doc_id = 9000").collect()] == ["l299"]


def test_documents_stay_when_nothing_is_learned(odd):
    """Without a label only texts without a letter go."""
    kept = mixture_langid.keep_identified(odd.withColumn("lang", F.lit(None).cast("string")), 0.4)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert kept.where("doc_id IN (1, 2, 3, 4)").count() == 0

"""Sharding, packing and token counts against the rules, the library and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridmart.llm import bin_slack, jump_shard, token_counts, tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")


def jump(key, shards):
    bucket, target = -1, 0
    while target < shards:
        bucket, key = target, (key * 2862933555777941757 + 1) % (1 << 64)
        target = int((bucket + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return bucket


def test_jump_hash_equals_the_published_loop(spark):
    keys = [0, 1, -1, 2 ** 62, -(2 ** 63), 2 ** 63 - 1, *range(2, 300, 7)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select(
        "k", *[jump_shard.jump_hash(F.col("k"), n).alias(f"n{n}") for n in (1, 2, 24, 25, 100)]).collect()
    for r in rows:
        for n in (1, 2, 24, 25, 100):
            assert r[f"n{n}"] == jump(r["k"] % (1 << 64), n)


def test_shards_odd_rows(odd, odd_rows):
    rows = jump_shard.assign_shards(odd, 24).collect()
    assert len(rows) == len(odd_rows)
    by_shard: dict = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    null = next(r for r in rows if r["doc_id"] == 1)
    assert (null["size"], null["text_crc32"]) == (8, 0)
    long = next(r for r in rows if r["doc_id"] == 12)
    text = odd_rows[13][1].encode()
    assert (long["size"], long["text_crc32"]) == (len(text) + 8, zlib.crc32(text))


def test_shards_empty(nothing):
    assert jump_shard.assign_shards(nothing, 24).count() == 0


def expected_ids(rows):
    library = tokens.library(JSON)
    return sorted(((r[0] is None, r[0] or 0), library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)


def test_token_counts_odd_rows(odd, odd_rows):
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_tokens"], r["n_bytes"], r["over_limit"])
                 for r in token_counts.count_tokens(odd, JSON, public_tokenizers.PATTERN, 512).collect())
    want = sorted((k, len(ids)) for k, ids in expected_ids(odd_rows))
    assert [(k, n) for k, n, *_ in got] == want
    assert sorted(b for *_, b, _ in got) == sorted(len((r[1] or "").encode()) for r in odd_rows)
    assert all(o == (n > 512) for _, n, _, o in got)


def test_token_counts_empty(nothing):
    assert token_counts.count_tokens(nothing, JSON, public_tokenizers.PATTERN, 512).count() == 0


def test_fast_ids_equal_the_library():
    rng = np.random.default_rng(4)
    texts = ["", " ", "a" * 3000, "<|endoftext|>", "x <|endoftext|>\n y", "\r\n\t   \x1f z", "don't we'LL 12 ½ ²"]
    texts += ["".join(chr(c) for c in rng.integers(0x20, 0x2FFF, 40)) for _ in range(300)]
    texts += ["".join(rng.choice(list("ab '\n\t0é!. "), 30)) for _ in range(300)]
    fast = tokens.byte_bpe(texts, JSON, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tokens.library(JSON)
    for text, ids in zip(texts, fast, strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert len(ids) == sum(len(library.encode(p, add_special_tokens=False).ids)
                               for p in token_counts.pre_tokens(text, public_tokenizers.PATTERN))


def best_sum(counts, room):
    sums = {0}
    for length, often in counts.items():
        sums = {s + length * k for s in sums for k in range(often + 1) if s + length * k <= room}
    return max(sums)


@pytest.mark.parametrize("seed", range(6))
def test_filling_is_closest_to_capacity(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, 60, 9), rng.integers(1, 5, 9), strict=True)}
    for room in (0, 1, 17, 64, 100):
        used = bin_slack._filling(sorted(counts, reverse=True), counts, room)
        assert all(used[n] <= counts[n] for n in used)
        assert sum(n * c for n, c in used.items()) == best_sum(counts, room)


def test_pack_round_trip(odd, odd_rows, spark):
    rows = bin_slack.pack(odd, 64, JSON, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    windows: dict = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    used = sum(r["length"] for r in rows)
    assert used / (64 * len(windows)) > 0.95
    made = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    want = []
    for key, ids in expected_ids(odd_rows):
        raw = np.array([*ids, 0], dtype="<u4")
        want += [(key, s, len(raw[s:s + 64]), zlib.crc32(raw[s:s + 64].tobytes()), len(raw)) for s in range(0, len(raw), 64)]
    assert made == sorted(want)


def test_pack_empty(nothing):
    assert bin_slack.pack_1024(nothing).count() == 0

"""Ranked search, block rotation and bin completion against brute force, round trips and the library."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from odd_cases import SF, prose

from gridmart.llm import bin_completion, block_rotation, pair_maxscore, tokens
from gridmart.llm.bin_completion import Search, best_fit, bins_of, completions, least_bins
from gridmart.llm.block_rotation import Rule

JSON = public_tokenizers.path("byte_bpe_50k.json")
ITEMS = "item_id long, text string, score long, rank int, doc_id long, item int"


# Ranked search


def terms_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_ranking(docs, items, k):
    """(item_id, rank, doc_id, score) by the formula, with neither index nor bounds."""
    bags = [(doc, Counter(terms_of(text)), len(terms_of(text))) for doc, text in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        found = []
        for doc, bag, n in bags:
            score = 0
            for t in set(terms_of(text)) & set(bag):
                m = 50 + (50 * n * n_docs) // n_terms
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, unknown, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if unknown else doc, -score))
    return sorted(out, key=str)


def ranking(docs, benchmark, k):
    return sorted(map(tuple, pair_maxscore.ranked(docs, benchmark, k).collect()), key=str)


def test_terms_in_runs(monkeypatch):
    monkeypatch.setattr(pair_maxscore, "RUN_BYTES", 7)
    text = "Abc DÉF x-y_z 12é\n\x7f~ abcdefghijklmnop " * 3 + "ABC"
    found = [h for hashes, _ in pair_maxscore.term_runs(text.encode()) for h in hashes.tolist()]
    words = terms_of(text)
    assert len(found) == len(words)
    assert len(set(zip(found, words, strict=True))) == len(set(found)) == len(set(words))


@pytest.mark.parametrize("seed", range(4))
def test_ranking_equals_brute_force(spark, seed, monkeypatch):
    """Frequent and rare words, documents of very different length, many ties; blocks of a few documents."""
    monkeypatch.setattr(pair_maxscore, "BLOCK_BYTES", 600)
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(60)]
    share = 1 / np.arange(1, 61) ** (0.5 + seed / 2)
    docs = [(int(rng.integers(0, 80)), " ".join(rng.choice(words, int(rng.choice([1, 3, 12, 80])), p=share / share.sum())))
            for _ in range(150)]
    items = [(k, " ".join(rng.choice(words, int(rng.integers(1, 15))))) for k in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert ranking(frame, spark.createDataFrame(items, "item_id long, text string"), 5) == brute_ranking(docs, items, 5)


def test_ranking_of_odd_rows(spark, odd, odd_rows):
    """Null and empty texts, a null id, repeated rows and items, clashing columns."""
    items = [(1, prose(1, 20)), (1, prose(1, 20)), (2, None), (3, ""), (None, "ALPHA0 köln 東京 tail"), (5, "x" * 50000),
             (6, "none of these"), (7, " ".join(prose(k, 30) for k in range(5)))]
    frame = spark.createDataFrame([(i, t, 9, 9, 9, 9) for i, t in items], ITEMS)
    got = ranking(odd, frame, 4)
    assert got == brute_ranking([(r[0], r[1]) for r in odd_rows], items, 4)
    assert any(doc is None for _, _, doc, _ in got) and any(item is None for item, *_ in got)


def test_ranking_in_groups(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(pair_maxscore, "GROUP_BYTES", 60)
    items = [(k, prose(k, 8)) for k in range(6)]
    got = ranking(odd, spark.createDataFrame(items, "item_id long, text string"), 3)
    assert got == brute_ranking([(r[0], r[1]) for r in odd_rows], items, 3)


def test_ranking_of_nothing(spark, odd, nothing):
    empty = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "alpha0")], "item_id long, text string")
    assert ranking(nothing, some, 5) == ranking(odd, empty, 5) == []


def test_pair_bounds_skip_documents(spark):
    """Terms that never meet: their pair is bounded by one of them, so the search brings fewer candidates."""
    docs = spark.createDataFrame([(k, f"{'left' if k % 2 else 'right'} filler{k} " + "pad " * (k % 7)) for k in range(200)]
                                 + [(1000 + k, "rare rarer rarest") for k in range(5)], "doc_id long, text string").coalesce(1)
    queries = pair_maxscore.Queries([(1, "left right rare rarer")])
    index = pair_maxscore.build_index(docs, queries)
    model = pair_maxscore.Model.of(index, queries)
    row = pair_maxscore.with_bounds(index, model).first().asDict()
    block = pair_maxscore.Bounded(row, model)
    joint = {tuple(p): int(block.joint[k]) for k, p in enumerate(model.pairs.tolist())}
    assert sorted(len(block.lists.get(k, [])) for k in range(len(model.pairs))) == [0, 5]
    assert sorted(joint.values())[0] == 0
    (units,) = model.units
    single = np.maximum(block.maximum[units[:, 0]], block.maximum[units[:, 1]])
    whole = np.maximum(single, block.joint[units[:, 2]])
    assert (whole <= block.maximum[units[:, 0]] + block.maximum[units[:, 1]]).all()
    assert whole.sum() < block.maximum[units[:, :2]].sum()
    places, _ = block.search(units, int(whole.min()) + 1)
    assert sorted(block.ids[places].tolist()) == [1000 + k for k in range(5)]


def test_registered_search_on_its_tables(spark, small_documents):
    rows = pair_maxscore.op11_pair_maxscore(spark, SF)
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    docs = small_documents.select("doc_id", "text").collect()
    assert sorted(map(tuple, rows.collect()), key=str) == brute_ranking(docs, items, 50)


# Block rotation


def expected_form(doc_id, text):
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("run", [1, 3, 1 << 16])
def test_rotation_equals_slicing(run, monkeypatch):
    monkeypatch.setattr(block_rotation, "RUN", run)
    rng = np.random.default_rng(run)
    for _ in range(300):
        n = int(rng.integers(0, 40))
        a, b, c = sorted(int(x) for x in rng.integers(0, n + 1, 3))
        data = bytes(rng.integers(0, 256, n, dtype=np.uint8))
        made = bytearray(data)
        block_rotation.rotate(np.frombuffer(made, dtype=np.uint8), a, b, c)
        assert bytes(made) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_forms_of_random_texts():
    """Texts of characters of one to four bytes and pieces of sentinels."""
    rng, rule = np.random.default_rng(5), Rule()
    parts = list("ab<>PSM \n") + ["é", "東", "😀", "<P", "S>", "<<", "M><", "é", "\0"]
    forms = Counter()
    for doc in range(3000):
        text = "".join(rng.choice(parts, int(rng.integers(0, 25))))
        got = block_rotation.transform(rule, doc, text)
        assert got == expected_form(doc, text)
        assert block_rotation.restore(rule, got[1], got[4]) == text
        forms[got[1]] += 1
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 300


def test_rotation_of_odd_rows(odd, odd_rows):
    outputs = block_rotation.fill_in_middle(odd)
    got = sorted(map(tuple, outputs.collect()), key=str)
    assert got == sorted(((r[0], *expected_form(r[0], r[1] or "")) for r in odd_rows), key=str)
    back = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["restored"]) for r in block_rotation.restored(outputs).collect())
    assert back == sorted((r[0] is None, r[0] or 0, r[1] or "") for r in odd_rows)


def test_rotation_of_nothing(nothing):
    assert block_rotation.restored(block_rotation.fill_in_middle(nothing)).count() == 0


def test_own_sentinels_and_wrong_ones():
    rule = Rule(seed=7, prefix="<pre>", suffix="[suf]", middle="¶mid", transformed=100, suffix_first=50)
    for doc in range(200):
        text = prose(doc, 5)
        _, form, _, _, output = block_rotation.transform(rule, doc, text)
        assert form != "plain" and len(output) == len(text) + 14
        assert block_rotation.restore(rule, form, output) == text
    for wrong in ("", "abca", "<M>"):
        with pytest.raises(ValueError, match="sentinel"):
            Rule(prefix=wrong)


def test_registered_rotation_on_its_table(spark, small_documents):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc, text in small_documents.select("doc_id", "text").collect():
        *head, output = expected_form(doc, text or "")
        want.append((doc, *head, digest(output), digest(text or "")))
    assert sorted(map(tuple, block_rotation.op12_block_rotation(spark, SF).collect())) == sorted(want)


# Bin completion


def single_best_fit(items, capacity):
    rooms = []
    for x in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= x]
        rooms.remove(min(fits)) if fits else None
        rooms.append((min(fits) if fits else capacity) - x)
    return len(rooms)


def optimum(items, capacity):
    items = sorted(items, reverse=True)
    best = single_best_fit(items, capacity)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= items[k]}:
            rest = list(rooms)
            rest.remove(room)
            place(k + 1, [*rest, room - items[k]])
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best


def pieces_of(packing, capacity):
    total = Counter()
    for times, inside in packing:
        assert sum(n * c for n, c in inside.items()) <= capacity
        total.update({n: c * times for n, c in inside.items()})
    return total


@pytest.mark.parametrize("seed", range(60))
def test_search_finds_the_least_number(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([20, 37, 60, 100]))
    items = rng.integers(max(1, capacity // int(rng.choice([3, 6]))), capacity * 7 // 10, int(rng.integers(1, 12))).tolist()
    counts = Counter(items)
    found = Search(counts, capacity, 100000)
    assert bins_of(best_fit(counts, capacity)) == single_best_fit(items, capacity)
    assert found.proven and found.bins == bins_of(found.packing) == optimum(items, capacity)
    assert least_bins(counts, capacity) <= found.bins
    assert pieces_of(found.packing, capacity) == counts


def test_search_is_better_than_best_fit():
    counts = dict.fromkeys(range(400, 900), 6)
    found = Search(counts, 2048, 400)
    assert found.bins < bins_of(best_fit(counts, 2048))
    assert pieces_of(found.packing, 2048) == counts
    assert Search(counts, 2048, 0).bins == bins_of(best_fit(counts, 2048))


@pytest.mark.parametrize("seed", range(10))
def test_completions_are_the_undominated_fillings(seed):
    rng = np.random.default_rng(seed)
    items = sorted(rng.integers(1, 12, 7).tolist())
    room = int(rng.integers(5, 25))
    chosen = {tuple(c) for k in range(len(items) + 1) for c in combinations(items, k) if sum(c) <= room}

    def dominated(inside):
        out = list((Counter(items) - Counter(inside)).elements())
        return any(sum(part) <= x and sum(inside) - sum(part) + x <= room and part != (x,) and
                   not (x in inside and sum(part) == x)
                   for k in range(len(inside) + 1) for part in combinations(inside, k) for x in out)

    want = {c for c in chosen if not dominated(c)}
    found = list(completions(Counter(items), room, 0))
    assert [sum(n * c for n, c in f.items()) for f in found] == sorted(
        (sum(n * c for n, c in f.items()) for f in found), reverse=True)
    assert {tuple(sorted(Counter(f).elements())) for f in found} == want
    assert len(found) == len(want)


def test_millions_of_equal_pieces():
    counts = {2048: 10 ** 12, 1500: 10 ** 9, 500: 3 * 10 ** 9, 48: 10 ** 9, 1: 7}
    found = Search(counts, 2048)
    assert pieces_of(found.packing, 2048) == counts and found.bins >= found.bound
    assert len(bin_completion.layout(found.packing)) < 200


def check_packing(rows, texts, capacity):
    """Every document's ids in order in its pieces, sequences gapless and within capacity; gives the piece lengths."""
    library = tokens.library(JSON)
    want = []
    for doc, text in texts:
        raw = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(raw) % capacity or capacity
        starts = [0, *range(first, len(raw), capacity)]
        want += [(doc is None, doc or 0, k, a, b - a, zlib.crc32(raw[a:b].tobytes()))
                 for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(raw)], strict=True))]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"])
                  for r in rows) == sorted(want)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return Counter(r["length"] for r in rows), len(sequences)


def test_packing_of_odd_rows(odd, odd_rows):
    for capacity in (64, 1000):
        rows = bin_completion.pack(odd, capacity, JSON, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN).collect()
        counts, used = check_packing(rows, [(r[0], r[1]) for r in odd_rows], capacity)
        assert used == Search(counts, capacity).bins


def test_packing_of_nothing(nothing):
    assert bin_completion.pack(nothing, 2048, JSON, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN).count() == 0


def test_registered_packing_on_its_table(spark, small_documents):
    rows = bin_completion.op13_bin_completion(spark, SF)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema] == [
        "doc_id bigint", "piece int", "start bigint", "length bigint", "ids_crc32 bigint", "sequence_id bigint", "offset bigint"]
    counts, used = check_packing(rows.collect(), small_documents.select("doc_id", "text").collect(), 2048)
    assert least_bins(counts, 2048) <= used <= bins_of(best_fit(counts, 2048))

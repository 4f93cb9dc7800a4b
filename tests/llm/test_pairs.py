"""Joins and near-duplicate searches against brute force."""

import collections
import random

import numpy as np
import pandas as pd
import pytest

from gridmart.llm import collision_dedup, components, qgram_decon, size_aware_join, sparse_suffix

from odd_cases import prose


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else frozenset([tuple(words)])


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def expected_groups(docs, k, percent):
    """The component of every row, rows being documents by themselves, and the rows' sets."""
    sets = [shingles(t, k) for _, t in docs]
    links = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i])
             if len(x & y) and 100 * len(x & y) >= percent * len(x | y)]
    return classes(range(len(docs)), links), sets


def check_groups(df, k, percent):
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    groups, sets = expected_groups(docs, k, percent)
    least = {}
    for row, (doc, _) in enumerate(docs):
        known = [d for d in (least.get(groups[row]), doc) if d is not None]
        least[groups[row]] = min(known) if known else None
    want = [(doc, len(sets[row]), least[groups[row]]) for row, (doc, _) in enumerate(docs)]
    rows = size_aware_join.jaccard_groups(df, k, percent).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def families(spark):
    """Chains of near copies of short, middle and long texts, with a passage that all share."""
    rng, rows = random.Random(5), []
    common = prose(99, 12)
    for family, length in enumerate((9, 12, 25, 60, 60, 200, 400)):
        base = " ".join(f"w{family}x{rng.randrange(10 ** 6)}" for _ in range(length))
        for _ in range(8):
            rows.append((len(rows), edited(base, rng, rng.randrange(0, max(2, length // 15))) + " " + common))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (3, 50)])
def test_jaccard_families(families, k, percent):
    check_groups(families, k, percent)


def test_jaccard_odd_rows(odd, nothing):
    check_groups(odd, 3, 90)
    assert size_aware_join.jaccard_groups(nothing, 3, 90).count() == 0


@pytest.mark.parametrize("long", [4096, 16])
def test_jaccard_large_group_is_split(spark, monkeypatch, long):
    for name, value in (("BLOCK", 8), ("SET_BLOCK", 16), ("SHORT", 4)):
        monkeypatch.setattr(size_aware_join, name, value)
    monkeypatch.setattr(size_aware_join, "LONG", long)
    rng = random.Random(8)
    base = " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(120))
    df = spark.createDataFrame([(k, edited(base, rng, 2)) for k in range(60)], "doc_id long, text string")
    check_groups(df, 3, 90)


def test_jaccard_of_rows_without_ids_and_of_repeated_ids(spark):
    """Null ids that link with each other, and with known ids; one id with texts of different groups."""
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    rows = [(None, a), (None, a + " tail"), (5, b), (None, b), (7, a + " tale"), (7, c), (9, c), (7, prose(4, 40)), (2, b + " x"),
            (None, prose(6, 40)), (None, prose(6, 40)), (None, ""), (7, None)]
    check_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)


def test_jaccard_of_large_sets(spark):
    """Sets with more hash ranges than others, near the size at which the ranges double."""
    rng = random.Random(3)
    base = [f"u{rng.randrange(10 ** 9)}" for _ in range(1040)]
    texts = [base[:1026], base[:1020] + ["x"], base[:1030], base[:900] + ["y"] * 90, base, [f"z{k}" for k in range(1030)],
             [w for w in base[:1030] if rng.random() < .97], base[:520] + [f"q{k}" for k in range(510)]]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert len({len(size_aware_join.range_counts(size_aware_join.shingle_hashes(np.arange(n, dtype=np.uint64), 3))) for n in (900, 1026, 1040)}) == 2
    check_groups(frame, 3, 90)
    check_groups(frame, 5, 80)


def test_blocks_yield_few_edges():
    """Two blocks of near copies: each yields its own edges, both together one."""
    rng = np.random.default_rng(1)
    base = np.sort(rng.choice(10 ** 9, 300, replace=False)).astype(np.uint64)
    near = [np.delete(base, rng.choice(300, 2)) for _ in range(60)]
    far = [np.sort(rng.choice(10 ** 9, 300, replace=False)).astype(np.uint64) for _ in range(4)]
    sets, block = near + far, np.arange(64) % 2
    for own in (0, 1):
        mine = [s for s, k in zip(sets, block, strict=True) if k == own]
        assert len(size_aware_join.linked_forest(mine, 90)) == 29
    between = size_aware_join.linked_forest(sets, 90, block)
    assert len(between) == 1 and block[between[0][0]] != block[between[0][1]]
    rows = pd.DataFrame({"a": 0, "b": 1, "mine": block, "node": np.arange(64), "n_shingles": [len(s) for s in sets],
                         "ranges": [size_aware_join.range_counts(s) for s in sets]})
    assert len(size_aware_join._possible_forest(90)(rows)) == 1


def test_one_of_each_group_decides_by_row(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(7, a), (7, b), (3, a + " tail"), (9, c), (9, c), (None, c + " tail"), (None, prose(4, 60)), (None, prose(4, 60)), (7, ""), (1, b)]
    kept = size_aware_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    want = [(3, a + " tail"), (1, b), (9, c), (None, prose(4, 60)), (7, "")]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("most", [1 << 27, 16])
def test_members_by_bitmap_or_by_join(spark, monkeypatch, most):
    monkeypatch.setattr(size_aware_join, "MOST_BITS", most)
    rng = random.Random(9)
    base = prose(5, 80)
    rows = [(k, edited(base, rng, 1) if k < 12 else prose(k + 100, 50)) for k in range(40)]
    check_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)


def test_one_of_each_group(odd):
    kept = size_aware_join.one_of_each_group(odd, 5, 80)
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert kept.columns == odd.columns
    assert ids == [(False, d) for d in (1, 2, 3, 4, 5, 6, 7, 9, 11, 12, 13)] + [(True, 0)]


def test_boundary_is_the_cheapest():
    sizes = {5: 100, 40: 1000, 400: 50, 4000: 5}
    boundary = size_aware_join.cost_boundary(sizes, 90)
    assert 5 <= boundary <= 4001
    assert size_aware_join.cost_boundary({}, 90) == 1


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (200, 301), (302, 301)]
    rows = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = classes({n for e in edges for n in e}, edges)
    assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def unit_families():
    rng = np.random.default_rng(2)
    rows = []
    for family in range(12):
        base = rng.standard_normal(24)
        for _ in range(15):
            noise = rng.standard_normal(24) * rng.choice([0.0, 0.1, 0.16])
            rows.append((len(rows), (base + noise * np.linalg.norm(base) / 5).tolist(), family % 3))
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)] + [(2000, rows[0][1], None), (2001, rows[0][1], 0), (2002, rows[0][1][:5], 0)]
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(collision_dedup, "BLOCK", block)
    rows = unit_families()
    got = {r["vec_id"]: r for r in collision_dedup.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.98).collect()}
    usable = [(i, np.array(v), g) for i, v, g in rows
              if g is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for k, (a, x, g) in enumerate(usable) for b, y, h in usable[:k]
             if g == h and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98]
    assert len(links) > 100
    group, often = classes([i for i, *_ in rows], links), collections.Counter(n for e in links for n in e)
    assert len(got) == len(rows)
    for i, *_ in rows:
        assert (got[i]["component_id"], got[i]["n_links"], got[i]["kept"]) == (group[i], often[i], group[i] == i)


def test_vectors_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert collision_dedup.near_vectors(empty, 0.98).count() == 0


def expected_marks(docs, length):
    places, marks = collections.defaultdict(set), collections.defaultdict(set)
    texts = [(d, (t or "").encode().lower().split()) for d, t in docs if d is not None]
    for d, w in texts:
        for k in range(len(w) - length + 1):
            places[tuple(w[k:k + length])].add(d)
    for d, w in texts:
        for k in range(len(w) - length + 1):
            if len(places[tuple(w[k:k + length])]) > 1:
                marks[d].update(range(k, k + length))
    return {d: m for d, m in marks.items() if m}


def check_passages(df):
    got = collections.defaultdict(set)
    for r in sparse_suffix.repeated_passages(df).collect():
        got[r["doc_id"]].update(range(r["start"], r["stop"]))
    assert got == expected_marks([(r["doc_id"], r["text"]) for r in df.collect()], 50)


def test_passages(spark):
    rng = random.Random(3)
    shared = [" ".join(f"p{k}w{rng.randrange(10 ** 6)}" for _ in range(n)) for k, n in enumerate((50, 49, 120, 70))]
    rows = []
    for k in range(40):
        own = lambda: " ".join(f"o{rng.randrange(10 ** 9)}" for _ in range(rng.randrange(5, 80)))
        rows.append((k, f"{own()} {shared[k % 4]} {own()} {shared[k * 7 % 4]} {own()}"))
    rows.append((100, ("again and " * 80)))  # repeats in itself alone
    check_passages(spark.createDataFrame(rows, "doc_id long, text string"))


def test_passages_odd_rows(odd, nothing):
    check_passages(odd)
    assert sparse_suffix.repeated_passages(nothing).count() == 0


@pytest.mark.parametrize("slices", [1, 40])
def test_passage_in_crowds_of_both_its_halves(spark, slices):
    """Many texts have its first half, many others its second half, two or three the whole."""
    rng, rows = random.Random(12), []
    own = lambda n: " ".join(f"o{rng.randrange(10 ** 9)}" for _ in range(n))
    for line in range(6):
        x, g, y = (" ".join(f"{c}{line}w{k}" for k in range(20)) for c in "xgy")
        rows += [f"{own(30)} {x} {g} {own(30)}" for _ in range(60)] + [f"{own(30)} {g} {y} {own(30)}" for _ in range(60)]
        rows += [f"{own(30)} {x} {g} {y} {own(30)}" for _ in range(2 + line % 2)]
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(slices, "doc_id")
    check_passages(df)


def test_minimisers_cover_every_window():
    rng = np.random.default_rng(6)
    for n, window in ((43, 43), (100, 43), (300, 7), (20, 1), (5, 9)):
        grams = rng.integers(0, 50, n, dtype=np.uint64)
        want = {k + int(np.argmin(grams[k:k + window])) for k in range(n - window + 1)}
        assert set(sparse_suffix.minimisers(grams, window).tolist()) == want


def test_decontamination(spark):
    rng = random.Random(4)
    items = [(k, " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(2, 9))) for _ in range(30))) for k in range(30)]
    clean = lambda: " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(2, 9))) for _ in range(100))
    docs, want = [], {}
    for k in range(60):
        text = clean()
        if k % 2:
            item, copy = items[k % 30][0], list(items[k % 30][1])
            n = sum(c.isalnum() for c in copy)
            for _ in range(qgram_decon.allowed_edits(n) if k % 4 == 1 else 0):
                copy[rng.randrange(len(copy))] = "z"
            text = f"{text} {''.join(copy).upper().replace(' ', ' *')} {clean()}"
            want[k] = item
        docs.append((k, text))
    bench = spark.createDataFrame([*items, (900, None), (901, ""), (902, "abc")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = qgram_decon.contaminations(df, bench).collect()
    assert {r["doc_id"]: r["item_id"] for r in found} == want and len(found) == len(want)
    assert all(0 <= r["start"] < r["stop"] <= len(docs[r["doc_id"]][1]) for r in found)
    assert sorted(r["doc_id"] for r in qgram_decon.uncontaminated(df, bench).collect()) == [k for k, _ in docs if k not in want]


def test_decontamination_odd_rows(odd, nothing, spark):
    bench = spark.createDataFrame([(1, prose(1, 60))], "item_id long, text string")
    assert {r["doc_id"] for r in qgram_decon.contaminations(odd, bench).collect()} == {7, 8, 13}
    assert qgram_decon.uncontaminated(odd, bench).columns == odd.columns
    assert qgram_decon.contaminations(nothing, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert qgram_decon.contaminations(odd, none).count() == 0
    assert qgram_decon.uncontaminated(odd, none).count() == odd.count()


def test_decontamination_long_items(spark):
    """No short rest of a long item decides, and quotes that straddle cuts, or of half an item, are found."""
    rng = random.Random(14)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    spaced = lambda text: " ".join(text[k:k + 5] for k in range(0, len(text), 5))
    items = [letters(n) for n in (520, 1000, 400)]
    docs = [(0, f"{spaced(letters(300))} {items[0][512:]} {spaced(letters(300))}"),
            (1, f"{spaced(letters(90))} {spaced(items[1][300:900])} {spaced(letters(90))}"),
            (2, f"{spaced(letters(90))} {spaced(items[2][100:355])} {spaced(letters(90))}"),
            (3, f"{spaced(items[0])} {spaced(letters(90))}"), (4, spaced(letters(700)))]
    docs += [(10 + k, f"{spaced(letters(50))} {spaced(items[1][k:k + 255])} {spaced(letters(50))}") for k in range(0, 746, 53)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(spaced(x) for x in items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in qgram_decon.contaminations(df, bench).collect()}
    assert found == {(1, 1), (2, 2), (3, 0), *((d, 1) for d, _ in docs if d >= 10)}
    assert sorted(r["doc_id"] for r in qgram_decon.uncontaminated(df, bench).collect()) == [0, 4]

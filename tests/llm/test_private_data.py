"""Base patterns against the written rules; bootstrapping; redaction."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from gridmart.llm import pii_bootstrap

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in match.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, rule in RULES.items() for m in re.finditer(rule, text or "") if valid(k, m.group())]


def written(spans):
    return ",".join("%s:%d:%d" % s for s in spans)


def check(df):
    docs = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect()))
    rows = sorted(pii_bootstrap.personal_data(df).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert len(rows) == len(docs)
    for r, (_, _, text) in zip(rows, docs, strict=True):
        spans = base(text)
        assert r["base_sha256"] == hashlib.sha256(written(spans).encode()).hexdigest(), text
        assert [r[f"n_{k}"] for k in RULES] == [sum(s[0] == k for s in spans) for k in RULES]
        assert r["n_added"] > 0 or r["spans"] == written(spans)


def test_base_patterns(spark):
    rng = random.Random(2)
    parts = ["4111 1111 1111 1111", "4111-1111-11111111", "1.2.3.4", "256.1.1.1", "01.002.3.255", "+1 (555) 444-3333",
             "x.y@y.zz", "a@b..c", "a@b.cc_d@e.f", " ", ".", "-", "é", "a", "7", "\n", "--", "  ", "@", "+"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(9)))) for k in range(1200)]
    rows += [(5000 + k, "".join(rng.choice("a1@..-+ 059(é_%)") for _ in range(60))) for k in range(800)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_long_runs_do_not_overflow(spark):
    rows = [(1, "a@b." + "c." * 20000 + "d"), (2, "1 " * 30000), (3, "+1" + "(" * 50000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    hard = spark.createDataFrame([(1, "1" * 60000), (2, "a" * 100000), (3, "1.1." * 20000)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii_bootstrap.personal_data(hard).collect()}
    assert (found[1]["spans"], found[2]["spans"], found[3]["n_ip"]) == ("", "", 10000)


def test_odd_rows(odd, nothing):
    check(odd)
    assert pii_bootstrap.personal_data(nothing).count() == 0


def test_confident_contexts_find_more(spark):
    rows = [(k, f"Please call me at +1 555 01{k:05d}1 today") for k in range(20)]
    rows += [(100, "Please call me at 0049-8831-2291-X today"), (101, "We met in 0049-8831-2291-Y once")]
    got = {r["doc_id"]: r for r in pii_bootstrap.personal_data(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100]["spans"] == "phone:18:34" and got[100]["n_phone"] == 0 and got[100]["n_added"] == 1
    assert got[101]["spans"] == ""


def plain_bootstrap(texts):
    """The added spans of each text, by loops over all of them."""
    def words(text):
        return [w for w in re.split(r"[\W_]+", text.lower()) if w]

    def patterns(text, start, stop):
        before, after = words(text[:start]), words(text[stop:])
        between = re.sub(r"\s+", " ", re.search(r"[\W_]*\Z", text[:start].lower()).group())
        form = re.sub("[0-9]+", "0", re.sub(r"[^\W\d_]+", "a", text[start:stop]))
        return ([("2", *before[-2:])] if len(before) > 1 else []) + ([("1", before[-1], between, form)] if before else []) + (
            [("3", before[-1], after[0])] if before and after else [])

    seeds, tokens = [], []
    for number, text in enumerate(texts):
        spans = base(text)
        seeds += [(p, list(RULES).index(k), text) for k, a, b in spans for p in patterns(text, a, b)]
        for m in re.finditer(pii_bootstrap.TOKEN.replace("*+", "*"), text):
            if not any(a < m.end() and m.start() < b for _, a, b in spans):
                tokens.append((number, m.start(), m.end(), m.group(), patterns(text, m.start(), m.end())))
    every = {}
    for p, _, text in seeds:
        every.setdefault(p, set()).add(text)
    for number, _, _, _, ps in tokens:
        for p in ps:
            every.setdefault(p, set()).add(texts[number])
    trusted = {}
    while True:
        good = {}
        for p, k, text in seeds:
            good.setdefault((p, k), set()).add(text)
        for number, _, _, entity, ps in tokens:
            for p in ps if entity in trusted else ():
                good.setdefault((p, trusted[entity]), set()).add(texts[number])
        sure = {(p, k): len(t) / (len(every[p]) + 1) for (p, k), t in good.items() if len(t) / (len(every[p]) + 1) >= 0.8}
        votes = {}
        for entity, p in {(entity, p) for *_, entity, ps in tokens for p in ps}:
            for k in range(4):
                if (p, k) in sure:
                    votes.setdefault(entity, {}).setdefault(k, []).append(sure[p, k])
        new = {e: min(v, key=lambda k: (-round(sum(v[k]), 9), k)) for e, v in votes.items() if e not in trusted}
        if not new:
            return [[(list(RULES)[trusted[e]], a, b) for n, a, b, e, ps in tokens if n == number and e in trusted
                     and any((p, trusted[e]) in sure for p in ps)] for number in range(len(texts))]
        trusted |= new


def test_bootstrapping_equals_plain_loops(spark):
    rng = random.Random(4)
    people = [f"user{k}@mail.example" for k in range(30)] + [f"id-{1000 + k}-{k}" for k in range(3)]
    phones = [f"+1 (555) 444-3{k}0" for k in range(10, 40)] + [f"00-{k}443-3322" for k in range(3)]
    texts = []
    for _ in range(300):
        frame, pool = rng.choice([("write to {} now", people), ("Mail: {}.", people), ("or ask {} there", people), ("phone = {}; end", phones),
                                  ("call us on {} please", phones), ("version {} of {}", people + phones), ("on {}", phones)])
        texts.append(rng.choice(["", "Hello. ", "x" * 70 + " "]) + frame.replace("{}", rng.choice(pool), 1).replace("{}", rng.choice(phones)))
    texts += [f"serial {k}{k}{k}{k}-{k}7 of" for k in range(4)]
    added = plain_bootstrap(texts)
    assert sum(map(len, added)) >= 20 and len({k for spans in added for k, *_ in spans}) == 2
    got = {r["doc_id"]: r for r in pii_bootstrap.personal_data(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for number, text in enumerate(texts):
        order = list(RULES)
        want = sorted(base(text) + added[number], key=lambda s: (order.index(s[0]), s[1]))
        assert got[number]["spans"] == written(want), text
        assert got[number]["n_added"] == len(added[number])


def test_words_beyond_the_window_are_whole(spark):
    far = "w" * 200
    df = spark.createDataFrame([(f"{far} {far}   1.2.3.4 {far}v end",)], "text string")
    (span,) = pii_bootstrap.scanned(df, F.col("text")).first()["base"]
    assert span["patterns"] == [f"2 {far} {far}", f"1 {far}| |0.0.0.0", f"3 {far} _ {far}v"]


def test_redaction(odd, spark):
    assert pii_bootstrap.redacted(odd).columns == odd.columns
    same = sorted(map(str, odd.collect()))
    assert sorted(map(str, pii_bootstrap.redacted(odd).collect())) == same
    df = spark.createDataFrame([(1, "é x@y.zz, 1.2.3.4 end", 21, "kept")], "doc_id long, text string, n_chars int, added string")
    row = pii_bootstrap.redacted(df).first()
    assert (row["text"], row["n_chars"], row["added"]) == ("é [EMAIL], [IP] end", 19, "kept")

"""Personal data by fixed patterns and by bootstrapped contexts, in Spark expressions alone.

Base: e-mail addresses, IP addresses, card and phone numbers by regular
expressions, leftmost and non-overlapping for each kind.  The expressions below
find what the written rules find, but have no repeated groups (Java's matcher
would overflow its stack on very long runs) and start only where a run starts
(else long runs cost the square of their length).  To that end characters that
break a match are first replaced one for one: a dot of a domain that is not
between two label characters, and the second of two separators in a card.

Extension: a base entity is a seed.  What stands around it makes up to three lexical
patterns: the two words before it; the word before it, the characters between and the entity's
shape (letters, digits and the rest in a row); the words before and after it.  Identifier-like tokens (``TOKEN``)
that no base span touches are candidates, with the patterns around them.  Patterns and instances form a
graph.  A pattern's confidence for a kind is the share of the distinct texts it occurs in
that hold a trusted instance there, smoothed so that few texts cannot make it high;
an instance is trusted for a kind when patterns of confidence at least
``CONFIDENT`` produce it.  Newly trusted instances raise the confidence of the
other patterns they occur in, which induces further ones, until no instance is
added.  An instance keeps the kind it was first trusted for, so the
rounds end; ``CONFIDENT`` bounds the drift, as in every round it is required anew of all
texts of a pattern.  Every place of a trusted instance in such a pattern is added as a span of its kind.

Cases: null or empty text has no spans; of two kinds the one with more confidence in all vouches for an instance, of
equal ones the one listed first; copies of a text are one text as evidence; repeated rows are reported each, with their own evidence; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import documents, staged, table

#: The kinds in the order of the report.
KINDS = ["email", "ip", "card", "phone"]
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Identifier-like tokens: six characters or more, four digits or more in all.
TOKEN = (r"(?<![A-Za-z0-9_@.+-])(?=[A-Za-z0-9_@.+-]{6})[A-Za-z_@.+-]*+[0-9][A-Za-z_@.+-]*+[0-9][A-Za-z_@.+-]*+"
         r"[0-9][A-Za-z_@.+-]*+[0-9][A-Za-z0-9_@.+-]*+")
CONFIDENT = 0.8
#: Documents with added spans that are broadcast at most.
BROADCAST_ROWS = 1 << 16
#: Texts added to the denominator of a confidence.
DOUBT = 1.0
#: Characters beside an entity in which its words are looked for first; if they reach farther, in all of the text.
_WINDOW = 64
SPAN = "array<struct<kind:int,start:int,stop:int,entity:string,patterns:array<string>>>"


def _email(text: Column) -> tuple[Column, str]:
    dots = F.regexp_replace(text, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", "_")
    return dots, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"


def _ip(text: Column) -> tuple[Column, str]:
    return text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"


def _card(text: Column) -> tuple[Column, str]:
    return F.regexp_replace(text, r"(?<=[\x20-])[\x20-]", "x"), r"[0-9][0-9\x20-]*[0-9]"


def _phone(text: Column) -> tuple[Column, str]:
    return text, r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(F.reverse(F.split(digits, "")), lambda c, k: F.when(
        k % 2 == 1, F.element_at(F.array(*[F.lit(d * 2 % 10 + d * 2 // 10) for d in range(10)]), c.cast("int") + 1)
    ).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def shape(entity: Column) -> Column:
    """Runs of letters as ``a``, of digits as ``0``, the rest as it is."""
    return F.regexp_replace(F.regexp_replace(entity, r"\p{L}+", "a"), r"[0-9]+", "0")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _patterns(text: Column, begin: Column, stop: Column, near: Column, entity: Column, beside: Column) -> Column:
    """The lexical patterns around an entity; fewer where words lack.

    ``near`` and ``beside`` are what stands before and after it, in the window.
    """
    def patterns(around: Column) -> Column:
        words = around["words"]
        return F.filter(F.array(
            F.when(F.size(words) >= 2, F.concat(F.lit("2 "), F.concat_ws(" ", F.slice(words, -2, 2)))),
            F.concat(F.lit("1 "), F.try_element_at(words, F.lit(-1)), F.lit("|"), around["between"], F.lit("|"), shape(entity)),
            F.concat(F.lit("3 "), F.try_element_at(words, F.lit(-1)), F.lit(" _ "), around["next"])), lambda p: p.isNotNull())

    # Of three words in the window the last two are whole; else the window may have cut one.
    before = _bound(_words(near), lambda w: F.when((begin <= _WINDOW) | (F.size(w) > 2), w).otherwise(
        _words(F.substring(text, F.lit(1), begin))))
    after = _bound(_words(beside), lambda w: F.when((F.length(beside) < _WINDOW) | (F.size(w) > 1), w).otherwise(
        _words(F.substring(text, stop + 1, F.length(text)))))
    between = F.regexp_extract(near, r"[^\p{L}\p{N}]*\z", 0)
    # A run of other characters that fills the window is taken whole, too.
    whole = F.when((begin <= _WINDOW) | (F.length(between) < _WINDOW), between).otherwise(
        F.regexp_extract(F.substring(text, F.lit(1), begin), r"[^\p{L}\p{N}]*+\z", 0))
    return _bound(F.struct(before.alias("words"), F.regexp_replace(whole, r"\s+", " ").alias("between"),
                           F.get(after, F.lit(0)).alias("next")), patterns)


def matches(text: Column, searched: Column, pattern: str, kind: int, valid) -> Column:
    """Spans of the matches of ``pattern`` in ``searched``, which has a character for each one of ``text``.

    The pieces between matches and the matches themselves give the positions.
    """
    pieces = F.split(searched, pattern, -1)
    found = F.regexp_extract_all(searched, F.lit(pattern), 0)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["0"])
        stop = begin + F.length(pair["1"])
        low = F.greatest(begin - _WINDOW, F.lit(0))

        def described(window: Column) -> Column:
            entity = F.substring(window, begin - low + 1, stop - begin)
            patterns = _patterns(text, begin, stop, F.substring(window, F.lit(1), begin - low), entity,
                                 F.substring(window, stop - low + 1, F.lit(_WINDOW)))
            return F.struct(F.lit(kind).alias("kind"), begin.alias("start"), stop.alias("stop"), entity.alias("entity"),
                            patterns.alias("patterns"))

        span = _bound(F.substring(text, low + 1, stop - low + _WINDOW), described)
        return F.struct(stop.alias("at"), F.when(valid(pair["1"]), F.concat(state["spans"], F.array(span).cast(SPAN)))
                        .otherwise(state["spans"]).alias("spans"))

    # Only a text with a match is split; most texts have none of a kind.
    spans = F.aggregate(F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("0"), found.alias("1")), start, add)["spans"]
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


#: What every text with an entity of a kind holds; others are not searched for it.
_NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}


def scanned(docs: DataFrame, text: Column, *kept: str) -> DataFrame:
    """Each document (with a row number) with its base spans and candidate spans, and the columns kept."""
    none = F.array().cast(SPAN)
    columns = []
    for number, kind in enumerate(KINDS):
        searched, pattern = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}[kind](text)
        found = matches(text, searched, pattern, number, lambda m, kind=kind: _valid(kind, m))
        columns.append(F.when(text.rlike(_NEEDED[kind]), found).otherwise(none).alias(kind))
    candidates = F.when(text.rlike("[0-9]"), matches(text, text, TOKEN, -1, lambda m: F.lit(True))).otherwise(none)
    out = docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64(text).alias("content"), *kept,
                      F.concat(*columns).alias("base"), candidates.alias("tokens"))
    apart = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    return out.withColumn("tokens", apart)


def trusted_places(scan: DataFrame) -> DataFrame:
    """(pattern, entity, kind) of candidates that confident patterns vouch for."""
    def places(column: str, *more: str) -> DataFrame:
        rows = scan.select("content", F.explode(column).alias("s"))
        return rows.select("content", F.explode("s.patterns").alias("pattern"), "s.entity", *more).distinct()

    seeds, tokens = staged(places("base", "s.kind"), "seeds"), staged(places("tokens"), "graph")
    every = staged(tokens.select("pattern", "content").unionByName(seeds.select("pattern", "content")).groupBy("pattern").agg(
        F.countDistinct("content").alias("every")), "texts")
    trusted = scan.sparkSession.createDataFrame([], "entity string, kind int")
    while True:
        found = seeds.select("pattern", "kind", "content").unionByName(
            tokens.join(trusted, "entity").select("pattern", "kind", "content"))
        patterns = (found.groupBy("pattern", "kind").agg(F.countDistinct("content").alias("good")).join(every, "pattern")
                    .select("pattern", "kind", (F.col("good") / (F.col("every") + DOUBT)).alias("confidence"))
                    .where(F.col("confidence") >= CONFIDENT))
        vouched = (tokens.select("pattern", "entity").distinct().join(patterns, "pattern")
                   .groupBy("entity", "kind").agg(F.round(F.sum("confidence"), 9).alias("weight"))
                   .groupBy("entity").agg(F.min_by("kind", F.struct(-F.col("weight"), F.col("kind"))).alias("kind")))
        new = staged(vouched.join(trusted, "entity", "left_anti"), "trusted")
        if new.isEmpty():
            break
        trusted = staged(trusted.unionByName(new), "trusted")
    return staged(tokens.join(trusted, "entity").join(patterns.select("pattern", "kind"), ["pattern", "kind"])
                  .select("pattern", "entity", "kind").distinct(), "places")


def _ordered(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))))


_SHORT = "array<struct<kind:int,start:int,stop:int>>"


def _all_spans() -> Column:
    """Base and added spans of a scanned document."""
    return _ordered(F.concat(_ordered(F.col("base")), F.coalesce("added", F.array().cast(_SHORT))))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))))


def _of_kind(spans: str, kind: int) -> Column:
    """How many spans of a kind there are."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def entity_spans(docs: DataFrame, text: Column, *kept: str) -> tuple[DataFrame, DataFrame]:
    """The scan of all documents, and (row, added): the spans that the bootstrapping adds."""
    scan = staged(scanned(docs, text, *kept), "scan")
    tokens = scan.select("row", F.explode("tokens").alias("t")).select(
        "row", "t.start", "t.stop", "t.entity", F.explode("t.patterns").alias("pattern"))
    added = (tokens.join(trusted_places(scan), ["pattern", "entity"]).groupBy("row", "start", "stop").agg(F.min("kind").alias("kind"))
             .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added")))
    return scan, staged(added, "added")


def with_added(scan: DataFrame, added: DataFrame) -> DataFrame:
    """The scan with ``added``; a document without a candidate is not shuffled for it."""
    if added.count() <= BROADCAST_ROWS:
        return scan.join(F.broadcast(added), "row", "left")
    return (scan.where(F.size("tokens") > 0).join(added, "row", "left")
            .unionByName(scan.where(F.size("tokens") == 0).withColumn("added", F.lit(None).cast(added.schema["added"].dataType))))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, digest of the base spans, and all spans."""
    scan, added = entity_spans(documents(docs), F.col("text"), "doc_id")
    base, every = _ordered(F.col("base")), _all_spans()
    counts = [_of_kind("base", k).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return with_added(scan, added).select(
        "doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(every).alias("spans"),
        F.size(F.coalesce("added", F.array().cast(_SHORT))).cast("long").alias("n_added"))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span of the text replaced by its kind in brackets.

    Spans that overlap become one bracket, of the kind that begins first.  A
    column ``n_chars`` is set to the new length; all other columns, whatever
    their names, are as before.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    scan, added = entity_spans(docs.select(F.struct("*").alias("doc")), text, "doc")
    by_start = F.array_sort(F.transform(_all_spans(), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))

    def put(state: Column, span: Column) -> Column:
        piece = F.concat(F.substring(text, state["at"] + 1, span["start"] - state["at"]),
                         F.element_at(names, span["kind"] + 1))
        return F.struct(F.greatest(state["at"], span["stop"]).alias("at"), F.when(
            span["start"] >= state["at"], F.concat(state["parts"], F.array(piece))).otherwise(state["parts"]).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    new = F.aggregate(by_start, start, put, lambda s: F.concat(
        F.concat_ws("", s["parts"]), F.substring(text, s["at"] + 1, F.length(text))))
    changed = with_added(scan, added).withColumn("new", F.when(
        (F.size("base") > 0) | F.col("added").isNotNull(), new))
    doc = F.col("doc").withField("text", F.coalesce("new", F.col("doc.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        doc = doc.withField("n_chars", F.when(F.col("new").isNull(), F.col("doc.n_chars")).otherwise(
            F.length("new").cast(kind)))
    return changed.select(doc.alias("doc")).select("doc.*")


def op2_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return personal_data(table(spark, sf_dir, "documents"))


QUERIES = {"op2_pii_bootstrap": op2_pii_bootstrap}

"""Scale properties as plan and result checks.

A hot key (a third of all rows) must be reduced before the shuffle, joins to
dimensions broadcast only under a proven bound, and filters reach the scan.
"""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SF
from gridmart.operators import manifest, quality
from gridmart.operators.dedupe import dedupe_latest
from gridmart.operators.joins import join_dim
from gridmart.plans import sync, testbed


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hot(spark, n=30000):
    # a third of the rows share one grain; the rest are unique
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("g"),
        F.col("id").alias("load_id"), (F.col("id") * 2).alias("v"))


def test_dedupe_reduces_hot_grain_before_shuffle(spark):
    df = dedupe_latest(hot(spark).repartition(8), ["g"])
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Partial") > p.index("Exchange")  # partial limit below the exchange
    top = df.where("g = -1").collect()
    assert len(top) == 1 and top[0]["load_id"] == 29997


def test_grouped_outputs_aggregate_partially(spark):
    m = manifest.annotate(spark.createDataFrame(
        [("2026_07_X", "2026-08-01T10:00:00")] * 50 + [("2026_08_X", "bad")],
        "file_name string, updated string"))
    p = plan(manifest.latest_per_folder(m))
    assert p.count("SortAggregate") >= 2 or p.count("HashAggregate") >= 2
    p2 = plan(quality.check_unique(hot(spark), ["g"]))
    assert p2.count("HashAggregate") >= 2


def test_small_dimension_is_broadcast_without_a_job(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    fact = spark.range(100000).select((F.col("id") % 1000).alias("k"))
    assert "BroadcastHashJoin" in plan(join_dim(fact, small, "k"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(join_dim(fact, small, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_upsert_reads_only_touched_partitions(spark, tmp):
    from gridmart.operators.upsert import touched_partitions, upsert_table
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("d")
    upsert_table(spark, f"{tmp}/t", spark.range(3000).select("id", F.lit(1).alias("v"), day), ["id"], "d")
    target = spark.read.parquet(f"{tmp}/t")
    one = spark.range(0, 3000, 30).select("id", F.lit(2).alias("v"), day)
    read = touched_partitions(target, one, "d")
    assert len({f.rsplit("/", 2)[1] for f in read.select("*").inputFiles()}) == 30  # the relation lists all
    p = plan(read)
    assert "PartitionFilters: [isnotnull(d" in p or "PartitionFilters: [(d" in p or "PartitionFilters: [d" in p
    assert "Exchange" not in p
    out = upsert_table(spark, f"{tmp}/t", one, ["id"], "d")
    assert out.count() == 3000 and out.where("v = 2").count() == 100


def test_upsert_rejects_repeated_keys(spark, tmp):
    from gridmart.operators.upsert import upsert_table
    twice = spark.createDataFrame([(1, 2, "x"), (1, 3, "x")], "id int, v int, d string")
    with pytest.raises(Exception, match="more than once"):
        upsert_table(spark, f"{tmp}/t", twice, ["id"], "d")


def test_window_bound_is_pushed_into_the_scan(spark):
    local, remote = testbed._events_replica(spark, SF)
    p = plan(sync.replace_window(remote, local, "ts", 2))
    assert p.count("GreaterThan(ts,") >= 1


def test_only_needed_columns_are_read(spark):
    p = plan(quality.check_unique(testbed._t(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p


def test_pse_pages_grow_neither_with_the_table_nor_with_a_key(spark, tmp, monkeypatch):
    from gridmart.plans import testbed_more
    day = F.timestamp_seconds(F.lit(1704110400) + F.col("id") % 30 * 86400)  # noon of January's days
    (spark.range(0, 12000, 1, 4).select(F.col("id").alias("event_id"), day.cast("timestamp_ntz").alias("ts"),
                                        F.lit(1).cast("bigint").alias("user_id"), F.lit(0.5).alias("value"))
     .write.parquet(f"{tmp}/events.parquet"))
    monkeypatch.setattr(testbed_more, "scratch_path", lambda s, name: f"{tmp}/{name}")
    out = testbed_more.q_pse_ingest(spark, tmp)
    pages = spark.read.text(f"{tmp}/pse/landing/pse/cor")
    rows = F.size(F.from_json("value", "value array<struct<business_date string>>")["value"])
    n, longest = pages.agg(F.sum(rows), F.max(rows)).first()
    assert n == 12000 and longest <= 1000  # the one user has 4,000 rows in ten days
    assert len(pages.inputFiles()) > 4  # no task writes all pages of ten days
    assert out.groupBy("entity", "load_id").count().orderBy("entity", "load_id").collect() == [
        ("cor", 1, 10400), ("cor", 2, 800), ("zmb", 1, 10400)]

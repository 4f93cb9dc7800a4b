"""Counts and extremes from Parquet footers."""

from fixture_files import spoil
from pyspark.sql import functions as F

from gridmart.operators.footers import footer_range, footer_session, pushed


def test_footers_answer_without_data(spark, tmp):
    rows = spark.range(1000).select("id", (F.col("id") % 7).cast("int").alias("k"), F.when(F.col("id") > 9, F.col("id") / 2).alias("x"),
                                    F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    rows.repartition(3).write.parquet(f"{tmp}/t")
    spoil(f"{tmp}/t")  # a scan would fail
    df = footer_range(spark, f"{tmp}/t", ["id", "k", "x", "d"])
    assert pushed(df)
    assert [str(v) for v in df.first()] == ["1000", "0", "999", "0", "6", "5.0", "499.5", "2026-01-01", "2028-09-26"]


def test_other_queries_scan_and_are_equal(spark, tmp):
    spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "s string, n int").write.parquet(f"{tmp}/t")
    text = footer_range(spark, f"{tmp}/t", ["s"])  # text statistics may be cut, so they do not decide
    assert not pushed(text) and tuple(text.first()) == (3, "a", "b")
    some = footer_session(spark).read.parquet(f"{tmp}/t").where("n > 1").agg(F.count(F.lit(1)).alias("n"))
    assert not pushed(some) and some.first()["n"] == 2
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_empty_table(spark, tmp):
    spark.createDataFrame([], "n int").write.parquet(f"{tmp}/t")
    assert tuple(footer_range(spark, f"{tmp}/t", ["n"]).first()) == (0, None, None)

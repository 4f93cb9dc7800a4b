"""Digest trees: finding and copying the days that differ."""

import datetime as dt
import glob

import pytest
from fixture_files import spoil
from pyspark.sql import functions as F

from gridmart.operators.upsert import write_partitions
from gridmart.plans import digests, sync
from gridmart.plans.digests import day_digests, refresh_tree, roll_up, sync_days, unequal, unequal_days

SCHEMA = "k int, ts timestamp_ntz, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("part_date", F.to_date("ts"))


def day(month, number):
    return dt.datetime(2026, month, number, 12)


ROWS = [(k, day(1 + k % 3, 1 + k // 3), f"v{k}") for k in range(30)]


class Pair:
    """A source and its replica."""

    def __init__(self, spark, root):
        self.spark, self.source, self.replica, self.trees = spark, f"{root}/source", f"{root}/replica", f"{root}/trees"

    def write(self, rows, mode="dynamic"):
        write_partitions(frame(self.spark, rows), self.source, "part_date", mode)

    def sync(self):
        return sync_days(self.spark, self.source, self.replica, self.trees, "t")

    def equal(self):
        a, b = (sorted(map(str, self.spark.read.parquet(p).collect())) for p in (self.source, self.replica))
        return a == b


def test_old_edits_are_copied_and_nothing_else_is_read(spark, tmp):
    pair = Pair(spark, tmp)
    pair.write(ROWS)
    assert pair.sync()[0] == "full-copy" and pair.equal()
    assert pair.sync() == ("skip", [])
    # From here on a read of any other day, on either side, would fail.
    kept = {"2026-01-02", "2026-02-05", "2026-03-09"}
    for side in (pair.source, pair.replica):
        for path in glob.glob(f"{side}/part_date=*"):
            if path[-10:] not in kept and path[-10:] != "2026-03-10":
                spoil(path)
    pair.write([(3, day(1, 2), "edited"), (13, day(2, 5), "v13"), (100, day(3, 9), "more"), (26, day(3, 9), "v26")])
    assert pair.sync() == ("resync", ["2026-01-02", "2026-03-09"])
    assert pair.sync() == ("skip", [])
    got = spark.read.parquet(pair.replica).where(F.col("part_date").isin([dt.date(2026, 1, 2), dt.date(2026, 3, 9)]))
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [(3, "edited"), (26, "v26"), (100, "more")]


def test_lost_new_and_undated_days(spark, tmp):
    pair = Pair(spark, tmp)
    pair.write([*ROWS, (200, None, "undated")])
    assert pair.sync()[0] == "full-copy" and pair.equal()
    pair.write([r for r in ROWS if r[1].month != 2] + [(300, day(7, 7), None)], "static")
    action, days = pair.sync()
    assert action == "resync" and pair.equal()
    assert days == sorted([f"2026-02-{k:02d}" for k in range(1, 11)] + ["2026-07-07", digests.NO_DAY])


def test_an_edited_replica_is_repaired(spark, tmp):
    pair = Pair(spark, tmp)
    pair.write(ROWS)
    pair.sync()
    write_partitions(frame(spark, [(1, day(2, 1), "wrong")]), pair.replica, "part_date")
    assert pair.sync() == ("resync", ["2026-02-01"]) and pair.equal()


def test_a_new_column_touches_all_days(spark, tmp):
    pair = Pair(spark, tmp)
    pair.write(ROWS)
    pair.sync()
    write_partitions(frame(spark, ROWS).withColumn("w", F.lit(1)), pair.source, "part_date", "static")
    action, days = pair.sync()
    assert action == "resync" and len(days) == 30 and pair.equal()


def test_digests_do_not_depend_on_order_and_see_nulls(spark):
    rows = spark.createDataFrame([("a", None, "2026-01-01"), (None, "a", "2026-01-02"), ("a", None, "2026-01-03"),
                                  ("a", "a", "2026-01-04"), ("a", "a", "2026-01-04")], "x string, y string, part_date string")
    one = {r["node"]: tuple(r)[1:] for r in day_digests(rows).collect()}
    two = {r["node"]: tuple(r)[1:] for r in day_digests(rows.repartition(5, "x")).collect()}
    assert one == two and one["2026-01-01"] == one["2026-01-03"] != one["2026-01-02"]
    assert one["2026-01-04"][0] == 2
    tree = {(r["level"], r["node"]): tuple(r)[3:6] for r in roll_up(day_digests(rows).withColumn("files", F.lit(""))).collect()}
    total = tuple(sum(v[k] for v in one.values()) for k in range(3))
    assert tree[("table", "table")] == tree[("month", "2026-01")] == total


def test_descent_looks_below_unequal_nodes_only(spark, monkeypatch):
    def tree(values):
        days = spark.createDataFrame([(d, 1, v, v, "") for d, v in values.items()],
                                     "node string, row_count long, first decimal(38,0), second decimal(38,0), files string")
        return roll_up(days.selectExpr("node", "row_count", "first", "second", "files"))

    from decimal import Decimal as D
    a = {f"2026-{m:02d}-{d:02d}": D(m * 100 + d) for m in range(1, 7) for d in range(1, 4)}
    b = a | {"2026-03-02": D(0)}
    del b["2026-05-01"]
    asked = []
    real = unequal
    monkeypatch.setattr(digests, "unequal", lambda s, r, level, branches=None: asked.append((level, branches)) or real(s, r, level, branches))
    assert unequal_days(tree(a), tree(b)) == ["2026-03-02", "2026-05-01"]
    assert asked == [("table", None), ("month", ["table"]), ("day", ["2026-03", "2026-05"])]
    asked.clear()
    assert unequal_days(tree(a), tree(a)) == [] and asked == [("table", None)]


def test_missing_and_empty_tables(spark, tmp):
    assert refresh_tree(spark, f"{tmp}/none", f"{tmp}/tree").count() == 0
    assert sync_days(spark, f"{tmp}/none", f"{tmp}/other", f"{tmp}/trees", "t") == ("skip", [])


def test_run_over_many_tables(spark, tmp):
    path = f"{tmp}/fct_pse_cor"
    rows = spark.createDataFrame([(day(1, k), f"{k}") for k in range(1, 9)], "dtime_utc timestamp, v string")
    write_partitions(rows.withColumn("part_date", F.to_date("dtime_utc")), path, "part_date")

    def run():
        local = {"fct_pse_cor": spark.read.parquet(path).drop("part_date")}
        return [x[1:] for x in sync.sync_many(spark, local, f"{tmp}/replica", ["fct_pse_cor"], local_paths={"fct_pse_cor": path})]

    assert run() == [("full-copy", "8 days")] and run() == [("skip", "0 days")]
    edited = rows.where("v = '2'").withColumn("v", F.lit("edited")).withColumn("part_date", F.to_date("dtime_utc"))
    write_partitions(edited, path, "part_date")
    assert run() == [("resync", "1 days")]
    assert spark.read.parquet(f"{tmp}/replica/fct_pse_cor").where("v = 'edited'").count() == 1
    assert spark.read.parquet(f"{tmp}/replica/_sync_watermark").first()["remote_max"] == "2026-01-08 12:00:00.000000"


def test_a_window_refresh_reads_the_newest_days_only(spark, tmp):
    """The overlap refresh finds the newest instant without touching older days of the replica."""
    local = frame(spark, ROWS + [(500, day(3, 28), "new")]).drop("part_date")
    sync.sync_table(spark, frame(spark, ROWS).drop("part_date"), f"{tmp}/r", "t", "ts", watermark_path=f"{tmp}/wm")
    for path in glob.glob(f"{tmp}/r/part_date=2026-0[12]-*"):
        spoil(path)
    action, detail = sync.sync_table(spark, local, f"{tmp}/r", "t", "ts", watermark_path=f"{tmp}/wm")
    assert (action, detail.split(" -> ")[1]) == ("append", "2026-03-28 12:00:00.000000")
    with pytest.raises(Exception):
        spark.read.parquet(f"{tmp}/r").collect()

"""Stateful streams: files by manifest state (Z1), latest rows as a change log."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart.operators.dedupe import dedupe_latest
from gridmart.schemas import INSTRUMENTS
from gridmart.streaming import manifest_state
from gridmart.streaming.latest_state import changed_rows, compact, read_latest, stream_latest
from gridmart.streaming.manifest_state import stream_ingest_manifest

FOLDER = INSTRUMENTS["energy_prices"].folder
HEADER = "DateTime(UTC)\tAreaMapCode\tPrice[Currency/MWh]\tUpdateTime(UTC)\n"


class Lake:
    """A landing folder, its export logs, and a stream over them."""

    def __init__(self, spark, root):
        self.spark, self.root, self.logs = spark, root, 0
        os.makedirs(f"{root}/landing")
        os.makedirs(f"{root}/manifest")

    def land(self, name, price):
        with open(f"{self.root}/landing/{name}_{FOLDER}.csv", "w") as out:
            out.write(f"{HEADER}2026-09-01 00:00:00\t{name}\t{price}\t\n")

    def log(self, *entries, header=("file_name", "year", "max_update_time(UTC)")):
        """A new export log; an entry is (name, update text)."""
        self.logs += 1
        path = f"{self.root}/manifest/log{self.logs}.tsv"
        with open(path, "w") as out:
            out.write("\t".join(header) + "\r\n")
            for name, text in entries:
                values = {"file_name": f'"{name}_{FOLDER}.csv"', "year": "2026", "max_update_time(UTC)": text}
                out.write("\t".join(values[h] for h in header) + "\n\n")
            out.write("\t".join({"file_name": "2026_09_Other.csv"}.get(h, "x") for h in header))
        os.utime(path, (1700000000 + self.logs,) * 2)  # a stream takes logs in the order of their times

    def run(self, **options):
        stream_ingest_manifest(self.spark, f"{self.root}/manifest", f"{self.root}/landing", f"{self.root}/raw",
                               f"{self.root}/checkpoint", "energy_prices", **options)

    def rows(self):
        raw = self.spark.read.parquet(f"{self.root}/raw")
        return sorted(tuple(r) for r in raw.select(F.col("load_id").cast("int"), "area_map_code", "price").collect())


def test_files_are_read_when_their_entry_changes(spark, tmp):
    lake = Lake(spark, tmp)
    for name in ("2026_01", "2026_02"):
        lake.land(name, "1")
    lake.log(("2026_01", "2026-01-01 00:00:00"), ("2026_02", "2026-01-01 00:00:00"), ("2026_03", "2026-01-01 00:00:00"))
    lake.run()
    first = [(0, "2026_01", "1"), (0, "2026_02", "1")]
    assert lake.rows() == first
    # Unchanged entries, and text that changed without a new entry, are not read again; the file that was late is.
    lake.land("2026_01", "2")
    lake.land("2026_03", "3")
    lake.log(("2026_01", "2026-01-01 00:00:00"), header=("max_update_time(UTC)", "file_name", "year"))
    lake.run()
    assert lake.rows() == [*first, (1, "2026_03", "3")]
    # An older, an empty and a malformed text are changes too; of two entries the last in update order counts.
    lake.log(("2026_01", "2025-01-01 00:00:00"), ("2026_02", "2026-01-01 00:00:00"), ("2026_02", "2025-01-01 00:00:00"))
    lake.log(("2026_01", ""), ("2026_03", "soon"))
    lake.run()
    assert lake.rows() == [*first, (1, "2026_03", "3"), (2, "2026_01", "2"), (3, "2026_01", "2"), (3, "2026_03", "3")]
    lake.run()
    assert len(lake.rows()) == 6


def test_a_failed_batch_is_read_whole_again(spark, tmp, monkeypatch):
    lake = Lake(spark, tmp)
    lake.land("2026_01", "1")
    lake.log(("2026_01", "a"), ("2026_02", "a"))
    lake.run()
    lake.land("2026_02", "2")
    lake.land("2026_01", "9")
    lake.log(("2026_01", "b"))
    real = manifest_state.write_load

    def fails(*args):
        real(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(manifest_state, "write_load", fails)
    with pytest.raises(Exception, match="lost after the write"):
        lake.run()
    monkeypatch.setattr(manifest_state, "write_load", real)
    lake.run()
    assert lake.rows() == [(0, "2026_01", "1"), (1, "2026_01", "9"), (1, "2026_02", "2")]


def test_seed_loads_nothing(spark, tmp):
    lake = Lake(spark, tmp)
    lake.land("2026_01", "1")
    lake.log(("2026_01", "a"))
    lake.run(seed=True)
    assert not os.path.exists(f"{tmp}/raw")
    lake.log(("2026_01", "a"))
    lake.run()
    assert not os.path.exists(f"{tmp}/raw")
    lake.log(("2026_01", "b"))
    lake.run()
    assert lake.rows() == [(2, "2026_01", "1")]


SCHEMA = "k string, ts timestamp, load_id long, upd timestamp, x double, d decimal(20,3), day date, n timestamp_ntz, b binary"


def some_rows(rng, n, days):
    start = dt.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        at = rng.choice([*(start + dt.timedelta(hours=rng.randrange(24 * days)) for _ in range(9)), None])
        upd = rng.choice([None, start + dt.timedelta(microseconds=rng.randrange(10 ** 6))])
        out.append((rng.choice(["a", 'b"\n\t', None, ""]), at, rng.choice([None, *range(6)]), upd,
                    rng.choice([0.1, float("nan"), float("inf"), None, 1e300, 1 / 3]), None if rng.random() < .3 else Decimal("12345678901234567.891"),
                    rng.choice([None, dt.date(2024, 2, 29)]), rng.choice([None, dt.datetime(2024, 1, 1, 1, 1, 1, 1)]),
                    rng.choice([None, b"\x00\xff"])))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_latest_rows_equal_the_batch(spark, tmp, seed):
    """Out of order, repeated and long late rows, in several batches and two runs with a compaction between."""
    rng = random.Random(seed)
    batches = [some_rows(rng, 60, 10), some_rows(rng, 60, 20), some_rows(rng, 60, 3)]
    batches.append(batches[0][:30] + batches[1][:30])
    grain, keys = ("k", "ts"), {"load_col": "load_id", "tiebreak": ("upd",)}
    seen = []

    def run():
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
        return stream_latest(spark, source, f"{tmp}/table", f"{tmp}/checkpoint", grain, "ts", **keys)

    for k, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        seen += rows
        if k == 0:
            continue
        query = run()
        want = dedupe_latest(spark.createDataFrame(seen, SCHEMA), grain, ("load_id",), ("upd",))
        got = read_latest(spark, f"{tmp}/table", grain, "ts", **keys)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        if k == 2:
            compact(spark, f"{tmp}/table", grain, "ts", **keys)
            got = read_latest(spark, f"{tmp}/table", grain, "ts", **keys)
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    newest = max(r[1] for r in seen if r[1])
    recent = {(r[0], r[1]) for r in seen if r[1] and r[1] >= newest - dt.timedelta(days=2)}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= len(recent)


def test_losers_go_no_further(spark, tmp):
    """A replay changes nothing: its rows are not written again."""
    rows = [("a", dt.datetime(2024, 1, 1), 5, None), ("b", dt.datetime(2024, 1, 1), 5, None)]
    schema = "k string, ts timestamp, load_id long, v string"
    for part in (rows, rows, [("a", dt.datetime(2024, 1, 1), 4, "older"), ("b", dt.datetime(2024, 1, 1), 6, "newer")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        source = spark.readStream.schema(schema).parquet(f"{tmp}/in")
        stream_latest(spark, source, f"{tmp}/table", f"{tmp}/checkpoint", ("k", "ts"), "ts")
    log = spark.read.parquet(f"{tmp}/table/changes")
    assert sorted((r["k"], r["load_id"]) for r in log.collect()) == [("a", 5), ("b", 5), ("b", 6)]


def test_wrong_columns_of_the_order(spark, tmp):
    spark.range(0).select(F.lit("a").alias("k"), F.current_timestamp().alias("ts"), F.lit("1").alias("load_id")).write.parquet(f"{tmp}/in")
    source = spark.readStream.schema("k string, ts timestamp, load_id string").parquet(f"{tmp}/in")
    with pytest.raises(TypeError, match="load_id"):
        changed_rows(source, ("k", "ts"), "ts")
    with pytest.raises(ValueError, match="grain"):
        changed_rows(source, ("k",), "ts")


def test_nothing_written_yet(spark, tmp):
    assert read_latest(spark, f"{tmp}/none", ("k",), "ts") is None
    compact(spark, f"{tmp}/none", ("k", "ts"), "ts")

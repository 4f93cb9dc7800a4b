"""More operators on the driver's tables: scans of the other instruments,
manifest and increment states, replica plans, declared metrics.

Each function takes ``(spark, sf_dir)``; ``SQL`` holds its DuckDB twin.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutc import now_utc_text
from ..operators import audit, incremental, manifest, profile
from ..operators.footers import footer_range, pushed
from ..operators.joins import join_dim
from ..operators.metrics import MODELS, adhoc_sql, metric_query
from ..operators.upsert import write_partitions
from ..schemas import ENTITIES, INSTRUMENTS
from ..session import delete_path, scratch_path
from ..sources.tables import read_table
from ..sources.tsv import instrument_headers, scan_instrument
from . import marts, oracle, staging, sync, testbed
from .export import materialize
from .orchestrate import run_pse
from .rollups import RollupStore

_T = testbed._t


# ---------------------------------------------------------------------------
# scans (S3, S4, S5, S10, S11) and sinks (K2)
# ---------------------------------------------------------------------------


def land_instrument(raw: DataFrame, instrument: str, landing: str, files: int = 4) -> None:
    """Raw rows as header-named text files in two column orders (even and odd load ids)."""
    names = {t: h for h, t in instrument_headers(instrument).items()}
    text = [(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c in ("datetime", "update_time") else F.col(c)).alias(h)
            for c, h in names.items()]
    even = F.col("load_id") % 2 == 0
    for rows, columns in ((even, text), (~even, text[::-1])):
        (raw.where(rows).select(*columns).repartition(files).write.mode("append").option("sep", "\t")
         .option("header", True).option("quote", '"').option("escape", '"').csv(landing))


def _scanned(spark: SparkSession, raw: DataFrame, instrument: str) -> DataFrame:
    landing = scratch_path(spark, f"landing-{instrument}")
    land_instrument(raw, instrument, landing)
    rows = testbed.ntz(scan_instrument(spark, landing, instrument).drop("file_path"))
    measures = INSTRUMENTS[instrument].measures
    # Numbers as numbers: engines write the same double differently.
    return rows.select(*[F.col(c).try_cast("double").alias(c) if c in measures else F.col(c) for c in rows.columns])


def q_scan_imbalance(spark, sf_dir):
    return _scanned(spark, testbed.raw_imbalance(spark, sf_dir), "imbalance_prices")


def q_scan_forecasts(spark, sf_dir):
    return _scanned(spark, testbed.raw_forecasts(spark, sf_dir), "generation_forecasts")


def q_scan_generation(spark, sf_dir):
    return _scanned(spark, testbed.raw_generation(spark, sf_dir), "aggregated_generation")


def q_tsv_forty_columns(spark, sf_dir):
    """A scan by name far beyond the instruments' width."""
    from ..sources.tsv import scan_tsv
    ev = _T(spark, sf_dir, "events")
    landing = scratch_path(spark, "landing-wide")
    wide = ev.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("DateTime(UTC)"),
                     *[F.concat(F.lit(f"c{k}-"), F.col("event_id").cast("string")).alias(f"C{k}") for k in range(40)])
    wide.write.option("sep", "\t").option("header", True).csv(landing)
    return scan_tsv(spark, landing, ["C39", "C7", "absent"]).drop("file_path").withColumnsRenamed({"C39": "c39", "C7": "c7"})


def q_landed_unread(spark, sf_dir):
    m = manifest.annotate(testbed._manifest(spark, sf_dir))
    landed = m.where(F.col("status") == "O").select("filename").distinct()
    return manifest.landed_unread(m, landed).select("filename", "updated")


def q_read_columns(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"])


def q_materialized_mart(spark, sf_dir):
    return materialize(testbed.fct_prices_df(spark, sf_dir), "fct_energy_prices", "table", scratch_path(spark, "mart"))


def q_export_instants(spark, sf_dir):
    """The yearly text export of UTC instants, with and without a fraction, as written."""
    from .export import export_csv_by_year
    ev = _T(spark, sf_dir, "events")
    odd = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", F.col("ts").cast("timestamp"))).otherwise(
        F.col("ts").cast("timestamp"))
    out = scratch_path(spark, "export-instants")
    export_csv_by_year({"events": ev.select("event_id", odd.alias("ts"))}, [2024], out, ts_col="ts")
    return spark.read.schema("event_id long, ts string").option("header", True).csv(f"{out}/events_2024.csv")


# ---------------------------------------------------------------------------
# manifest (M5, M6, M9, M11) and increments
# ---------------------------------------------------------------------------


def q_manifest_named(spark, sf_dir):
    m = testbed._manifest(spark, sf_dir)
    ends = manifest.select_files(m, "EnergyPrices_12.1.D_r3.1").agg(F.min("filename"), F.max("filename")).first()
    return manifest.select_named(m, list(ends), "EnergyPrices_12.1.D_r3.1").select("filename", "updated")


def q_manifest_order(spark, sf_dir):
    """M6 with each entry's position in its folder."""
    m = manifest.annotate(testbed._manifest(spark, sf_dir)).select("folder", "filename", "updated").distinct()
    place = F.row_number().over(Window.partitionBy("folder").orderBy(manifest.order_key()))
    return manifest.order_files(m.withColumn("position", place))


def q_manifest_state(spark, sf_dir):
    """Two commits; a file listed at several times keeps the last in update order."""
    m = manifest.annotate(testbed._manifest(spark, sf_dir))
    state = manifest.commit_state(None, m.where(F.col("status") == "F"))
    return manifest.commit_state(state, m.where(F.col("status") != "F"))


def q_lookback_days(spark, sf_dir):
    ev = _T(spark, sf_dir, "events").withColumn("business_date", F.date_format("ts", "yyyy-MM-dd"))
    days = incremental.lookback_days(3, _dt.date(2024, 1, 30))
    return incremental.by_business_dates(ev, "business_date", days).select("event_id", "business_date")


def q_backfill_start(spark, sf_dir):
    start = incremental.backfill_start(5, _dt.datetime(2024, 1, 30, 12, tzinfo=_dt.timezone.utc))
    return incremental.incremental_since(_T(spark, sf_dir, "events"), "ts", start).select("event_id")


def q_increment_without_baseline(spark, sf_dir):
    """No baseline loads nothing; a fresh seed (now) loads what is published later: events of odd ids are put a century ahead."""
    ev = _T(spark, sf_dir, "events")
    ev = ev.withColumn("ts", F.when(F.col("event_id") % 2 == 1, F.add_months("ts", 1200).cast("timestamp_ntz")).otherwise(F.col("ts")))
    seed = incremental.seed_watermark(spark).first()["watermark"]
    cases = {"no_baseline": None, "seeded": seed}
    parts = [incremental.incremental_since(ev, "ts", start).agg(F.count("*").alias("n")).select(
        F.lit(name).alias("case_name"), "n") for name, start in cases.items()]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# joins, profile, replica (J2, T2, T3, T7, U2, U5, U6, U7), audit (L1), X2, D13
# ---------------------------------------------------------------------------


def q_join_area_code(spark, sf_dir):
    dim = testbed.dim_area_df(spark, sf_dir).select("area_code", F.col("area_name").alias("dim_area_name"))
    fact = testbed.fct_generation_df(spark, sf_dir).select("datetime", "area_code", "production_type", "measure_metric", "actual_mw")
    return join_dim(fact, dim, "area_code")


def q_preview(spark, sf_dir):
    """T2 has no order: its rows are counted, and found in the table."""
    ev = _T(spark, sf_dir, "events")
    shown = profile.preview(ev, 20)
    return shown.join(ev.select("event_id").distinct(), "event_id", "left_semi").agg(F.count("*").alias("n"))


def q_latest_one(spark, sf_dir):
    return profile.latest_one(_T(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", "o_orderdate", "o_totalprice")


def q_ordered_series(spark, sf_dir):
    """T1 with each row's position in the sorted result of its currency."""
    fct = testbed.fct_prices_df(spark, sf_dir).where(F.col("area_map_code") == "NATION_7")
    keys = ["datetime", "resolution_code", "contract_type"]
    place = F.row_number().over(Window.partitionBy("currency").orderBy(*[F.col(c).asc_nulls_last() for c in keys]))
    return profile.order_by(fct.withColumn("position", place), *keys)


def q_profile_columns(spark, sf_dir):
    """T7 over all tables of the schema: every column by its place."""
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations"]
    tables = {name: _T(spark, sf_dir, name) for name in names} | {"raw._dlt_loads": _T(spark, sf_dir, "region")}
    out = profile.profile_tables(tables, "testdata")
    column = F.posexplode(F.split("columns", ", ")).alias("place", "described")
    return out.select("table_name", "row_count", column).select(
        "table_name", "row_count", F.col("place").cast("int"), F.split("described", " ")[0].alias("column_name"))


def _marts(spark, sf_dir) -> dict:
    return {"dim_area": testbed.dim_area_df(spark, sf_dir), "fct_energy_prices": testbed.fct_prices_df(spark, sf_dir),
            "fct_entsoe_imbalance_prices": testbed.fct_imbalance_df(spark, sf_dir), "fct_pse_cor": None}


def q_sync_plan(spark, sf_dir):
    tables = _marts(spark, sf_dir)
    return sync.sync_plan(tables, sync.select_tables(list(tables)))


def q_sync_many(spark, sf_dir):
    """U7 twice: a full copy, then nothing to do or a late window; what the replica holds."""
    tables, root, marts = {}, scratch_path(spark, "replica"), scratch_path(spark, "marts")
    for name, df in _marts(spark, sf_dir).items():
        if df is not None:  # marts are tables when they are copied
            df.write.parquet(f"{marts}/{name}")
            tables[name] = spark.read.parquet(f"{marts}/{name}")
    first = sync.sync_many(spark, tables, root, list(tables))
    second = sync.sync_many(spark, tables, root, list(tables))
    out = None
    for (name, one, _), (_, two, _) in zip(first, second, strict=True):
        part = spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(one).alias("first_run"), F.lit(two).alias("second_run"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def q_watermark_row(spark, sf_dir):
    path = scratch_path(spark, "watermark")
    newest = _T(spark, sf_dir, "events").agg(F.date_format(F.max("ts"), sync.TS_TEXT)).first()[0]
    sync.set_watermark(spark, path, "events", "2000-01-01")
    sync.set_watermark(spark, path, "orders", "1998")
    sync.set_watermark(spark, path, "events", newest)
    return spark.read.parquet(path).select("table_name", "remote_max")


def q_sync_strict(spark, sf_dir):
    """U5 strict: an edit in place of a table without a time column is seen."""
    c = _T(spark, sf_dir, "customer")
    edited = c.withColumn("c_name", F.when(F.col("c_custkey") == 3, F.lit("EDITED")).otherwise(F.col("c_name")))
    rows = [sync.decide(c, other, None, name, strict=strict).select("table_name", "action")
            for name, other, strict in (("same", c.repartition(7, "c_custkey"), True), ("edited_plain", edited, False),
                                        ("edited_strict", edited, True))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def q_sync_old_edit(spark, sf_dir):
    """U3 by digest trees: after a copy an old day is edited in place and another one goes; only these two are copied."""
    root, day = scratch_path(spark, "digests"), F.to_date("ts")
    events = _T(spark, sf_dir, "events").withColumn(sync.PART, day)
    write_partitions(events, f"{root}/source", sync.PART, "static")
    runs = [sync.sync_days(spark, f"{root}/source", f"{root}/replica", f"{root}/trees", "events")[0]]
    edit = (day == F.lit("2024-01-10").cast("date")) & (F.col("event_id") % 2 == 0)
    edited = events.withColumn("value", F.when(edit, F.col("value") + 1).otherwise(F.col("value")))
    write_partitions(edited.where(F.col(sync.PART) == F.lit("2024-01-10").cast("date")), f"{root}/source", sync.PART)
    delete_path(spark, f"{root}/source/{sync.PART}=2024-01-05")
    for _ in range(2):
        action, days = sync.sync_days(spark, f"{root}/source", f"{root}/replica", f"{root}/trees", "events")
        runs.append(" ".join([action, *days]))
    out = spark.read.parquet(f"{root}/replica").drop(sync.PART)
    return out.withColumn("runs", F.lit(", ".join(runs)))


PAGE_ROWS = 1000


def land_pages(df: DataFrame, row: Column, landing: str) -> None:
    """The rows as JSON pages of at most ``PAGE_ROWS`` rows, one page a line, appended to the landing folder.

    Rows that follow each other in a task make a page, so nothing is shuffled or sorted, and a task holds a batch of
    rows however large the table or the group of a key is.
    """
    size = PAGE_ROWS

    def pages(batches):
        import pyarrow as pa
        for batch in batches:
            rows = batch.column(0).to_pylist()
            lines = ['{"value":[' + ",".join(rows[k:k + size]) + "]}" for k in range(0, len(rows), size)]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["page"])

    df.select(F.to_json(row).alias("row")).mapInArrow(pages, "page string").write.mode("append").text(landing)


def q_pse_ingest(spark, sf_dir):
    """G1 for PSE pages of the events, in five runs; the raw rows with their loads, and what the runs report.

    A page of one entity is cut off: it is skipped with its state while the other entity is loaded; once the page is
    whole the first is loaded and the other has nothing new.  Then two days are asked for, and days without pages.
    """
    root, ev = scratch_path(spark, "pse"), _T(spark, sf_dir, "events")
    instant, day = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.date_format("ts", "yyyy-MM-dd")
    rows = {"cor": F.struct(instant.alias("dtime_utc"), day.alias("business_date"), F.col("value").alias("cor_cost"),
                            F.col("event_id").cast("double").alias("cor_fcst"), instant.alias("publication_ts_utc")),
            "zmb": F.struct(instant.alias("dtime_utc"), day.alias("business_date"), F.col("event_id").cast("double").alias("zmb_fcrg"),
                            instant.alias("publication_ts_utc"))}
    for key, row in rows.items():  # pages of ten days in files of their own, one page a line
        for part in range(4):
            land_pages(ev.where(F.floor(F.dayofmonth("ts") / 10) == part), row, f"{root}/landing/pse/{key}")
    broken = f"{root}/landing/pse/zmb"
    spark.createDataFrame([('{"value": [{"dtime_utc": "2024-01-01 00',)], "value string").coalesce(1).write.text(f"{root}/broken")
    spark.read.text(f"{root}/broken").coalesce(1).write.mode("append").text(broken)
    cut = [r["path"] for r in manifest.list_landed(spark, broken).where("length < 100").select("path").collect()]
    first = "2024-01-04 12:00:00"
    runs = [run_pse(spark, root, start=first, multi_line=False, on_error="skip")]
    for path in cut:
        delete_path(spark, path)
    runs.append(run_pse(spark, root, start=None, multi_line=False, on_error="skip"))
    runs.append(run_pse(spark, root, start=first, entities={"zmb": ENTITIES["zmb"]}, multi_line=False))
    runs.append(run_pse(spark, root, dates=["2024-01-02", "2024-01-03"], entities={"cor": ENTITIES["cor"]}, multi_line=False))
    runs.append(run_pse(spark, root, dates=["2031-01-01"], entities={"cor": ENTITIES["cor"]}, multi_line=False))
    told = " | ".join(", ".join(f"{k} {v.split(':')[0]}" for k, v in sorted(run.items())) for run in runs)
    parts = [spark.read.parquet(f"{root}/raw_pse/{key}").select(F.lit(key).alias("entity"), "dtime_utc", F.col(measure).alias("value"),
                                                                F.col("load_id").cast("int").alias("load_id"))
             for key, measure in (("cor", "cor_fcst"), ("zmb", "zmb_fcrg"))]
    return testbed.ntz(parts[0].unionByName(parts[1])).withColumn("runs", F.lit(told))


def q_footer_ranges(spark, sf_dir):
    """A1, A2, A3 of three tables from their footers; none of them is scanned."""
    out = None
    for table, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("events", "event_id")):
        one = footer_range(spark, f"{sf_dir}/{table}.parquet", [key])
        if not pushed(one):
            raise RuntimeError(f"{table} would be scanned")
        values = one.first()  # three numbers out of footers, from the footer session into this one
        row = spark.range(1).select(F.lit(table).alias("table_name"), *[
            F.lit(values[c]).cast("bigint").alias(n) for c, n in (("row_count", "row_count"), (f"min_{key}", "least"), (f"max_{key}", "greatest"))])
        out = row if out is None else out.unionByName(row)
    return out


def q_load_summary(spark, sf_dir):
    events = audit.parse_events(testbed._log_lines(spark, sf_dir))
    expected = audit.expected_frame(spark, {"click": 2000, "view": 2500, "purchase": 100, "signup": 0, "energy_prices": 21})
    start = spark.range(1).select(F.lit("2024-01-01 00:00:00").alias("t0"))
    totals = audit.load_totals(events, expected, start, _dt.datetime(2024, 1, 1, 1))
    return totals.select("expected", "started", "done", "rows", "last_file",
                         F.round("files_per_minute", 6).alias("files_per_minute"), F.round("minutes_left", 6).alias("minutes_left"))


def q_adhoc_sql(spark, sf_dir):
    views = {"adhoc_prices": testbed.fct_prices_df(spark, sf_dir)}
    return adhoc_sql(spark, views, "SELECT contract_type, COUNT(*) AS n, MAX(price) AS top FROM adhoc_prices GROUP BY contract_type")


def q_now_text(spark, sf_dir):
    shape = now_utc_text().rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    return _T(spark, sf_dir, "events").select("event_id", shape.alias("is_utc_text"))


# ---------------------------------------------------------------------------
# declared metrics
# ---------------------------------------------------------------------------


def q_metric_forecasts(spark, sf_dir):
    return metric_query(testbed.fct_forecasts_df(spark, sf_dir), "fct_entsoe_generation_forecasts",
                        ["forecast_category", "production_type", "resolution_code"], round_to=4, with_count=True)


def q_metric_zmb(spark, sf_dir):
    return metric_query(marts.fct_pse_zmb(staging.stg_pse_zmb(testbed.raw_zmb(spark, sf_dir))), "fct_pse_zmb", ["product"], round_to=4, with_count=True)


def q_metric_cor(spark, sf_dir):
    return metric_query(marts.fct_pse_cor(staging.stg_pse_cor(testbed.raw_cor(spark, sf_dir))), "fct_pse_cor", ["business_date"], round_to=6, with_count=True)


#: Mart -> (its time column, the dimension that the rollup query groups by).
_ROLLED = {"fct_energy_prices": ("datetime", "area_map_code"), "fct_entsoe_imbalance_prices": ("datetime", "price_metric"),
           "fct_entsoe_generation_forecasts": ("datetime", "production_type"),
           "fct_entsoe_aggregated_generation": ("datetime", "measure_metric"),
           "fct_pse_zmb": ("dtime_utc", "product"), "fct_pse_cor": ("dtime_utc", "business_date")}


def q_metric_rollups(spark, sf_dir):
    """All 19 metrics from stored rollups, after a day of every mart was replaced by other values and another one removed."""
    facts = {"fct_energy_prices": testbed.fct_prices_df(spark, sf_dir), "fct_entsoe_imbalance_prices": testbed.fct_imbalance_df(spark, sf_dir),
             "fct_entsoe_generation_forecasts": testbed.fct_forecasts_df(spark, sf_dir),
             "fct_entsoe_aggregated_generation": testbed.fct_generation_df(spark, sf_dir),
             "fct_pse_zmb": marts.fct_pse_zmb(staging.stg_pse_zmb(testbed.raw_zmb(spark, sf_dir))),
             "fct_pse_cor": marts.fct_pse_cor(staging.stg_pse_cor(testbed.raw_cor(spark, sf_dir)))}
    # The orders' seven years of days are folded into four weeks, to keep the number of day folders low.
    for mart in ("fct_entsoe_generation_forecasts", "fct_pse_zmb"):
        time_col = _ROLLED[mart][0]
        weeks = F.date_add(F.lit("2024-01-01").cast("date"), F.datediff(time_col, F.lit("1992-01-01").cast("date")) % 28)
        facts[mart] = facts[mart].withColumn(time_col, weeks.cast(facts[mart].schema[time_col].dataType))
    root, out = scratch_path(spark, "rollups"), None
    for mart, (time_col, dim) in _ROLLED.items():
        path, store = f"{root}/marts/{mart}", RollupStore(spark, f"{root}/rollups", mart)
        rows = marts.with_partition_date(facts[mart], time_col)
        write_partitions(rows, path, "part_date", "static")
        store.refresh(path)
        measures = {m.column for m in MODELS[mart].metrics}
        changed = rows.where(F.col("part_date") == F.lit("2024-01-10").cast("date"))
        write_partitions(changed.withColumns({c: F.col(c) * 2 for c in measures}), path, "part_date")
        delete_path(spark, f"{path}/part_date=2024-01-05")
        if store.refresh(path) != ["2024-01-05", "2024-01-10"]:
            raise RuntimeError("other days than the changed ones were computed anew")
        places = {"average": 7, "sum": 3, "max": 9, "min": 9}
        answer = store.answer([dim])
        if any("/marts/" in f for f in answer.inputFiles()):
            raise RuntimeError("the answer reads the mart")
        long = answer.select(F.lit(mart).alias("model"), F.col(dim).cast("string").alias("dim"), F.explode(F.array(*[
            F.struct(F.lit(m.name).alias("metric"), F.round(F.col(m.name).cast("double"), places[m.kind]).alias("value"))
            for m in MODELS[mart].metrics])).alias("m"))
        long = long.select("model", "dim", "m.metric", "m.value")
        out = long if out is None else out.unionByName(long)
    return out


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}


def _numbers(columns: str) -> str:
    return ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in columns.split())


_AREA = "datetime, resolution_code, area_code, area_name, area_type_code, area_map_code, "
_TS = "TRY_CAST(replace(updated, 'T', ' ') AS TIMESTAMP)"
_FOLD = ("* REPLACE (DATE '2024-01-01' + CAST(date_diff('day', DATE '1992-01-01', CAST({0} AS DATE)) % 28 AS INTEGER) AS {0})")
_FOLDED = ("folded_forecasts AS (SELECT " + _FOLD.format("datetime") + " FROM fct_forecasts),\nfolded_zmb AS (SELECT "
           + _FOLD.format("dtime_utc") + " FROM stg_zmb UNPIVOT (demand_mw FOR product IN (" + ", ".join(oracle._ZMB) + ")))")
_FACTS = {"fct_energy_prices": "fct_prices", "fct_entsoe_imbalance_prices": "fct_imbalance",
          "fct_entsoe_generation_forecasts": "folded_forecasts", "fct_entsoe_aggregated_generation": "fct_generation",
          "fct_pse_zmb": "folded_zmb", "fct_pse_cor": "stg_cor"}
_SQL_KIND = {"average": "ROUND(AVG({0}), 7)", "sum": "ROUND(SUM({0}), 3)", "max": "ROUND(MAX({0}), 9)", "min": "ROUND(MIN({0}), 9)"}


def _rollup_sql() -> str:
    """Every metric straight from the facts, with the changed day's values doubled and the removed day left out."""
    parts = []
    for mart, (t, dim) in _ROLLED.items():
        for m in MODELS[mart].metrics:
            value = f"(CASE WHEN CAST({t} AS DATE) = DATE '2024-01-10' THEN 2 * {m.column} ELSE {m.column} END)"
            parts.append(f"SELECT '{mart}' AS model, CAST({dim} AS VARCHAR) AS dim, '{m.name}' AS metric, "
                         f"CAST({_SQL_KIND[m.kind].format(value)} AS DOUBLE) AS value FROM {_FACTS[mart]} "
                         f"WHERE CAST({t} AS DATE) <> DATE '2024-01-05' GROUP BY {dim}")
    facts = [oracle.FCT_IMBALANCE, oracle.FCT_FORECASTS, oracle.FCT_GENERATION]
    ctes = [oracle.STG_PRICES, *[f[len(oracle.AREAS) + 2:] for f in facts], oracle.FCT_ZMB, _FOLDED, oracle.FCT_COR]
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(parts)


_METRICS = "ROUND(AVG({0}), {2}) AS average_{1}, MAX({0}) AS max_{1}"

SQL = {
    "scan_imbalance": "WITH " + oracle.FCT_IMBALANCE + "\nSELECT " + _AREA + _numbers(" ".join(oracle._IMB))
    + ", currency, status, update_time FROM raw_imbalance",
    "scan_forecasts": "WITH " + oracle.FCT_FORECASTS + "\nSELECT " + _AREA + "production_type, " + _numbers(
        "day_ahead_generation_forecast_mw intraday_generation_forecast_mw current_generation_forecast_mw")
    + ", update_time FROM raw_forecasts",
    "scan_generation": "WITH " + oracle.FCT_GENERATION + "\nSELECT " + _AREA + "production_type, "
    + _numbers("actual_generation_output_mw actual_consumption_mw") + ", update_time FROM raw_generation",
    "tsv_forty_columns": "SELECT 'c39-' || CAST(event_id AS VARCHAR) AS c39, 'c7-' || CAST(event_id AS VARCHAR) AS c7, "
    "'' AS absent FROM events",
    "landed_unread": "WITH " + oracle.MANIFEST + """
SELECT filename, updated FROM annotated WHERE filename NOT IN (SELECT filename FROM annotated WHERE status = 'O')""",
    "read_columns": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders",
    "materialized_mart": oracle.SQL["fct_prices"],
    "export_instants": """
SELECT event_id, CASE WHEN event_id % 2 = 0 OR date_trunc('second', ts) = ts
       THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') END || '+00' AS ts
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'""",
    "manifest_named": "WITH " + oracle.MANIFEST + """,
ends AS (SELECT min(filename) AS a, max(filename) AS b FROM annotated WHERE folder = 'EnergyPrices_12.1.D_r3.1')
SELECT filename, updated FROM annotated, ends WHERE folder = 'EnergyPrices_12.1.D_r3.1' AND filename IN (a, b)""",
    "manifest_order": "WITH " + oracle.MANIFEST + f"""
SELECT folder, filename, updated, CAST(row_number() OVER (PARTITION BY folder
       ORDER BY ({_TS} IS NULL), {_TS}, filename) AS INTEGER) AS position
FROM (SELECT DISTINCT folder, filename, updated FROM annotated)""",
    "manifest_state": "WITH " + oracle.MANIFEST + f""",
ranked AS (SELECT filename, updated, status = 'F' AS old, row_number() OVER (PARTITION BY filename, status = 'F'
             ORDER BY ({_TS} IS NULL) DESC, {_TS} DESC) AS rn FROM annotated)
SELECT filename, updated FROM ranked r WHERE rn = 1
  AND (NOT old OR filename NOT IN (SELECT filename FROM annotated WHERE status <> 'F'))""",
    "lookback_days": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS business_date FROM events
WHERE strftime(ts, '%Y-%m-%d') IN ('2024-01-28', '2024-01-29', '2024-01-30')""",
    "backfill_start": "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-25 12:00:00'",
    "increment_without_baseline": """
SELECT 'no_baseline' AS case_name, count(*) AS n FROM events WHERE FALSE
UNION ALL SELECT 'seeded' AS case_name, count(*) AS n FROM events WHERE event_id % 2 = 1""",
    "join_area_code": "WITH " + oracle.STG_PRICES + ",\n" + oracle.FCT_GENERATION[len(oracle.AREAS) + 2:] + """,
dims AS (SELECT DISTINCT area_code, area_name AS dim_area_name, area_map_code, area_type_code FROM stg_prices)
SELECT f.datetime, f.area_code, f.production_type, f.measure_metric, f.actual_mw, d.dim_area_name
FROM fct_generation f LEFT JOIN dims d ON f.area_code = d.area_code""",
    "preview": "SELECT least(20, count(*)) AS n FROM events",
    "latest_one": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 1",
    "ordered_series": "WITH " + oracle.STG_PRICES + """
SELECT *, CAST(row_number() OVER (PARTITION BY currency ORDER BY datetime, resolution_code, contract_type) AS INTEGER) AS position
FROM fct_prices WHERE area_map_code = 'NATION_7'""",
    "sync_plan": "WITH " + oracle.STG_PRICES + ",\n" + oracle.FCT_IMBALANCE[len(oracle.AREAS) + 2:] + """
SELECT 'dim_area' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS max_ts, 'full/dictionary' AS mode,
       CAST(NULL AS INTEGER) AS overlap_days
FROM (SELECT DISTINCT area_map_code, area_code, area_name, area_type_code FROM stg_prices)
UNION ALL SELECT 'fct_energy_prices', count(*), strftime(max(datetime), '%Y-%m-%d %H:%M:%S.%f'), 'append', 2 FROM fct_prices
UNION ALL SELECT 'fct_entsoe_imbalance_prices', count(*), strftime(max(datetime), '%Y-%m-%d %H:%M:%S.%f'), 'append', 2
FROM fct_imbalance
UNION ALL SELECT 'fct_pse_cor', NULL, NULL, 'missing', NULL""",
    "sync_many": "WITH " + oracle.STG_PRICES + ",\n" + oracle.FCT_IMBALANCE[len(oracle.AREAS) + 2:] + """
SELECT 'dim_area' AS table_name, 'replace-small' AS first_run, 'skip' AS second_run, count(*) AS row_count
FROM (SELECT DISTINCT area_map_code, area_code, area_name, area_type_code FROM stg_prices)
UNION ALL SELECT 'fct_energy_prices', 'full-copy', 'append', count(*) FROM fct_prices
UNION ALL SELECT 'fct_entsoe_imbalance_prices', 'full-copy', 'append', count(*) FROM fct_imbalance""",
    "watermark_row": """
SELECT 'events' AS table_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS remote_max FROM events
UNION ALL SELECT 'orders', '1998'""",
    "metric_rollups": _rollup_sql(),
    "footer_ranges": """
SELECT 'lineitem' AS table_name, count(*) AS row_count, min(l_orderkey) AS least, max(l_orderkey) AS greatest FROM lineitem
UNION ALL SELECT 'orders', count(*), min(o_orderkey), max(o_orderkey) FROM orders
UNION ALL SELECT 'events', count(*), min(event_id), max(event_id) FROM events""",
    "pse_ingest": """
WITH loads AS (
  SELECT 'cor' AS entity, ts, event_id, 1 AS load_id FROM events WHERE ts > TIMESTAMP '2024-01-04 12:00:00'
  UNION ALL SELECT 'zmb', ts, event_id, 1 FROM events WHERE ts > TIMESTAMP '2024-01-04 12:00:00'
  UNION ALL SELECT 'cor', ts, event_id, 2 FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-02', DATE '2024-01-03'))
SELECT entity, ts AS dtime_utc, CAST(event_id AS DOUBLE) AS value, load_id,
       'cor loaded, zmb failed | cor nothing new, zmb no baseline | zmb loaded | cor loaded | cor nothing of these days' AS runs
FROM loads""",
    "sync_old_edit": """
SELECT * REPLACE (CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' AND event_id % 2 = 0 THEN value + 1 ELSE value END AS value),
       'full-copy, resync 2024-01-05 2024-01-10, skip' AS runs
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-05'""",
    "sync_strict": """
SELECT 'same' AS table_name, 'skip' AS action UNION ALL SELECT 'edited_plain', 'skip'
UNION ALL SELECT 'edited_strict', 'replace-small'""",
    "load_summary": """
SELECT CAST(4621 AS BIGINT) AS expected, count(*) AS started, count(*) FILTER (event_type <> 'error') AS done,
       CAST(sum(CASE WHEN event_type <> 'error' THEN floor(value) ELSE 0 END) AS BIGINT) AS rows,
       '2024_01_' || CAST(max(event_id) AS VARCHAR) || '.csv' AS last_file,
       ROUND(count(*) / 60.0, 6) AS files_per_minute,
       ROUND(greatest(4621 - count(*), 0) / greatest(count(*) / 60.0, 0.01), 6) AS minutes_left
FROM events""",
    "adhoc_sql": "WITH " + oracle.STG_PRICES + """
SELECT contract_type, COUNT(*) AS n, MAX(price) AS top FROM fct_prices GROUP BY contract_type""",
    "now_text": "SELECT event_id, TRUE AS is_utc_text FROM events",
    "metric_forecasts": "WITH " + oracle.FCT_FORECASTS + """
SELECT forecast_category, production_type, resolution_code, """ + _METRICS.format("forecast_mw", "forecast_mw", 4) + """,
       ROUND(SUM(forecast_mw), 4) AS total_forecast_mw, COUNT(*) AS row_count
FROM fct_forecasts GROUP BY ALL""",
    "metric_zmb": "WITH " + oracle.FCT_ZMB + """
SELECT product, """ + _METRICS.format("demand_mw", "demand_mw", 4) + """, ROUND(SUM(demand_mw), 4) AS total_demand_mw,
       COUNT(*) AS row_count
FROM stg_zmb UNPIVOT (demand_mw FOR product IN (""" + ", ".join(oracle._ZMB) + """)) GROUP BY product""",
    "metric_cor": "WITH " + oracle.FCT_COR + """
SELECT business_date, """ + _METRICS.format("cor_cost", "cor_cost", 6) + ", " + _METRICS.format("cor_fcst", "cor_fcst", 6) + """,
       COUNT(*) AS row_count
FROM stg_cor GROUP BY business_date""",
}

# The columns of the given tables, in order.
_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
SQL["profile_columns"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, CAST({k} AS INTEGER) AS place, '{c}' AS column_name"
    for t, columns in _COLUMNS.items() for k, c in enumerate(columns.split()))

"""The library's operators run on the driver's tables.

The driver's tables are not energy data, so each operator is exercised on
relations *shaped* like the raw energy tables and derived from them by Spark
(whole tables, no sampling).  Every function here takes ``(spark, sf_dir)``
and returns a DataFrame; ``SQL`` holds the equivalent DuckDB statement for
the correctness gate.  Timestamps leave as ``timestamp_ntz`` (wall clock in
UTC) so both engines agree on the value.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import try_double
from ..functions.text import text_or_empty
from ..functions.timeutc import format_utc, with_utc
from ..operators import audit, incremental, manifest, profile, quality
from ..operators.joins import join_dim
from ..operators.metrics import metric_query
from ..operators.reshape import unpivot_long
from ..operators.upsert import merge_rows
from ..sources.pages import normalize_entity, parse_pages
from ..sources.tables import read_sf_table
from . import marts, staging, sync
from .export import counts_by_year, rows_for_year, union_slices

# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_sf_table(spark, sf_dir, name)


def ntz(df: DataFrame) -> DataFrame:
    """Instants leave as timestamp_ntz (UTC wall clock)."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region as an area dimension (25 rows)."""
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    dim = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("area_key"),
        F.col("n_name").alias("area_map_code"),
        F.concat(F.lit("EIC-"), F.col("n_nationkey").cast("string")).alias("area_code"),
        F.lower("n_name").alias("area_name"),
        F.col("r_name").alias("area_type_code"))
    return dim


def _with_area(df: DataFrame, areas: DataFrame, key) -> DataFrame:
    return df.join(areas, key.cast("int") == areas.area_key).drop("area_key")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# ---------------------------------------------------------------------------
# raw relations shaped like the landed energy tables
# ---------------------------------------------------------------------------


def raw_prices(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    e = F.col("event_id")
    price = (F.when(e % 10 == 0, F.lit("")).when(e % 17 == 0, F.lit("n/e"))
             .when(e % 7 == 0, F.concat(F.lit(" "), _s("value"), F.lit(" ")))
             .otherwise(_s("value")))
    return _with_area(ev, _areas(spark, sf_dir), F.col("user_id") % 25).select(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("datetime"),
        F.when(e % 4 == 0, "PT15M").otherwise("PT60M").alias("resolution_code"),
        "area_code", "area_name", "area_type_code", "area_map_code",
        F.col("event_type").alias("contract_type"), price.alias("price"),
        F.lit("EUR").alias("currency"), F.col("ts").alias("update_time"),
        e.alias("load_id"))


def raw_imbalance(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    e, v = F.col("event_id"), F.col("value")
    return _with_area(ev, _areas(spark, sf_dir), F.col("user_id") % 25).select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"),
        F.when(e % 4 == 0, "PT15M").otherwise("PT60M").alias("resolution_code"),
        "area_code", "area_name", "area_type_code", "area_map_code",
        F.when(e % 5 == 0, "PLN").otherwise("EUR").alias("currency"),
        F.when(F.col("event_type") == "error", "A").otherwise("").alias("status"),
        _s(v).alias("positive_imbalance_price"),
        F.when(e % 3 == 0, _s(v / 4)).otherwise("").alias("positive_scarcity_price"),
        F.lit("").alias("positive_incentive_price"),
        F.when(e % 11 == 0, "n/e").otherwise(_s(v * 0.1))
        .alias("positive_financial_neutrality_price"),
        _s(-v).alias("negative_imbalance_price"),
        F.lit("").alias("negative_scarcity_price"),
        F.when(F.col("event_type") == "click", _s(v * 2)).otherwise("")
        .alias("negative_incentive_price"),
        F.lit("").alias("negative_financial_neutrality_price"),
        F.col("ts").alias("update_time"), e.alias("load_id"))


def raw_generation(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    e, v = F.col("event_id"), F.col("value")
    return _with_area(ev, _areas(spark, sf_dir), F.col("user_id") % 25).select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"),
        F.lit("PT60M").alias("resolution_code"),
        "area_code", "area_name", "area_type_code", "area_map_code",
        F.col("event_type").alias("production_type"),
        _s(v).alias("actual_generation_output_mw"),
        F.when(e % 3 == 0, "").otherwise(_s(v / 2)).alias("actual_consumption_mw"),
        F.col("ts").alias("update_time"), e.alias("load_id"))


def raw_forecasts(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    st, tp = F.col("o_orderstatus"), F.col("o_totalprice")
    return _with_area(o, _areas(spark, sf_dir), F.col("o_custkey") % 25).select(
        F.col("o_orderdate").alias("datetime"),
        F.when(st == "O", "PT15M").otherwise("PT60M").alias("resolution_code"),
        "area_code", "area_name", "area_type_code", "area_map_code",
        F.col("o_orderpriority").alias("production_type"),
        _s(tp).alias("day_ahead_generation_forecast_mw"),
        F.when(st == "F", "").otherwise(_s(tp / 2)).alias("intraday_generation_forecast_mw"),
        F.when(st == "P", "n/e").otherwise(_s(tp / 3)).alias("current_generation_forecast_mw"),
        F.col("o_orderdate").alias("update_time"), F.col("o_orderkey").alias("load_id"))


def raw_zmb(spark, sf_dir) -> DataFrame:
    """PSE-shaped rows from orders: text instants normalised strictly."""
    o = _t(spark, sf_dir, "orders")
    st, tp = F.col("o_orderstatus"), F.col("o_totalprice")
    rows = o.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dtime_utc"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("business_date"),
        tp.alias("zmb_fcrg"),
        F.when(st == "F", F.lit(None).cast("double")).otherwise(tp / 2).alias("zmb_fcrd"),
        F.col("o_custkey").cast("double").alias("zmb_frrg"),
        F.lit(None).cast("double").alias("zmb_frrd"),
        (tp / 4).alias("zmb_afrrg"),
        F.when(st == "O", tp / 5).alias("zmb_afrrd"),
        F.col("o_orderkey").cast("double").alias("zmb_rrg"),
        F.when(F.col("o_orderpriority") == "1-URGENT", tp / 6).alias("zmb_rrd"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 12:00:00.265000"))
        .alias("publication_ts_utc"),
        F.col("o_orderkey").alias("load_id"))
    return normalize_entity(rows, "zmb")


def raw_cor(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    v = F.col("value")
    rows = ev.select(
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("dtime_utc"),
        F.date_format("ts", "yyyy-MM-dd").alias("business_date"),
        v.alias("cor_cost"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .otherwise(v * 1.5).alias("cor_fcst"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("publication_ts_utc"),
        F.col("event_id").alias("load_id"))
    return normalize_entity(rows, "cor")


def stg_prices(spark, sf_dir) -> DataFrame:
    return staging.stg_energy_prices(raw_prices(spark, sf_dir))


def fct_prices_df(spark, sf_dir) -> DataFrame:
    return marts.fct_energy_prices(stg_prices(spark, sf_dir))


def dim_area_df(spark, sf_dir) -> DataFrame:
    return marts.dim_area(stg_prices(spark, sf_dir))


def fct_imbalance_df(spark, sf_dir) -> DataFrame:
    return marts.fct_imbalance_prices(staging.stg_imbalance_prices(raw_imbalance(spark, sf_dir)))


def fct_generation_df(spark, sf_dir) -> DataFrame:
    return marts.fct_aggregated_generation(
        staging.stg_aggregated_generation(raw_generation(spark, sf_dir)))


def fct_forecasts_df(spark, sf_dir) -> DataFrame:
    return marts.fct_generation_forecasts(
        staging.stg_generation_forecasts(raw_forecasts(spark, sf_dir)))


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------


def q_parse_double_try(spark, sf_dir):
    raw = raw_prices(spark, sf_dir)
    return raw.select("load_id", text_or_empty("price").alias("price_text_clean"),
                      try_double("price").alias("price"))


def q_dedupe_latest_prices(spark, sf_dir):
    return stg_prices(spark, sf_dir)


def q_fct_prices(spark, sf_dir):
    return fct_prices_df(spark, sf_dir)


def q_dim_area_distinct(spark, sf_dir):
    return dim_area_df(spark, sf_dir)


def q_fact_join_dim(spark, sf_dir):
    dim = _areas(spark, sf_dir).drop("area_key")
    return join_dim(fct_prices_df(spark, sf_dir), dim, "area_map_code", how="left")


def q_unpivot_measures(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    wide = li.select("l_orderkey", "l_linenumber", "l_shipdate",
                     F.col("l_quantity").alias("quantity"),
                     F.nullif("l_discount", F.lit(0.0)).alias("discount"),
                     F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return unpivot_long(wide, ["l_orderkey", "l_linenumber", "l_shipdate"],
                        ["quantity", "discount", "tax"], "metric", "value")


def q_unpivot_categories(spark, sf_dir):
    return fct_imbalance_df(spark, sf_dir)


def q_fct_generation_long(spark, sf_dir):
    return fct_generation_df(spark, sf_dir)


def q_fct_forecasts_long(spark, sf_dir):
    return fct_forecasts_df(spark, sf_dir)


def q_fct_pse_zmb(spark, sf_dir):
    return ntz(marts.fct_pse_zmb(staging.stg_pse_zmb(raw_zmb(spark, sf_dir))))


def q_fct_pse_cor(spark, sf_dir):
    return ntz(marts.fct_pse_cor(staging.stg_pse_cor(raw_cor(spark, sf_dir))))


def q_metric_prices_by_area(spark, sf_dir):
    dim = _areas(spark, sf_dir).drop("area_key")
    return metric_query(fct_prices_df(spark, sf_dir), "fct_energy_prices",
                        dims=["area_map_code", "area_type_code"], dim_area=dim,
                        round_to=6, with_count=True)


def q_metric_totals_long(spark, sf_dir):
    return metric_query(fct_generation_df(spark, sf_dir), "fct_entsoe_aggregated_generation",
                        dims=["measure_category", "production_type", "resolution_code"],
                        round_to=4, with_count=True)


def q_metric_imbalance_daily(spark, sf_dir):
    return ntz(metric_query(fct_imbalance_df(spark, sf_dir), "fct_entsoe_imbalance_prices",
                            dims=["datetime", "direction", "price_category"],
                            grain={"datetime": "day"}, round_to=6, with_count=True))


def q_price_series_filtered(spark, sf_dir):
    return profile.price_series(fct_prices_df(spark, sf_dir), "NATION_7", "click", "PT60M")


def q_year_slice(spark, sf_dir):
    return rows_for_year(_t(spark, sf_dir, "orders"), "o_orderdate", 1997)


def q_year_counts(spark, sf_dir):
    return counts_by_year(_t(spark, sf_dir, "orders"), "o_orderdate", range(1995, 2003))


def _orders_upsert_parts(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    source = (o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
              .withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
              .withColumn("o_orderstatus", F.lit("U")))
    return target, source


def q_upsert_keyed(spark, sf_dir):
    target, source = _orders_upsert_parts(spark, sf_dir)
    return merge_rows(target, source, ["o_orderkey"])


def _events_replica(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    late = F.lit("2024-01-18").cast("timestamp_ntz")
    lost = F.lit("2024-01-10").cast("timestamp_ntz")
    etype = F.col("event_type")
    remote = ev.where((F.col("ts") < cut)
                      & ~((F.col("ts") >= late) & (etype == "error"))
                      & ~((F.col("ts") < lost) & (etype == "signup")))
    return ev, remote


def q_replace_window_overlap(spark, sf_dir):
    local, remote = _events_replica(spark, sf_dir)
    return sync.replace_window(remote, local, "ts", overlap_days=2)


def q_sync_signature(spark, sf_dir):
    local, remote = _events_replica(spark, sf_dir)
    a = sync.table_signature(local, "ts").select(F.lit("local").alias("side"), "*")
    b = sync.table_signature(remote, "ts").select(F.lit("remote").alias("side"), "*")
    return a.unionByName(b)


def q_sync_decision(spark, sf_dir):
    local, remote = _events_replica(spark, sf_dir)
    o = _t(spark, sf_dir, "orders")
    n = _t(spark, sf_dir, "nation")
    rows = [
        sync.decide(local, remote, "ts", "events", overlap_days=2),
        sync.decide(local, remote, "ts", "events_force", overlap_days=2, force=True),
        sync.decide(local, local.where(F.lit(False)), "ts", "events_empty", overlap_days=2),
        sync.decide(local, None, "ts", "events_missing", overlap_days=2),
        sync.decide(local.where(F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")),
                    remote, "ts", "events_behind", overlap_days=0),
        sync.decide(o, o, "o_orderdate", "orders_same", overlap_days=2),
        sync.decide(n, n, None, "nation_same"),
        sync.decide(n, n.where(F.col("n_regionkey") != 0), None, "nation_changed"),
        sync.decide(n, None, None, "nation_missing"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def q_incremental_since(spark, sf_dir):
    return incremental.incremental_since(_t(spark, sf_dir, "events"), "ts",
                                         "2024-01-25 00:00:00")


def q_watermark_advance(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    newer = incremental.incremental_since(ev, "ts", "2024-01-25 00:00:00")
    a = incremental.advance_watermark(newer, "ts", "2024-01-25 00:00:00") \
        .select(F.lit("rows").alias("case_name"), "watermark")
    b = incremental.advance_watermark(newer.where(F.lit(False)), "ts", "2024-01-25 00:00:00") \
        .select(F.lit("empty").alias("case_name"), "watermark")
    return a.unionByName(b)


def q_business_dates_slice(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    days = ["2024-01-03", "2024-01-15"] + incremental.dates_from(
        "2024-01-27", today=_dt.date(2024, 1, 30))
    return incremental.by_time_days(ev, "ts", days)


def _manifest(spark, sf_dir) -> DataFrame:
    """A file manifest shaped from orders: one entry per order."""
    o = _t(spark, sf_dir, "orders")
    pri = F.col("o_orderpriority")
    # The four instrument folders plus one unknown folder.
    folder = (F.when(pri == "1-URGENT", "EnergyPrices_12.1.D_r3.1")
              .when(pri == "2-HIGH", "ImbalancePrices_17.1.G_r3.1")
              .when(pri == "3-MEDIUM", "GenerationForecastsForWindAndSolar_14.1.D_r3")
              .when(pri == "4-NOT SPECIFIED", "AggregatedGenerationPerType_16.1.B_C_r3")
              .otherwise("Unknown_1.A"))
    k = F.col("o_orderkey")
    prefix = F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy_MM_dd")) \
        .otherwise(F.date_format("o_orderdate", "yyyy_MM"))
    ext = F.when(k % 5 == 0, ".CSV").when(k % 5 == 1, ".csv").otherwise("")
    name = F.concat(prefix, F.lit("_"), folder, ext)
    updated = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T"),
                 F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":00:00")))
    return o.select(name.alias("file_name"), updated.alias("updated"),
                    F.col("o_orderstatus").alias("status"))


def q_manifest_folder(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return manifest.annotate(m).select("file_name", "folder")


def q_manifest_normalize(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return manifest.annotate(m).select("file_name", "filename", "year")


def q_manifest_select_years(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return manifest.select_files(m, "ImbalancePrices_17.1.G_r3.1", years=[1996, 1998]) \
        .select("filename", "updated")


def q_manifest_latest(spark, sf_dir):
    return manifest.latest_per_folder(manifest.annotate(_manifest(spark, sf_dir)))


def q_manifest_limit(spark, sf_dir):
    return manifest.limit_files_per_group(manifest.annotate(_manifest(spark, sf_dir)), 3) \
        .select("folder", "year", "filename", "updated")


def q_manifest_changed(spark, sf_dir):
    m = manifest.annotate(_manifest(spark, sf_dir))
    state = (m.where(F.col("status") != "O").groupBy("filename")
             .agg(F.min("updated").alias("updated")))
    return manifest.changed_files(m, state).select("filename", "updated")


def q_json_rows(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    row = F.struct("event_id", "props")
    page = F.when(F.col("event_type") == "error",
                  F.to_json(F.struct(F.lit("end").alias("nextLink")))) \
        .otherwise(F.to_json(F.struct(F.array(row).alias("value"),
                                      F.lit("next").alias("nextLink"))))
    pages = ev.select(page.alias("page"))
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("props", T.StringType())])
    rows = parse_pages(pages, "page", schema)
    return rows.select("event_id",
                       F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def q_merge_monthly(spark, sf_dir):
    raw = raw_prices(spark, sf_dir)
    first = raw.where(F.col("datetime") < F.lit("2024-01-16").cast("timestamp_ntz"))
    second = raw.where(F.col("datetime") >= F.lit("2024-01-16").cast("timestamp_ntz")) \
        .select(*reversed(raw.columns))
    merged = union_slices([first, second])
    return merged.where(F.col("area_map_code") == "NATION_3")


def _utc_texts(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    t, et = F.col("ts"), F.col("event_type")
    text = (F.when(et == "click", F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
            .when(et == "view", F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                         F.lit("+00:00")))
            .when(et == "purchase", F.concat(F.lit(" "), F.date_format(t, "yyyy-MM-dd HH:mm"),
                                             F.lit("Z ")))
            .when(et == "signup", F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"),
                                           F.lit("+02:00")))
            .otherwise(F.when(F.col("event_id") % 2 == 0, F.date_format(t, "yyyy-MM-dd"))
                       .otherwise(F.lit(""))))
    return ev.select("event_id", text.alias("ts_text"))


def q_parse_utc_valid(spark, sf_dir):
    good, _ = quality.split_rejects(_utc_texts(spark, sf_dir), {"ts_text": True})
    return ntz(good.select("event_id", F.col("ts_text").alias("ts_utc")))


def q_parse_utc_rejects(spark, sf_dir):
    _, rejects = quality.split_rejects(_utc_texts(spark, sf_dir), {"ts_text": True})
    return rejects.select(F.get_json_object("row", "$.event_id").cast("bigint")
                          .alias("event_id"), "field", "reason")


def q_parse_utc_optional(spark, sf_dir):
    df = with_utc(_utc_texts(spark, sf_dir), "ts_text", required=False, on_error="null",
                  reason_col="reason")
    return ntz(df.select("event_id", F.col("ts_text").alias("ts_utc"), "reason"))


def q_format_utc(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", format_utc("ts").alias("ts_text"))


def q_check_unique(spark, sf_dir):
    return quality.check_unique(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_check_not_null(spark, sf_dir):
    stg = stg_prices(spark, sf_dir)
    return quality.check_not_null(stg, ["datetime", "area_map_code", "contract_type", "price",
                                        "update_time"])


def q_distinct_values(spark, sf_dir):
    return profile.distinct_values(fct_prices_df(spark, sf_dir), "contract_type")


def q_time_range(spark, sf_dir):
    return profile.min_max_range(fct_prices_df(spark, sf_dir), "datetime")


def q_profile_tables(spark, sf_dir):
    tables = {name: _t(spark, sf_dir, name)
              for name in ["customer", "events", "lineitem", "nation", "orders"]}
    return profile.profile_tables(tables, "testdata").drop("columns")


def q_quality_report(spark, sf_dir):
    models = {
        "dim_area": dim_area_df(spark, sf_dir),
        "stg_entsoe_imbalance_prices": staging.stg_imbalance_prices(raw_imbalance(spark, sf_dir)),
        "stg_entsoe_aggregated_generation": staging.stg_aggregated_generation(
            raw_generation(spark, sf_dir)),
        "stg_entsoe_generation_forecasts": staging.stg_generation_forecasts(
            raw_forecasts(spark, sf_dir)),
    }
    return quality.quality_report(models)


def _log_lines(spark, sf_dir) -> DataFrame:
    """Ingest log text derived from events: a started line per event, and a
    done line for the ones that finished; one run-start line."""
    ev = _t(spark, sf_dir, "events")
    f = F.concat(F.lit("2024_01_"), F.col("event_id").cast("string"), F.lit(".csv"))
    res = F.concat(F.lit("[entsoe:"), F.col("event_type"), F.lit("] "))
    started = ev.select(F.col("event_id"), F.lit(0).alias("seq"),
                        F.concat(res, F.lit("pobieram "), f).alias("value"))
    done = ev.where(F.col("event_type") != "error").select(
        F.col("event_id"), F.lit(1).alias("seq"),
        F.concat(res, F.lit("gotowe "), f, F.lit(" ("),
                 F.floor(F.col("value")).cast("bigint").cast("string"),
                 F.lit(" wierszy, 1.0 MB)")).alias("value"))
    return started.unionByName(done).withColumn(
        "line_id", F.col("event_id") * 2 + F.col("seq"))


def q_load_progress(spark, sf_dir):
    lines = _log_lines(spark, sf_dir)
    expected = audit.expected_frame(spark, {"click": 2000, "view": 2500, "purchase": 100,
                                            "signup": 0, "energy_prices": 21})
    return audit.load_progress(audit.parse_events(lines), expected)


QUERIES = {
    "parse_double_try": q_parse_double_try,
    "dedupe_latest_prices": q_dedupe_latest_prices,
    "fct_prices": q_fct_prices,
    "dim_area_distinct": q_dim_area_distinct,
    "fact_join_dim": q_fact_join_dim,
    "unpivot_measures": q_unpivot_measures,
    "unpivot_categories": q_unpivot_categories,
    "fct_generation_long": q_fct_generation_long,
    "fct_forecasts_long": q_fct_forecasts_long,
    "fct_pse_zmb": q_fct_pse_zmb,
    "fct_pse_cor": q_fct_pse_cor,
    "metric_prices_by_area": q_metric_prices_by_area,
    "metric_totals_long": q_metric_totals_long,
    "metric_imbalance_daily": q_metric_imbalance_daily,
    "price_series_filtered": q_price_series_filtered,
    "year_slice": q_year_slice,
    "year_counts": q_year_counts,
    "upsert_keyed": q_upsert_keyed,
    "replace_window_overlap": q_replace_window_overlap,
    "sync_signature": q_sync_signature,
    "sync_decision": q_sync_decision,
    "incremental_since": q_incremental_since,
    "watermark_advance": q_watermark_advance,
    "business_dates_slice": q_business_dates_slice,
    "manifest_folder": q_manifest_folder,
    "manifest_normalize": q_manifest_normalize,
    "manifest_select_years": q_manifest_select_years,
    "manifest_latest": q_manifest_latest,
    "manifest_limit": q_manifest_limit,
    "manifest_changed": q_manifest_changed,
    "json_rows": q_json_rows,
    "merge_monthly": q_merge_monthly,
    "parse_utc_valid": q_parse_utc_valid,
    "parse_utc_rejects": q_parse_utc_rejects,
    "parse_utc_optional": q_parse_utc_optional,
    "format_utc": q_format_utc,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "distinct_values": q_distinct_values,
    "time_range": q_time_range,
    "profile_tables": q_profile_tables,
    "load_progress": q_load_progress,
    "quality_report": q_quality_report,
}

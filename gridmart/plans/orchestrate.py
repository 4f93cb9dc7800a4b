"""End-to-end runs: ingest (G1) and models (G2) as ordered Spark jobs.

Layout under one root (shared storage on a cluster):

    landing/<instrument folder>/<file>.csv   landed ENTSO-E text
    landing/pse/<entity>/*.json              landed PSE pages
    manifest/                                the export log (tab-separated)
    raw/<resource>/load_id=<n>/              raw append tables
    state/files/                             (filename, updated) state
    state/layouts/                           the header line of each file read so far
    state/pse/<entity>/                      publication watermark
    state/pse_days/<entity>/                 first and last day of each page read so far
    marts/<mart>/part_date=<d>/              marts
    rollups/<mart>/<rollup>/                 aggregate states by day or month
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental, manifest, quality
from ..operators.incremental import by_time_days as incremental_days
from ..operators.upsert import upsert_table, write_partitions
from ..schemas import ENTITIES, INSTRUMENTS, PUBLISHED
from ..session import (delete_path, path_exists, read_parquet_or_none, read_version, scratch_path,
                       write_version)
from ..sources.pages import read_entity
from ..sources.tsv import scan_instrument
from . import marts as M
from . import staging as S
from .sync import sync_many
from .export import append_raw, loaded_ids, mirror_table, next_load_id
from .rollups import ROLLUPS, RollupStore


class UnknownInstrumentError(KeyError):
    pass


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def select_instruments(names: Sequence[str] | None = None) -> list[str]:
    """Default: all enabled; unknown names raise, listed sorted."""
    if names is None:
        return [k for k, v in INSTRUMENTS.items() if v.enabled]
    unknown = sorted(set(names) - set(INSTRUMENTS))
    if unknown:
        raise UnknownInstrumentError("unknown instruments: " + ", ".join(unknown))
    return list(names)


class UnlandedFilesError(RuntimeError):
    pass


def run_entsoe(spark: SparkSession, root: str, instruments: Sequence[str] | None = None,
               seed: bool = False, selected_files: Sequence[str] | None = None,
               latest_only: bool = False, years=None, force: bool = False,
               on_error: str = "fail", multi_line: bool | str = "auto") -> dict:
    """G1 for ENTSO-E: manifest diff -> scan chosen files -> append -> commit state.

    The driver only sees the list of chosen file paths.  State is committed
    for each instrument after its raw write succeeded (a crash in between
    reloads the files, which the latest-wins staging absorbs).  Wanted files
    that have not landed fail the run if they were named; else the report
    has their number under ``<instrument>:unlanded`` and they stay to be loaded.  ``on_error="fail"`` aborts on a
    bad instant (the source's behaviour); ``"reject"`` appends the good rows
    and writes the bad ones to ``rejects/<resource>`` under the same load id.
    """
    log = manifest.read_manifest(spark, _p(root, "manifest"))
    state_path, layouts = _p(root, "state", "files"), _p(root, "state", "layouts")
    state = read_version(spark, state_path)
    report = {}
    for key in select_instruments(instruments):
        inst = INSTRUMENTS[key]
        if selected_files is not None:
            chosen = manifest.select_named(log, selected_files, inst.folder, years=years)
        else:
            chosen = manifest.select_files(log, inst.folder, years)
            if latest_only:
                chosen = manifest.latest_per_folder(chosen)
        if seed:
            write_version(manifest.commit_state(state, chosen), state_path)
            state = read_version(spark, state_path)
            report[key] = "seeded"
            continue
        todo = manifest.changed_files(chosen, state, force)
        landed = manifest.list_landed(spark, _p(root, "landing", inst.folder))
        wanted = todo.join(landed.select("filename", "path"), "filename", "left")
        absent = [r[0] for r in wanted.where("path IS NULL").select("filename").distinct().orderBy("filename").collect()]
        if absent and selected_files is not None:
            raise UnlandedFilesError("not landed: " + ", ".join(absent))
        if absent:
            report[f"{key}:unlanded"] = len(absent)
        todo = wanted.where("path IS NOT NULL")
        found = todo.select("filename", "path").distinct().collect()
        paths = [r["path"] for r in found]
        if not paths:
            report[key] = 0
            continue
        raw_path = _p(root, "raw", inst.resource)
        load_id = next_load_id(spark, raw_path)
        if on_error == "reject":
            text = scan_instrument(spark, paths, inst, on_error="keep", multi_line=multi_line,
                                   index_path=layouts).drop("file_path")
            rows, rejects = quality.split_rejects(
                text, {"datetime": True, "update_time": False}, source="entsoe")
            append_raw(rejects, _p(root, "rejects", inst.resource), load_id)
        else:
            rows = scan_instrument(spark, paths, inst, multi_line=multi_line, index_path=layouts).drop("file_path")
        append_raw(rows, raw_path, load_id)
        write_version(manifest.commit_state(state, todo), state_path)
        state = read_version(spark, state_path)
        report[key] = len({r["filename"] for r in found})
    return report


def _new_pages(spark: SparkSession, landing: str, state: DataFrame | None):
    """(paths of page files not read yet, the state with them): M8 over names and modification times."""
    pages = manifest.list_landed(spark, landing).select(
        "filename", "path", F.col("modificationTime").cast("string").alias("updated"))
    todo = manifest.changed_files(pages, state)
    return [r["path"] for r in todo.select("path").collect()], manifest.commit_state(state, pages)


def _pages_of_days(spark: SparkSession, landing: str, ent, days: Sequence[str], state_path: str,
                   multi_line: bool) -> list[str]:
    """The landed pages that hold rows of the wanted days, from an index of every page's first and last day.

    Only pages that are new or changed (name, modification time) are read for the index; it is kept in ``state_path``.
    """
    pages = manifest.list_landed(spark, landing).select(
        F.col("path"), F.col("modificationTime").cast("string").alias("updated"))
    known = read_version(spark, state_path)
    todo = pages if known is None else pages.join(known, ["path", "updated"], "left_anti")
    fresh = [r["path"] for r in todo.select("path").collect()]
    if fresh:
        day = F.to_date("business_date")
        ranges = (read_entity(spark, fresh, ent, multi_line, with_path=True).groupBy("path")
                  .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))
        new = todo.select("path", "updated").join(ranges, "path", "left").select("path", "updated", "first_day", "last_day")
        kept = new if known is None else known.join(new, "path", "left_anti").select(*new.columns).unionByName(new)
        write_version(kept.coalesce(1), state_path)
        known = read_version(spark, state_path)
    if known is None:
        return []
    wanted = spark.createDataFrame([(d,) for d in sorted(set(days))], "day string").select(F.col("day").cast("date"))
    here = known.join(pages, ["path", "updated"], "left_semi")
    overlap = here.join(F.broadcast(wanted), (F.col("first_day") <= F.col("day")) & (F.col("last_day") >= F.col("day")), "left_semi")
    return [r["path"] for r in overlap.select("path").collect()]


def _load_entity(spark: SparkSession, root: str, key: str, ent, start: str | None, dates: Sequence[str] | None,
                 lookback_days: int, today, multi_line: bool) -> str:
    """One entity's new rows appended and its state committed; what was done."""
    landing, wm_path = _p(root, "landing", "pse", key), _p(root, "state", "pse", key)
    if not path_exists(spark, landing):
        return "skipped: no landed pages"
    current, raw_path = read_version(spark, wm_path), _p(root, "raw_pse", key)
    if dates is not None or ent.incremental == "business_date":
        # explicit days win; the heavy strategy takes the last few days
        days = dates if dates is not None else incremental.lookback_days(lookback_days, today)
        paths = _pages_of_days(spark, landing, ent, days, _p(root, "state", "pse_days", key), multi_line)
        if not paths:
            return "nothing of these days"
        rows = read_entity(spark, paths, ent, multi_line)
        append_raw(incremental.by_business_dates(rows, "business_date", days), raw_path, next_load_id(spark, raw_path))
        return "loaded"
    last = start or (current.first()["watermark"] if current is not None else None)
    pages_path = _p(root, "state", "pse_pages", key)
    if last is None:
        return "no baseline"
    paths, read = _new_pages(spark, landing, None if start else read_version(spark, pages_path))
    if not paths:
        return "nothing new"
    chosen = incremental.incremental_since(read_entity(spark, paths, ent, multi_line), "publication_ts_utc", last)
    load_id = next_load_id(spark, raw_path)
    append_raw(chosen, raw_path, load_id)
    # From the rows just appended, so that the pages are read once.
    loaded = read_parquet_or_none(spark, f"{raw_path}/load_id={load_id}")
    if loaded is None:
        loaded = spark.createDataFrame([], chosen.schema)
    new = incremental.advance_watermark(loaded, "publication_ts_utc", last)
    write_version(new if current is None else current.unionByName(new).agg(
        F.max("watermark").alias("watermark")), wm_path)
    write_version(read, pages_path)
    return "loaded"


def run_pse(spark: SparkSession, root: str, seed: bool = False, start: str | None = None,
            dates: Sequence[str] | None = None, entities: dict | None = None,
            lookback_days: int = 3, today=None, multi_line: bool = True, on_error: str = "fail") -> dict:
    """G1 for PSE: landed pages -> rows by dates or by publication watermark.

    Explicit ``dates`` win over increments; entities whose strategy is
    ``business_date`` take the last ``lookback_days`` days; both read the pages of those days only.
    The others take
    rows published after the watermark (an explicit ``start`` wins over the
    state; no start and no state loads nothing).  An increment reads only
    pages that landed since the last one.  An entity whose pages have not
    landed is skipped.  Bad data fails the run; with ``on_error="skip"`` the
    entity is left out, its state as before, so that its pages are read again by
    the next run, and the others go on.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error is fail or skip")
    report = {}
    for key, ent in (entities or ENTITIES).items():
        if seed:
            write_version(incremental.seed_watermark(spark), _p(root, "state", "pse", key))
            report[key] = "seeded"
            continue
        try:
            report[key] = _load_entity(spark, root, key, ent, start, dates, lookback_days, today, multi_line)
        except (PySparkException, Py4JJavaError) as error:  # what a Spark job fails with, not a fault of this code
            if on_error == "fail":
                raise
            report[key] = f"failed: {type(error).__name__}"
    return report


def run_ingest(spark: SparkSession, root: str, sources: Sequence[str] = ("entsoe", "pse"),
               date: str | None = None, from_date: str | None = None, backfill_days: int | None = None,
               instruments: Sequence[str] | None = None, seed: bool = False, today=None, now=None,
               pse_on_error: str = "fail", **entsoe) -> dict:
    """G1: both sources or one; ``pse_on_error``: see :func:`run_pse`.

    ``date`` wins over ``from_date`` (every day from there to today), either
    wins over increments, and ``backfill_days`` is turned into the start of
    an increment.  Other options go to :func:`run_entsoe`.
    """
    unknown = sorted(set(sources) - {"entsoe", "pse"})
    if unknown:
        raise ValueError("unknown sources: " + ", ".join(unknown))
    report = {}
    if "entsoe" in sources:
        report["entsoe"] = run_entsoe(spark, root, instruments, seed=seed, **entsoe)
    if "pse" in sources:
        dates = [date] if date else incremental.dates_from(from_date, today) if from_date else None
        report["pse"] = run_pse(spark, root, seed=seed, dates=dates,
                                start=incremental.backfill_start(backfill_days, now), today=today, on_error=pse_on_error)
    return report


def run_all(spark: SparkSession, root: str, replica_root: str, overlap_days: int = 2,
            checks: bool = True, by_digest: bool = False, **ingest) -> dict:
    """Ingest, models and replica refresh, one after the other.

    ``by_digest`` compares digest trees instead of the last ``overlap_days``.
    """
    report = {"ingest": run_ingest(spark, root, **ingest)}
    built = run_models(spark, root, checks=checks)
    marts = {name: spark.read.parquet(path) for name, path in built.items()}
    marts = {name: df.drop("part_date") for name, df in marts.items()}
    report["sync"] = sync_many(spark, marts, replica_root, list(marts), overlap_days,
                               local_paths=built if by_digest else None)
    return report


def _raw_sources(root: str):
    """(staging name, builder, raw path, time column, state key) per model."""
    for name, (src, fn) in S.STAGING.items():
        if src in ENTITIES:
            yield name, fn, _p(root, "raw_pse", ENTITIES[src].key), "dtime_utc", f"pse_{src}"
        else:
            yield name, fn, _p(root, "raw", INSTRUMENTS[src].resource), "datetime", src


def run_models(spark: SparkSession, root: str, checks: bool = True,
               incremental: bool = False, rollups: bool = False) -> dict:
    """Staging (views) then marts in dependency order, and with ``rollups`` the aggregate states of the marts.

    Marts with a unique key are merged partition-wise (U1); the others are
    rebuilt.  With ``checks`` the declared data tests run first (Q1, Q2).

    ``incremental=True`` gives the same marts without re-reading history:
    every grain includes its instant, so only days present in loads newer
    than the last run can change.  Those days are recomputed from *all* raw
    rows of the same days (range filters pushed into the scan) and only
    their mart partitions are rewritten -- merged by key for merge marts,
    replaced for table marts.  ``dim_area`` is the distinct areas of a small
    table that holds each day's areas; the touched days are replaced there,
    so an area that was renamed goes as in a full run.  The processed load id
    per raw table is committed after the marts.  Each staging relation is
    computed once, into the scratch folder.
    """
    stg, commits, scratch = {}, {}, []
    for name, fn, path, tcol, key in _raw_sources(root):
        raw = read_parquet_or_none(spark, path)
        if raw is None:
            continue
        if incremental:
            state_path = _p(root, "state", "models", key)
            state = read_version(spark, state_path)
            last = state.first()["load_id"] if state is not None else 0
            ids = loaded_ids(spark, path)
            if not ids or ids[-1] <= last:
                continue
            days = [r[0] for r in raw.where(F.col("load_id") > last)
                    .select(F.to_date(tcol)).distinct().collect()]
            raw = incremental_days(raw, tcol, days)
            commits[state_path] = ids[-1]
        view = fn(raw)
        view.createOrReplaceTempView(name)
        scratch.append(scratch_path(spark, name))
        view.write.parquet(scratch[-1])
        stg[name] = spark.read.parquet(scratch[-1])
    if checks:
        run_checks(stg)
    built = {}
    for mart, (src, fn, keys) in M.MARTS.items():
        if src not in stg:
            continue
        df = fn(stg[src])
        path = _p(root, "marts", mart)
        tcol = PUBLISHED[mart].time_column
        if keys is not None:
            upsert_table(spark, path, M.with_partition_date(df, tcol), keys, "part_date")
        elif tcol is None:
            mirror_table(M.distinct_rows(_areas_by_day(spark, root, stg[src], incremental), M.DIM_AREA_COLUMNS), path)
        elif incremental and read_parquet_or_none(spark, path) is not None:
            write_partitions(M.with_partition_date(df, tcol), path, "part_date")
        else:
            mirror_table(M.with_partition_date(df, tcol), path, ["part_date"])
        built[mart] = path
    if checks and "dim_area" in built:
        quality.assert_checks(quality.check_unique(spark.read.parquet(built["dim_area"]), ["area_map_code"]))
    for mart, path in built.items() if rollups else ():
        if mart in ROLLUPS:
            RollupStore(spark, _p(root, "rollups"), mart).refresh(path)
    for state_path, load_id in commits.items():
        write_version(spark.range(1).select(F.lit(load_id).cast("bigint").alias("load_id")),
                      state_path)
    for path in scratch:
        delete_path(spark, path)
    return built


def _areas_by_day(spark: SparkSession, root: str, prices: DataFrame, incremental: bool) -> DataFrame:
    """The areas of each day, with the days of ``prices`` replaced (all days in a full run)."""
    path = _p(root, "state", "area_days")
    days = M.with_partition_date(prices, "datetime").select("part_date", *M.DIM_AREA_COLUMNS).distinct()
    write_partitions(days, path, "part_date", "dynamic" if incremental else "static")
    return spark.read.parquet(path)


def run_checks(stg: dict) -> None:
    """Declared tests: not-null on staging grains (Q2)."""
    required = {
        "stg_entsoe_generation_forecasts": ["datetime", "area_code", "production_type"],
        "stg_entsoe_imbalance_prices": ["datetime", "area_map_code"],
        "stg_entsoe_aggregated_generation": ["datetime", "area_code", "production_type"],
    }
    found = [quality.check_not_null(stg[n], cols) for n, cols in required.items() if n in stg]
    quality.assert_checks(*found)

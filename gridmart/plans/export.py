"""Sinks: raw append, materialise, mirror, yearly CSV, merged monthly text (K1-K5)."""

from __future__ import annotations

import re
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_parquet_or_none, staged_copy, staged_copy_if_reads
from ..operators.upsert import write_partitions
from ..sources.layouts import cells, file_layouts, header_layouts
from ..sources.tsv import scan_tsv
from ..schemas import DATETIME_HEADER

# Wall-clock (NTZ) instants carry no offset; fractions are kept.
CSV_TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class UnknownTableError(KeyError):
    pass


def append_raw(df: DataFrame, path: str, load_id: int, load_col: str = "load_id") -> None:
    """K1: append rows tagged with a monotone load id; never update.

    Each load is its own ``load_id=<n>`` partition written with dynamic
    overwrite: a retried load replaces itself instead of appending twice,
    and later runs select new loads by partition pruning.
    """
    (df.withColumn(load_col, F.lit(int(load_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(load_col).parquet(path))


def loaded_ids(spark: SparkSession, path: str, load_col: str = "load_id") -> list[int]:
    """Load ids present in a raw table, from its file listing (no Spark job)."""
    table = read_parquet_or_none(spark, path)
    if table is None:
        return []
    pattern = re.compile(rf"/{re.escape(load_col)}=(\d+)/")
    ids = {int(m.group(1)) for f in table.inputFiles() if (m := pattern.search(f))}
    return sorted(ids)


def next_load_id(spark: SparkSession, path: str, load_col: str = "load_id") -> int:
    """Next load id = highest load partition + 1."""
    ids = loaded_ids(spark, path, load_col)
    return ids[-1] + 1 if ids else 1


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """K2: staging as a temporary view, marts as a full-refresh table."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is None:
        w.saveAsTable(name)
        return df.sparkSession.table(name)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def mirror_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K3: full copy replacing the target (staged first only when ``df``
    also reads the target, so it is never deleted under a running job)."""
    with staged_copy_if_reads(df, path, "mirror") as staged:
        if len(partition_by) == 1:
            write_partitions(staged, path, partition_by[0], "static")
        else:
            (staged.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(*partition_by).parquet(path))


def csv_instants(df: DataFrame) -> DataFrame:
    """UTC instants as the source database's COPY writes them: fraction only if there is one, then +00."""
    def text(c: str):
        fraction = F.regexp_replace(F.date_format(c, ".SSSSSS"), r"\.?0+$", "")
        return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), fraction, F.lit("+00")).alias(c)
    return df.select(*[text(c) if kind == "timestamp" else F.col(c) for c, kind in df.dtypes])


def rows_for_year(df: DataFrame, ts_col: str, year: int, ordered: bool = True) -> DataFrame:
    """Half-open year range on the instant column, ordered by it."""
    kind = dict(df.dtypes)[ts_col]
    lo = F.lit(f"{int(year)}-01-01 00:00:00").cast(kind)
    hi = F.lit(f"{int(year) + 1}-01-01 00:00:00").cast(kind)
    out = df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))
    return out.orderBy(F.col(ts_col).asc_nulls_last()) if ordered else out


def counts_by_year(df: DataFrame, ts_col: str, years) -> DataFrame:
    """A1 per year in one pass: rows in [year-01-01, year+1-01-01) for each
    requested year (0 for years without rows)."""
    spark = df.sparkSession
    ys = sorted({int(y) for y in years})
    kind = dict(df.dtypes)[ts_col]
    lo = F.lit(f"{ys[0]}-01-01 00:00:00").cast(kind)
    hi = F.lit(f"{ys[-1] + 1}-01-01 00:00:00").cast(kind)
    counted = (df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))
               .groupBy(F.year(ts_col).alias("year"))
               .agg(F.count(F.lit(1)).alias("row_count")))
    wanted = spark.createDataFrame([(y,) for y in ys], "year int")
    return (F.broadcast(wanted).join(counted, "year", "left")
            .select("year", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count")))


def export_csv_by_year(tables: Mapping[str, DataFrame | None], years: Sequence, out_dir: str,
                       ts_col: str = "datetime", known: Sequence[str] | None = None,
                       one_file: bool = False) -> DataFrame:
    """K4: per table and year, rows of the year ordered by time, as CSV.

    Output folder ``<out>/<table>_<year>.csv/``.  Row counts of all years
    come from one aggregation first; then each year is written with a range
    partitioning on the time column plus a sort within partitions, so part
    files are sorted and in order by name without a single-task sort.
    ``one_file`` asks for one file a year instead, sorted by one task: for
    tables known to be small.  Unknown tables are rejected; a table given as None
    (missing) is skipped with a notice.  Returns (table, year, rows).
    """
    if known is not None:
        unknown = sorted(set(tables) - set(known))
        if unknown:
            raise UnknownTableError("unknown tables: " + ", ".join(unknown))
    counts = []
    spark = None
    for name, df in tables.items():
        if df is None:
            print(f"[SKIP] {name} does not exist", file=sys.stderr)
            continue
        spark = df.sparkSession
        per_year = {r["year"]: r["row_count"] for r in
                    counts_by_year(df, ts_col, years).collect()}
        for year in years:
            n = int(per_year.get(int(year), 0))
            rows = rows_for_year(df, ts_col, int(year), ordered=False)
            path = f"{out_dir.rstrip('/')}/{name}_{year}.csv"
            order = F.col(ts_col).asc_nulls_last()
            if one_file:
                out = rows.repartition(1).sortWithinPartitions(order)
            else:
                # A row hash after the time splits a hot instant (many rows at
                # one time) over several ranges; the time order is unchanged.
                spread = F.xxhash64(*[F.col(c) for c in rows.columns]).alias("__h")
                out = (rows.withColumn("__h", spread)
                       .repartitionByRange(order, F.col("__h"))
                       .sortWithinPartitions(order, F.col("__h")).drop("__h"))
            (csv_instants(out).write.mode("overwrite").option("header", True).option("sep", ",")
             .option("timestampNTZFormat", CSV_TIMESTAMP_NTZ_FORMAT).csv(path))
            counts.append((name, int(year), n))
            print(f"[OK] {name}_{year}.csv: {n} rows", file=sys.stderr)
    if spark is None:
        return None
    return spark.createDataFrame(counts, "table_name string, year int, row_count long")


def union_slices(dfs: Sequence[DataFrame]) -> DataFrame:
    """U8: UNION ALL by column name (missing columns become NULL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def merged_headers(spark: SparkSession, paths, header_first: str = DATETIME_HEADER) -> list[str]:
    """Union of the (trimmed) header names of some files, in the order of their distinct header lines."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = header_layouts(file_layouts(spark, paths), header_first)
    names = [name for line in lines for name in cells(line) if name]
    return list(dict.fromkeys(names))


def merge_monthly_tsv(spark: SparkSession, paths, out_path: str, area: str | None = None,
                      header_first: str = DATETIME_HEADER) -> int:
    """K5: concatenate monthly files by column *name* under one header,
    optionally keeping only ``AreaMapCode == area``; returns the row count.

    Output is one tab-separated folder with a header row.
    """
    names = merged_headers(spark, paths, header_first)
    df = scan_tsv(spark, paths, names, header_first=header_first).drop("file_path")
    if area is not None:
        df = df.where(F.col("`AreaMapCode`") == area)
    with staged_copy(df, "merge-monthly") as merged:
        n = merged.count()
        (merged.write.mode("overwrite").option("sep", "\t").option("header", True)
         .option("quote", '"').option("escape", '"').csv(out_path))
    return n


def merge_by_year(spark: SparkSession, landed_dir: str, instrument: str, years: Sequence,
                  out_dir: str, area: str | None = None, limit: int | None = None,
                  header_first: str = DATETIME_HEADER) -> dict:
    """K5 per instrument and year: landed monthly files of each year (first
    ``limit`` by name, M12) merged into ``<instrument>_<year>[_<area>].csv``.

    Years come from the first four characters of the file names; the file
    list is metadata (no content read).  Returns {year: rows}.
    """
    from ..operators.manifest import list_landed
    files = (list_landed(spark, landed_dir, years)
             .select("filename", "path").orderBy("filename").collect())
    by_year: dict[str, dict[str, list[str]]] = {}
    for r in files:
        by_year.setdefault(r["filename"][:4], {}).setdefault(r["filename"], []).append(r["path"])
    out = {}
    for year in sorted(by_year):
        names = sorted(by_year[year])[:limit] if limit else sorted(by_year[year])
        paths = [path for name in names for path in by_year[year][name]]
        suffix = f"_{area}" if area else ""
        target = f"{out_dir.rstrip('/')}/{instrument}_{year}{suffix}.csv"
        out[year] = merge_monthly_tsv(spark, paths, target, area, header_first)
    return out

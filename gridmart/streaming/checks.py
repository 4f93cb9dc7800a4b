"""Streaming paths run on data Spark derives from the driver's tables.

``stream_ingest``: the raw-price rows are landed by Spark as tab-separated
files with the source's headers, then ingested by the Z1 file stream;
the raw table read back must equal the landed rows.
``stream_upsert_latest``: the raw rows are landed as Parquet files and fed
through Z2 in several micro-batches; the table must equal the batch
latest-wins staging relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import try_double
from ..plans import oracle, testbed
from ..plans.staging import STG_COLUMNS
from ..schemas import INSTRUMENTS
from ..session import scratch_path
from ..sources.tsv import instrument_headers
from .ingest import stream_ingest_files
from .latest_state import compact, read_latest, stream_latest
from .manifest_state import stream_ingest_manifest
from .upsert_stream import stream_upsert_latest


def land_prices_tsv(raw: DataFrame, landing: str, files: int = 6) -> None:
    """Write raw-price rows as header-named tab-separated files."""
    names = {t: h for h, t in instrument_headers("energy_prices").items()}
    cols = []
    for c in ["datetime", "resolution_code", "area_code", "area_name", "area_type_code",
              "area_map_code", "contract_type", "price", "currency", "update_time"]:
        if c == "datetime":
            v = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif c == "update_time":
            v = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        else:
            v = F.col(c)
        cols.append(v.alias(names[c]))
    (raw.select(*cols).repartition(files, F.col("`DateTime(UTC)`"))
     .write.mode("overwrite").option("sep", "\t").option("header", True)
     .option("quote", '"').option("escape", '"').csv(landing))


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testbed.raw_prices(spark, sf_dir)
    landing = scratch_path(spark, "landing-tsv")
    land_prices_tsv(raw, landing)
    raw_path = scratch_path(spark, "raw-energy-prices")
    stream_ingest_files(spark, landing, raw_path, scratch_path(spark, "ckpt-ingest"),
                        "energy_prices", max_files_per_trigger=3)
    return testbed.ntz(spark.read.parquet(raw_path).drop("load_id"))


def q_stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testbed.raw_prices(spark, sf_dir)
    landing = scratch_path(spark, "landing-parquet")
    raw.repartition(4, "datetime").write.mode("overwrite").parquet(landing)
    source = (spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 2)
              .parquet(landing))
    target = scratch_path(spark, "stg-energy-prices")
    stream_upsert_latest(spark, source, target, scratch_path(spark, "ckpt-upsert"),
                         INSTRUMENTS["energy_prices"].grain, "datetime",
                         tiebreak=("update_time",))
    table = spark.read.parquet(target)
    return table.select(*[try_double(c).alias(c) if c == "price" else F.col(c)
                          for c in STG_COLUMNS["energy_prices"]])


def q_stream_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three day slices are landed and logged; then one is published again with other names, a fourth one is new,
    a fifth is logged before it lands.  The raw rows with their loads: what is read again, and what is not."""
    raw = testbed.raw_prices(spark, sf_dir)
    root, folder = scratch_path(spark, "republished"), INSTRUMENTS["energy_prices"].folder
    landing, day = f"{root}/landing/{folder}", F.dayofmonth("datetime")
    slices = [(f"2024_01_{at:02d}_{folder}.csv", (day >= at) & (day < at + 7)) for at in (1, 8, 15, 22, 29)]

    def land(number: int, rows: DataFrame) -> None:
        land_prices_tsv(rows.where(slices[number][1]), f"{landing}/{slices[number][0]}", 2)

    def log(texts: dict[int, str]) -> None:
        rows = [("2024", text, slices[number][0]) for number, text in texts.items()]
        (spark.createDataFrame(rows, "`year` string, `max_update_time(UTC)` string, `file_name` string").coalesce(1)
         .write.mode("append").option("sep", "\t").option("header", True).csv(f"{root}/manifest"))
        stream_ingest_manifest(spark, f"{root}/manifest", landing, f"{root}/raw", f"{root}/checkpoint", "energy_prices",
                               index_path=f"{root}/layouts")

    for number in (0, 1, 2):
        land(number, raw)
    log({0: "2024-02-01 00:00:00", 1: "2024-02-01 00:00:00", 2: "2024-02-01 00:00:00"})
    land(1, raw.withColumn("area_name", F.upper("area_name")))
    land(3, raw)
    log({0: "2024-02-01 00:00:00", 1: "2024-01-31 00:00:00", 3: "2024-02-02 00:00:00", 4: "2024-02-02 00:00:00"})
    land(4, raw)
    log({2: "2024-02-01 00:00:00", 4: "2024-02-02 00:00:00"})
    return testbed.ntz(spark.read.parquet(f"{root}/raw")).withColumn("load_id", F.col("load_id").cast("bigint"))


def q_stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the stateful stream and a compaction between them: days in order, then days long past the
    watermark, and rows that come twice.  The table must be the batch staging relation over all rows."""
    raw = testbed.raw_prices(spark, sf_dir)
    root, grain = scratch_path(spark, "latest-state"), INSTRUMENTS["energy_prices"].grain
    late, day = F.col("load_id") % 7 == 0, F.dayofmonth("datetime")

    def land(rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{root}/landing")

    def run():
        source = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
        return stream_latest(spark, source, f"{root}/table", f"{root}/checkpoint", grain, "datetime", tiebreak=("update_time",))

    land(raw.where(~late & (day <= 15)))
    land(raw.where(~late & (day > 15)))
    run()
    compact(spark, f"{root}/table", grain, "datetime", tiebreak=("update_time",))
    land(raw.where(late))
    land(raw.where(F.col("load_id") % 5 == 0))
    query = run()
    newest = raw.agg(F.max("datetime")).first()[0]
    recent = raw.where(F.col("datetime") >= F.lit(newest) - F.make_dt_interval(F.lit(2))).select(*grain).distinct().count()
    held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    if held > recent:
        raise RuntimeError(f"the state holds {held} grains, of the last days there are {recent}")
    table = read_latest(spark, f"{root}/table", grain, "datetime", tiebreak=("update_time",))
    return table.select(*[try_double(c).alias(c) if c == "price" else F.col(c) for c in STG_COLUMNS["energy_prices"]])


QUERIES = {
    "stream_republished": q_stream_republished,
    "stream_latest_state": q_stream_latest_state,
    "stream_ingest": q_stream_ingest,
    "stream_upsert_latest": q_stream_upsert_latest,
}

SQL = {
    "stream_ingest": "WITH " + oracle.RAW_PRICES + """
SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
       contract_type, trim(price) AS price, currency, update_time
FROM raw_prices""",
    "stream_upsert_latest": "WITH " + oracle.STG_PRICES + "\nSELECT * FROM stg_prices",
    "stream_latest_state": "WITH " + oracle.STG_PRICES + "\nSELECT * FROM stg_prices",
    # load 0: the first three slices; 1: the second again (its entry differs, if to an older time), and the fourth;
    # 2: the fifth, which had not landed before
    "stream_republished": "WITH " + oracle.RAW_PRICES + """,
loads AS (
  SELECT *, CAST(0 AS BIGINT) AS load FROM raw_prices WHERE day(datetime) < 22
  UNION ALL
  SELECT * REPLACE (upper(area_name) AS area_name), 1 FROM raw_prices WHERE day(datetime) BETWEEN 8 AND 14
  UNION ALL
  SELECT *, 1 FROM raw_prices WHERE day(datetime) BETWEEN 22 AND 28
  UNION ALL
  SELECT *, 2 FROM raw_prices WHERE day(datetime) >= 29)
SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
       contract_type, trim(price) AS price, currency, update_time, load AS load_id
FROM loads""",
}

"""JSON pages ``{"value": [row, ...], "nextLink": ...}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutc import with_utc
from ..schemas import ENTITIES, Entity, entity_row_schema, page_schema


def read_pages(spark: SparkSession, path: str | list[str], row_schema: T.StructType,
               multi_line: bool = True, with_path: bool = False) -> DataFrame:
    """Union of every page's ``value`` array; a page without it gives no rows.

    Parsed by Spark's JSON reader with an explicit schema (no inference) and
    exploded in the same stage.  ``multi_line=True``: one (pretty-printed)
    page per file; ``False``: JSON Lines, one page per line, splittable.
    A page that is cut off, or holds a value of another type, fails the job.
    ``with_path`` adds each row's file as ``path``.
    """
    pages = (spark.read.schema(page_schema(row_schema)).option("multiLine", multi_line)
             .option("mode", "FAILFAST")
             .json(path))
    path_of = [F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path")] if with_path else []
    return pages.select(*path_of, F.explode("value").alias("r")).select(*(["path"] if with_path else []), "r.*")


def parse_pages(df: DataFrame, text_col: str, row_schema: T.StructType,
                keep: tuple = ()) -> DataFrame:
    """S7 on page text held in a column (e.g. a landed-text table)."""
    parsed = df.select(*keep, F.from_json(F.col(text_col), page_schema(row_schema),
                                            {"mode": "FAILFAST"}).alias("p"))
    return parsed.select(*keep, F.explode("p.value").alias("r")).select(*keep, "r.*")


def normalize_entity(rows: DataFrame, entity: str | Entity, on_error: str = "fail") -> DataFrame:
    """Every declared timestamp column strictly UTC (all required)."""
    ent = ENTITIES[entity] if isinstance(entity, str) else entity
    out = rows
    for c in ent.timestamp_columns:
        out = with_utc(out, c, required=True, on_error="null" if on_error == "null" else "fail",
                       source=f"pse/{ent.endpoint}")
    return out


def read_entity(spark: SparkSession, path: str | list[str], entity: str | Entity,
                multi_line: bool = True, with_path: bool = False) -> DataFrame:
    ent = ENTITIES[entity] if isinstance(entity, str) else entity
    return normalize_entity(read_pages(spark, path, entity_row_schema(ent), multi_line, with_path), ent)


"""Tab-separated text with a header, columns matched by name.

``spark.read.csv`` with ``header=True`` takes one file's header and maps all
other files by position, so a file with reordered columns would be silently
scrambled.  Here the index of :mod:`.layouts` says which header line each file has;
the distinct header lines (*layouts*) alone come to the driver.
They give the width of the positional read, whatever it is, and the position
of each wanted name, so one CSV parse reads just the cells that are wanted.
With one layout no join is needed; with several each row finds its file's
layout by a join on the file.
Quotes with doubled-quote escapes and quoted newlines are honoured, in files of any
size: those larger than a split are cut into byte ranges (:mod:`.records`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import text_or_empty
from ..functions.timeutc import with_utc
from ..schemas import (COMMON_HEADERS, DATETIME_HEADER, INSTRUMENTS, UPDATE_TIME_HEADER,
                       Instrument)
from .layouts import cells, file_layouts, header_layouts
from .records import quoted_records, record_cells

#: How quoted newlines are honoured: by one task a file, not at all, by byte ranges, or by
#: ranges only if a file is larger than ``spark.sql.files.maxPartitionBytes``.
MULTI_LINE = (True, False, "ranges", "auto")


def _split_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes`` as a number."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def _positional_rows(spark: SparkSession, paths: list[str], width: int, by_ranges: bool, multi_line: bool) -> DataFrame:
    """Cells ``_c0``, ``_c1``, ... of every row, header lines too, with the number of the row's file."""
    columns = [f"_c{i}" for i in range(width)]
    if by_ranges:
        records = quoted_records(spark, paths).where("rtrim('\r', record) <> ''")
        cell = record_cells(F.ltrim(F.col("record"), F.lit("\ufeff")), width)
        return records.select(cell.alias("cells"), "file").select("cells.*", "file")
    raw = (spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
           .option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"')
           .option("multiLine", multi_line).option("mode", "PERMISSIVE").csv(paths))
    return raw.select(*columns, F.xxhash64(F.col("_metadata.file_path")).alias("file"),
                      F.col("_metadata.file_path").alias("file_path"))


def scan_tsv(spark: SparkSession, paths: str | Sequence[str], wanted: Sequence[str],
             header_first: str = DATETIME_HEADER, check_headers: bool = True,
             multi_line: bool | str = "auto", index_path: str | None = None) -> DataFrame:
    """Rows of all files as text columns named by their (trimmed) header.

    Missing columns and short rows give ''; fields beyond the header are
    ignored; every value is stripped.  Adds ``file_path``.  ``multi_line``: see
    ``MULTI_LINE``; ``False`` is for files known to have no quoted newline.
    With ``index_path`` the files' layouts are kept there, so files that were
    scanned before are not opened to find theirs.
    """
    if multi_line not in MULTI_LINE:
        raise ValueError(f"multi_line is one of {MULTI_LINE}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    index = file_layouts(spark, paths, index_path)
    layouts = header_layouts(index, header_first, check_headers)
    names = [cells(h) for h in layouts]
    width = max((len(n) for n in names), default=0) + 1
    by_ranges = multi_line == "ranges" or (
        multi_line == "auto" and not index.where(F.col("length") > _split_bytes(spark)).isEmpty())
    rows = _positional_rows(spark, paths, width, by_ranges, bool(multi_line))
    if len(layouts) > 1 or by_ranges:
        number = F.create_map(*[F.lit(x) for k, h in enumerate(layouts) for x in (h, k)]) if layouts else None
        of_file = index.select(F.xxhash64("file_path").alias("file"), "file_path",
                               (number[F.col("header")] if layouts else F.lit(0)).alias("__layout"))
        rows = rows.drop("file_path").join(of_file, "file")

    def by_layout(cell_of) -> Column:
        """One expression over the layouts; ``cell_of`` gives it for one of them."""
        if not names:
            return F.lit("")
        out = cell_of(names[0])
        for k, own in enumerate(names[1:], 1):
            out = F.when(F.col("__layout") == k, cell_of(own)).otherwise(out)
        return out

    def cell(own: list[str], name: str) -> Column:
        return text_or_empty(f"_c{own.index(name)}") if name in own else F.lit("")

    rows = rows.where(by_layout(lambda own: cell(own, header_first)) != header_first)
    return rows.select(*[by_layout(lambda own, name=name: cell(own, name)).alias(name) for name in wanted], "file_path")


def instrument_headers(instrument: str | Instrument) -> dict:
    """Header name -> raw column name of one instrument (plus update time)."""
    inst = INSTRUMENTS[instrument] if isinstance(instrument, str) else instrument
    mapping = dict(COMMON_HEADERS)
    mapping.update(inst.headers)
    mapping[UPDATE_TIME_HEADER] = "update_time"
    return mapping


def type_instrument(text: DataFrame, instrument: str | Instrument,
                    on_error: str = "fail") -> DataFrame:
    """Header-named text -> raw instrument schema with strict UTC instants."""
    mapping = instrument_headers(instrument)
    cols = [F.col(f"`{h}`").alias(t) for h, t in mapping.items()
            if t not in ("datetime", "update_time")]
    if on_error == "keep":
        return text.select(F.col(f"`{DATETIME_HEADER}`").alias("datetime"), *cols,
                           F.col(f"`{UPDATE_TIME_HEADER}`").alias("update_time"),
                           "file_path")
    typed = text.select(F.col(f"`{DATETIME_HEADER}`").alias("datetime"), *cols,
                        F.col(f"`{UPDATE_TIME_HEADER}`").alias("update_time"), "file_path")
    typed = with_utc(typed, "datetime", required=True, field=DATETIME_HEADER, source="entsoe")
    return with_utc(typed, "update_time", required=False, field=UPDATE_TIME_HEADER,
                    source="entsoe")


def scan_instrument(spark: SparkSession, paths: str | Sequence[str],
                    instrument: str | Instrument, on_error: str = "fail",
                    multi_line: bool | str = "auto", index_path: str | None = None) -> DataFrame:
    """One instrument's files as its raw table schema.

    ``datetime`` is required, ``update_time`` optional (blank -> NULL); both
    strictly UTC.  With ``on_error="fail"`` a bad instant aborts the job; with
    ``"keep"`` both stay text for :func:`gridmart.operators.quality.split_rejects`.
    """
    text = scan_tsv(spark, paths, list(instrument_headers(instrument)), multi_line=multi_line, index_path=index_path)
    return type_instrument(text, instrument, on_error)


def scan_energy_prices(spark, paths, **kw):
    return scan_instrument(spark, paths, "energy_prices", **kw)


def scan_imbalance_prices(spark, paths, **kw):
    return scan_instrument(spark, paths, "imbalance_prices", **kw)


def scan_generation_forecasts(spark, paths, **kw):
    return scan_instrument(spark, paths, "generation_forecasts", **kw)


def scan_aggregated_generation(spark, paths, **kw):
    return scan_instrument(spark, paths, "aggregated_generation", **kw)


def write_tsv(df: DataFrame, path: str, header_names: Mapping[str, str] | None = None,
              partition_by: Sequence[str] = ()) -> None:
    """Write text columns as tab-separated files with a header (K5 output)."""
    out = df
    if header_names:
        out = out.select(*[F.col(c).alias(h) for c, h in header_names.items()],
                         *partition_by)
    w = (out.write.mode("overwrite").option("sep", "\t").option("header", True)
         .option("quote", '"').option("escape", '"'))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)

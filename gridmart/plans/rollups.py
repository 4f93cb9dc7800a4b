"""Stored aggregate states by day and month, and metric queries answered from them.

A state holds, for each group and measure, what the declared metrics can be merged from:
sum, count, least and greatest value.  The finest rollup of a mart is computed from the mart day
by day; every other one is merged from it.  When the mart changes, only the days
whose files have changed are read again, and only their days and months are replaced.

``answer`` takes a metric query and picks the coarsest rollup that fits: one that has all the
dimensions and filters, with a grain that the asked grain and time range are
made of.  The fact table is not in such a plan at all.  A query that no rollup fits
goes to the fact table, if it is given.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_dim
from ..operators.metrics import MODELS, Metric, metric_query
from ..operators.upsert import write_partitions
from ..session import delete_path, read_parquet_or_none, read_version, write_version
from .digests import PART, day_listing, day_text

MONTH = "part_month"
#: Grains of a query that each stored grain can be merged to.
_MADE_OF = {"day": {"day", "week", "month", "quarter", "year"}, "month": {"month", "quarter", "year"}}


@dataclass(frozen=True)
class Rollup:
    """Groups by ``dims`` and by ``grain`` (``day`` or ``month``) of the mart's partition date."""

    name: str
    dims: tuple
    grain: str = "day"


#: For each mart its finest rollup, by day and all dimensions, and coarser ones merged from it.
ROLLUPS = {
    "fct_energy_prices": (
        Rollup("day_all", ("area_map_code", "resolution_code", "contract_type", "currency")),
        Rollup("month_area", ("area_map_code", "resolution_code"), "month"),
        Rollup("month_total", ("resolution_code",), "month")),
    "fct_entsoe_imbalance_prices": (
        Rollup("day_all", ("area_map_code", "resolution_code", "currency", "status", "direction", "price_category", "price_metric")),
        Rollup("month_area_metric", ("area_map_code", "resolution_code", "currency", "price_metric"), "month")),
    "fct_entsoe_generation_forecasts": (
        Rollup("day_all", ("area_code", "area_map_code", "resolution_code", "production_type", "forecast_category", "forecast_metric")),
        Rollup("month_area_type", ("area_code", "resolution_code", "production_type", "forecast_metric"), "month")),
    "fct_entsoe_aggregated_generation": (
        Rollup("day_all", ("area_code", "area_map_code", "resolution_code", "production_type", "measure_category", "measure_metric")),
        Rollup("month_area_type", ("area_code", "resolution_code", "production_type", "measure_metric"), "month")),
    "fct_pse_zmb": (Rollup("day_all", ("business_date", "product")), Rollup("month_product", ("product",), "month")),
    "fct_pse_cor": (Rollup("day_all", ("business_date",)), Rollup("month_total", (), "month")),
}


class NoRollupError(LookupError):
    pass


def _measures(model: str) -> list[str]:
    return list(dict.fromkeys(m.column for m in MODELS[model].metrics))


def _first_states(model: str) -> list[Column]:
    """States of a group of fact rows."""
    out = [F.count(F.lit(1)).alias("row_count")]
    for m in _measures(model):
        out += [F.sum(m).alias(f"{m}__sum"), F.count(m).alias(f"{m}__count"), F.min(m).alias(f"{m}__min"), F.max(m).alias(f"{m}__max")]
    return out


def _merged_states(model: str) -> list[Column]:
    """States of a group of states."""
    def counted(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).alias(c)

    out = [counted("row_count")]
    for m in _measures(model):
        out += [F.sum(f"{m}__sum").alias(f"{m}__sum"), counted(f"{m}__count"),
                F.min(f"{m}__min").alias(f"{m}__min"), F.max(f"{m}__max").alias(f"{m}__max")]
    return out


def _metric(metric: Metric, round_to: int | None) -> Column:
    """A declared metric out of a group's merged states."""
    def state(kind: str) -> Column:
        return F.col(f"{metric.column}__{kind}")

    value = {"average": F.try_divide(state("sum"), state("count")), "sum": state("sum"), "count": state("count"),
             "min": state("min"), "max": state("max")}[metric.kind]
    if round_to is not None and metric.kind in ("average", "sum"):
        value = F.round(value, round_to)
    return value.alias(metric.name)


class RollupStore:
    """The rollups of one mart under ``root``."""

    def __init__(self, spark: SparkSession, root: str, model: str, rollups: Sequence[Rollup] | None = None):
        self.spark, self.model = spark, model
        self.root = f"{root.rstrip('/')}/{model}"
        self.rollups = tuple(rollups or ROLLUPS[model])
        self.finest = self.rollups[0]
        if self.finest.grain != "day" or any(not set(r.dims) <= set(self.finest.dims) for r in self.rollups):
            raise ValueError("the first rollup is by day and has all dimensions of the others")

    def path(self, rollup: Rollup) -> str:
        return f"{self.root}/{rollup.name}"

    def refresh(self, fact_path: str) -> list[str]:
        """Replace the states of the days whose files have changed; gives those days."""
        fact, state_path = read_parquet_or_none(self.spark, fact_path), f"{self.root}/_files"
        none = self.spark.createDataFrame([], "node string, files string")
        files = none if fact is None else day_listing(self.spark, fact, fact_path, PART)
        known = read_version(self.spark, state_path)
        known = none if known is None else known
        todo = [r["node"] for r in files.join(known, ["node", "files"], "left_anti").collect()]  # of the calendar
        gone = [r["node"] for r in known.join(files, "node", "left_anti").collect()]
        if todo:
            days = fact.where(day_text(PART).isin(todo))
            write_partitions(days.groupBy(PART, *self.finest.dims).agg(*_first_states(self.model)), self.path(self.finest), PART)
        for day in gone:
            delete_path(self.spark, f"{self.path(self.finest)}/{PART}={day}")
        months = sorted({d[:7] for d in (*todo, *gone)})
        for rollup in self.rollups[1:]:
            self._replace(rollup, todo, gone, months)
        if todo or gone:
            write_version(files.coalesce(1), state_path)
        return sorted([*todo, *gone])

    def _replace(self, rollup: Rollup, todo: list[str], gone: list[str], months: list[str]) -> None:
        """Merge a coarser rollup's touched days or months anew out of the finest one."""
        by_day = rollup.grain == "day"
        part = PART if by_day else MONTH
        fine = read_parquet_or_none(self.spark, self.path(self.finest))
        left: set[str] = set()
        if fine is not None and months:
            unit = day_text(PART) if by_day else F.substring(day_text(PART), 1, 7)
            rows = fine.where(unit.isin(todo if by_day else months))
            group = F.col(PART) if by_day else unit.alias(MONTH)
            if not by_day:
                left = {r[0] for r in rows.select(unit).distinct().collect()}
            write_partitions(rows.groupBy(group, *rollup.dims).agg(*_merged_states(self.model)), self.path(rollup), part)
        for name in (gone if by_day else set(months) - left):
            delete_path(self.spark, f"{self.path(rollup)}/{part}={name}")

    def choose(self, dims: Sequence[str], where: Mapping[str, Sequence] | None = None, unit: str | None = None,
               between: tuple[dt.date | None, dt.date | None] | None = None, keys: Sequence[str] = ()) -> Rollup | None:
        """The coarsest rollup with all of ``dims``, filters and join ``keys`` that the time unit and range fit; or None."""
        needed = {*dims, *(where or {}), *keys}
        ends = [e for e in (between or ()) if e is not None]
        if any(isinstance(e, dt.datetime) and e.time() != dt.time() for e in ends):
            return None
        whole_months = all(e.day == 1 for e in ends)
        fitting = [r for r in self.rollups if needed <= set(r.dims) and (unit is None or unit in _MADE_OF[r.grain])
                   and (r.grain == "day" or whole_months)]
        return min(fitting, key=lambda r: (len(r.dims), r.grain != "month"), default=None)

    def answer(self, dims: Sequence[str] = (), metrics: Sequence[str] | None = None,
               where: Mapping[str, Sequence] | None = None, between: tuple | None = None, unit: str | None = None,
               dim_area: DataFrame | None = None, how: str = "left", area_dims: Sequence[str] = (),
               round_to: int | None = None, with_count: bool = False, fact: DataFrame | None = None) -> DataFrame:
        """X1 from the rollups: metrics by ``dims``, by ``unit`` of the mart's time column if given, and by
        ``area_dims`` of the joined area dimension.

        ``where`` maps dimensions to their wanted values, ``between`` is a half-open range of days.
        """
        model = MODELS[self.model]
        chosen = [m for m in model.metrics if metrics is None or m.name in metrics]
        if metrics is not None and len(chosen) < len(set(metrics)):
            raise KeyError(f"unknown metrics for {self.model}: {', '.join(sorted(set(metrics) - {m.name for m in chosen}))}")
        time_col = next(iter(model.time_dimensions))
        keys = [model.join_on] if dim_area is not None and model.join_on else []
        rollup = self.choose(dims, where, unit, between, keys)
        if rollup is None:
            if fact is None:
                raise NoRollupError(f"no rollup of {self.model} fits, and no fact table is given")
            return self._from_fact(fact, time_col, dims, metrics, where, between, unit, dim_area, how, area_dims, round_to, with_count)
        part = PART if rollup.grain == "day" else MONTH
        rows = self.spark.read.schema(self._schema(rollup)).parquet(self.path(rollup))
        for name, values in (where or {}).items():
            rows = rows.where(F.col(name).isin(list(values)))
        start = F.col(PART) if part == PART else F.try_to_date(F.concat(MONTH, F.lit("-01")))
        for end, inside in zip(between or (), (lambda e: start >= e, lambda e: start < e), strict=False):
            if end is not None:
                rows = rows.where(inside(F.lit(end).cast("date")))
        if keys:
            rows = join_dim(rows, dim_area, model.join_on, how=how)
        group = [*dims, *area_dims] + ([F.date_trunc(unit, start.cast("timestamp")).alias(time_col)] if unit else [])
        merged = rows.groupBy(*group).agg(*_merged_states(self.model))
        names = [*dims, *area_dims, *([time_col] if unit else [])]
        count = ["row_count"] if with_count else []
        return merged.select(*names, *[_metric(m, round_to) for m in chosen], *count)

    def _schema(self, rollup: Rollup):
        """The stored schema; the month stays text."""
        part = PART if rollup.grain == "day" else MONTH
        stored = self.spark.read.parquet(self.path(rollup)).schema
        if part == MONTH:
            from pyspark.sql.types import StringType
            stored[MONTH].dataType = StringType()
        return stored

    def _from_fact(self, fact, time_col, dims, metrics, where, between, unit, dim_area, how, area_dims, round_to, with_count):
        if dim_area is not None:  # the area dimension's own columns, as in a rollup
            fact = fact.drop(*[c for c in area_dims if c not in dims])
        condition = F.lit(True)
        for name, values in (where or {}).items():
            condition &= F.col(name).isin(list(values))
        low, high = between or (None, None)
        kind = dict(fact.dtypes)[time_col]
        if low is not None:
            condition &= F.col(time_col) >= F.lit(low).cast(kind)
        if high is not None:
            condition &= F.col(time_col) < F.lit(high).cast(kind)
        return metric_query(fact, self.model, [*dims, *area_dims, *([time_col] if unit else [])], metrics, condition, dim_area,
                            how, {time_col: unit} if unit else None, round_to=round_to, with_count=with_count)

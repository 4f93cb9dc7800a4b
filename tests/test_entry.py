"""Driver contract: entry runs, every query has an oracle, names line up."""

import re

import __spark_entry__ as E
from conftest import SF


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"area_map_code", "average_price", "row_count"}
    assert df.count() > 0


def test_every_query_has_sql():
    own = {name for name in E.queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_build_and_run_small(spark):
    for name in ["dedupe_latest_prices", "unpivot_categories", "sync_decision", "manifest_latest",
                 "load_progress", "parse_utc_rejects"]:
        df = E.queries()[name](spark, SF)
        assert df.count() >= 0, name

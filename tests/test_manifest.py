"""File selection and change detection: the source's cases and ours."""

import pytest
from pyspark.sql import functions as F

from fixture_files import fx
from gridmart.operators import manifest as M

FOLDER = "ImbalancePrices_17.1.G_r3.1"


@pytest.fixture
def log(spark):
    return M.read_manifest(spark, fx("manifest.tsv"))


def names(df):
    return [r["filename"] for r in df.collect()]


def test_blank_names_dropped(log):
    assert log.count() == 5


def test_enabled_instruments():
    from gridmart.schemas import INSTRUMENTS
    enabled = [k for k, v in INSTRUMENTS.items() if v.enabled]
    assert "energy_prices" in enabled and "imbalance_prices" in enabled
    assert INSTRUMENTS["imbalance_prices"].folder == FOLDER


def test_update_order_malformed_last(log):
    sel = M.order_files(M.select_files(log, FOLDER))
    assert names(sel) == ["2025_12_ImbalancePrices_17.1.G_r3.1.csv",
                          "2026_07_ImbalancePrices_17.1.G_r3.1.csv",
                          "2026_08_ImbalancePrices_17.1.G_r3.1.csv",
                          "2026_09_01_ImbalancePrices_17.1.G_r3.1.CSV"]


def test_latest_only(spark, log):
    two = log.where(F.col("file_name").startswith("2026_0") & ~F.col("file_name").contains("09_01"))
    latest = M.latest_per_folder(M.select_files(two, FOLDER))
    assert names(latest) == ["2026_08_ImbalancePrices_17.1.G_r3.1.csv"]
    # a malformed update time counts as latest
    assert names(M.latest_per_folder(M.select_files(log, FOLDER))) == \
        ["2026_09_01_ImbalancePrices_17.1.G_r3.1.CSV"]


def test_years(log):
    assert names(M.select_files(log, FOLDER, years=[2025])) == \
        ["2025_12_ImbalancePrices_17.1.G_r3.1.csv"]


def test_missing_selected_file_fails(log):
    with pytest.raises(M.MissingFilesError, match="missing.csv"):
        M.select_named(log, ["missing.csv"], FOLDER)


def test_selected_files(log):
    got = M.select_named(log, ["2026_07_ImbalancePrices_17.1.G_r3.1.csv"], FOLDER)
    assert names(got) == ["2026_07_ImbalancePrices_17.1.G_r3.1.csv"]


def test_changed_files_and_state(spark, log):
    sel = M.select_files(log, FOLDER)
    state = spark.createDataFrame([("2026_07_ImbalancePrices_17.1.G_r3.1.csv", "2026-08-01T10:00:00"),
                                   ("2026_08_ImbalancePrices_17.1.G_r3.1.csv", "older")],
                                  "filename string, updated string")
    changed = sorted(names(M.changed_files(sel, state)))
    assert "2026_07_ImbalancePrices_17.1.G_r3.1.csv" not in changed
    assert "2026_08_ImbalancePrices_17.1.G_r3.1.csv" in changed
    assert len(names(M.changed_files(sel, state, force=True))) == 4
    new_state = M.commit_state(state, sel)
    assert new_state.count() == 4
    assert M.changed_files(sel, new_state).count() == 0


def test_limit_per_group(log):
    got = M.limit_files_per_group(M.select_files(log), 1)
    assert got.groupBy("folder", "year").count().where("count > 1").count() == 0


def test_landed_unread(spark, tmp):
    open(f"{tmp}/2026_07_ImbalancePrices_17.1.G_r3.1.csv", "w").write("x")
    landed = M.list_landed(spark, tmp)
    m = M.annotate(spark.createDataFrame([("2026_07_ImbalancePrices_17.1.G_r3.1", "t"),
                                          ("2026_08_ImbalancePrices_17.1.G_r3.1", "t")],
                                         "file_name string, updated string"))
    assert names(M.landed_unread(m, landed)) == ["2026_08_ImbalancePrices_17.1.G_r3.1.csv"]

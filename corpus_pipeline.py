"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows that its predecessor kept; all but the last
return the columns they were given.

The stages of a run are called one after the other, each on the written result of
the one before.  So a stage begins by removing what the stages before it have
staged, unless the rows it is given are still to be computed from that: a
run needs the scratch space of one stage at a time.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.bin_slack import pack_1024
from gridmart.llm.common import scratch_of, staged, table
from gridmart.llm.mixture_langid import keep_identified
from gridmart.llm.pii_bootstrap import redacted
from gridmart.llm.qgram_decon import uncontaminated
from gridmart.llm.size_aware_join import one_of_each_group
from gridmart.session import delete_path, reads_path

#: A document stays if its main language has at least this share of its text.
LEAST_SHARE = 0.4
#: Near duplicates: words of a shingle and Jaccard similarity in percent.
SHINGLE, PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What the stages called so far have staged and not removed.
_left: list[str] = []


def _remove_scratch(spark: SparkSession, docs: DataFrame) -> None:
    """Remove what earlier stages staged, but what ``docs`` reads; their shuffles go with the last reference to them."""
    for path in list(_left):
        if not reads_path(docs, path):
            delete_path(spark, path)
            _left.remove(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _remove_scratch(spark, docs)
        with scratch_of(_left):
            return work(spark, docs, sf_dir)
    return run_stage


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a main language, go."""
    return keep_identified(docs, LEAST_SHARE)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each_group(docs, SHINGLE, PERCENT)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return redacted(docs)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that was kept is cut and placed in windows of 1024 tokens."""
    return pack_1024(docs)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("PII", private_data), ("packing", packing)]

#: SQL expresses neither the learned language model nor the token ids of the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

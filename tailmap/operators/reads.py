"""Reads: renumbering, validity, and counts.  Columns: sample, read_id, seq."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailmap.functions import sequence as S


def replace_seq(reads: DataFrame, seq: F.Column, *, least: int = 1) -> DataFrame:
    """``reads`` with another sequence; those that get shorter than ``least`` go."""
    return reads.withColumn("seq", seq).where(F.length("seq") >= least)


def valid_reads(reads: DataFrame, **limits: object) -> DataFrame:
    """The reads that ``is_valid_read`` keeps."""
    return reads.where(S.is_valid_read(F.col("seq"), **limits))


def read_metrics(reads: DataFrame) -> DataFrame:
    """sample, reads, min_length, max_length."""
    size = F.length("seq")
    return reads.groupBy("sample").agg(F.count(F.lit(1)).alias("reads"), F.min(size).alias("min_length"), F.max(size).alias("max_length"))


def keep_ids(reads: DataFrame, ids: DataFrame, *, mode: str = "keep") -> DataFrame:
    """Records whose read_id is (keep) or is not (discard) among ``ids``."""
    return reads.join(ids.select("read_id").distinct(), "read_id", "left_semi" if mode == "keep" else "left_anti")


def id_list(reads: DataFrame) -> DataFrame:
    """The read_ids, sorted in ranges."""
    return reads.select("read_id").repartitionByRange("read_id").sortWithinPartitions("read_id")


def keep_short(reads: DataFrame, most: int) -> DataFrame:
    """Records of at most so many letters."""
    return reads.where(F.length("seq") <= most)


def metrics_long(metrics: DataFrame, scope: str) -> DataFrame:
    """scope, sample, key, value of a wide table of counters: the long form that all stages append to."""
    keys = [c for c in metrics.columns if c != "sample"]
    return metrics.select(F.lit(scope).alias("scope"), "sample", *[F.col(k).cast("long") for k in keys]).unpivot(["scope", "sample"], keys, "key", "value")

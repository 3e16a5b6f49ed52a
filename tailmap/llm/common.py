"""Helpers shared by the operators: reading tables, cutting lineage, ASCII case, word patterns."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_OWN_DIR: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where that is unset and Spark runs in this process alone, as in tests, a temporary one; on a cluster an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return _OWN_DIR[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Cuts the lineage, so that a lost executor costs no more than the work since then, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else as it is (``lower`` would also fold other scripts).

    A text of ASCII only takes the fast built-in path; for the others ``translate`` maps the 26 letters.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name in taken:
        name += "_"
    return name

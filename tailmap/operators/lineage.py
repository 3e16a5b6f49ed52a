"""Tables written in between, where a plan reads one result more than once or a lost executor should not cost all before it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}


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

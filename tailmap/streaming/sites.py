"""3' ends from files as they arrive: counts of a new sample only add rows to the long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tailmap.operators.sites import three_prime_ends

READS = "chr string, start0 long, end long, read_id string, strand string, sample string"


def append_sites(spark: SparkSession, source: str, target: str, checkpoint: str, *, schema: str = READS) -> StreamingQuery:
    """Count the 3' ends of each new batch of Parquet files in ``source`` and append them to ``target``; stops when it has seen all.

    Each batch goes to a folder of its own number, so one that runs again replaces itself.
    """

    def batch(rows: DataFrame, number: int) -> None:
        three_prime_ends(rows).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Delimited lines as a stream: an extension, the batch loader in sources.delimited is the main way in.

Lines arrive as text files; good rows and rejects are written for each micro-batch into a partition of its own number,
which a repeated batch replaces, so that the files hold every line once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.tables import replace_partitions
from ..sources.delimited import classify, harmonize


def load_stream(spark: SparkSession, path: str, header: list[str], columns: list[str], out: str, rejects: str, checkpoint: str, renames: dict[str, str] | None = None, legacy: bool = False) -> StreamingQuery:
    """Load the files there are and come until now, then stop; started again it goes on after them."""
    lines = spark.readStream.text(path).select(F.col("value").alias("raw_line"), F.lit(0).alias("line_no"))

    def write(batch: DataFrame, number: int) -> None:
        good, bad = classify(batch, header, legacy)
        replace_partitions(harmonize(good, columns, renames).withColumn("batch", F.lit(number)), out, "batch")
        replace_partitions(bad.withColumn("batch", F.lit(number)), rejects, "batch")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

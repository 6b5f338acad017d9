"""Writing and maintaining tables of files: append, upsert, partition replacement, evolution, compaction, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def append(rows: DataFrame, path: str, partition: str | None = None) -> None:
    """Create or append."""
    w = rows.write.mode("append")
    (w.partitionBy(partition) if partition else w).parquet(path)


def replace_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that occur in `rows` and no others; running it again changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """`target` with the rows of `source` in place of those with their key, and new ones added. Keys of `source` are unique or an
    arbitrary row of each counts; null keys match nothing."""
    one = source.dropDuplicates(keys)
    return target.join(one.select(*keys), keys, "left_anti").unionByName(one, allowMissingColumns=True)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both, with the columns of both; missing ones are null, old columns come first."""
    return old.unionByName(new, allowMissingColumns=True)


def dedupe(rows: DataFrame) -> DataFrame:
    return rows.distinct()


def compact(spark: SparkSession, path: str, to: str, rows_per_file: int = 1_000_000) -> None:
    """Rewrite a table to `to` with files of about so many rows."""
    rows = spark.read.parquet(path)
    n = max(1, -(-rows.count() // rows_per_file))
    rows.repartition(n).write.mode("overwrite").parquet(to)


def export_csv(rows: DataFrame, path: str) -> None:
    """One CSV file with a header, for results of a report's size."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def count_mismatch(local: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """Keys whose counts n differ, those missing on the live side as 0."""
    out = local.withColumnRenamed("n", "local_n").join(live.withColumnRenamed("n", "live_n"), key, "left").withColumn("live_n", F.coalesce("live_n", F.lit(0)))
    return out.withColumn("diff", F.col("local_n") - F.col("live_n")).filter("diff <> 0")


def threshold_sweep(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """Names and reports at or above each threshold, in one pass over (score, n_reports)."""
    hit = lambda t: F.col("score") >= t
    sums = rows.agg(*(F.count_if(hit(t)).alias(f"n{i}") for i, t in enumerate(thresholds)), *(F.coalesce(F.sum(F.when(hit(t), F.col("n_reports"))), F.lit(0)).alias(f"r{i}") for i, t in enumerate(thresholds)))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"n{i}").alias("matched"), F.col(f"r{i}").alias("reports")) for i, t in enumerate(thresholds)))))


def latency_stats(rows: DataFrame, key: str, value: str) -> DataFrame:
    """p50 and p95 of each key as the element at floor(n * p) of the sorted values."""
    by = Window.partitionBy(key)
    at = rows.withColumn("_i", F.row_number().over(by.orderBy(value)) - 1).withColumn("_n", F.count("*").over(by))
    pick = lambda p: F.max(F.when(F.col("_i") == F.least(F.col("_n") - 1, F.floor(F.col("_n") * p)), F.col(value)))
    return at.groupBy(key).agg(pick(0.5).alias("p50"), pick(0.95).alias("p95"))

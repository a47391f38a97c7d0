"""Tables kept up to date key by key, a partition at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Puts the stored rows and the updates of the same partitions together; it must leave every partition some rows.
Fold = Callable[[DataFrame, DataFrame], DataFrame]


def bucket(key: str, buckets: int) -> F.Column:
    """A bucket of a key, the same on every machine and in every run."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def newest_wins(keys: Sequence[str]) -> Fold:
    """An update replaces the stored row of its key."""
    return lambda stored, updates: stored.join(updates.select(*keys), list(keys), "left_anti").select(*updates.columns).unionByName(updates)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def merge_partitions(updates: DataFrame, path: str, by: Sequence[str], fold: Fold, schema: T.StructType | None = None) -> None:
    """Merge ``updates`` into the table at ``path``, which has a folder for each value of ``by``.

    Only partitions that the updates touch are read and written anew, each as a whole; the files of all others stay
    as they are. The stored rows are pruned to these partitions by a join, so no list of them passes the driver. Merging the
    same updates again changes nothing if ``fold`` prefers them, so a micro-batch may be tried again. One writer at a time.
    """
    spark = updates.sparkSession
    schema = schema or updates.schema
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)
    touched = updates.select(*by).distinct()
    stored = read(spark, path, schema).join(touched, list(by), "left_semi").select(*schema.fieldNames())
    merged = fold(stored, updates).select(*schema.fieldNames())
    (
        merged.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy(*by).parquet(path)
    )

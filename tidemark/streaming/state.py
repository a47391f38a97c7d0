"""Small state tables carried from one micro-batch to the next.

A state is written into the slot after the one it was made from, and only the slot read is
scanned, so no job overwrites files it still reads. A retried batch reads the same older state
and overwrites what its first try left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SLOTS = 4
_NONE = -1


@dataclass(frozen=True)
class State:
    rows: DataFrame
    slot: int


def load(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> State:
    """The newest state, or the newest older than batch ``before``; empty at the start."""
    stored = T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])
    spark.createDataFrame([], stored).write.mode("ignore").parquet(f"{path}/slot={_NONE}")
    full = T.StructType([*stored.fields, T.StructField("slot", T.IntegerType())])
    rows = spark.read.schema(full).parquet(path)
    older = rows if before is None else rows.filter(F.col("_batch") < before)
    newest = older.agg(F.max(F.struct("_batch", "slot")).alias("newest")).first()["newest"]
    slot = _NONE if newest is None else newest["slot"]
    return State(rows.filter(F.col("slot") == slot).select(*schema.fieldNames()), slot)


def save(rows: DataFrame, path: str, batch_id: int, after: State) -> None:
    """Store the state of ``batch_id`` made from the state ``after``."""
    rows.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
        f"{path}/slot={(after.slot + 1) % SLOTS}"
    )

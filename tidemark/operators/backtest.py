"""Figures of a table at a past version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import lake
from tidemark.schemas import LakeTable


def backtest_trades(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.min("event_time").alias("earliest"),
        F.max("event_time").alias("latest"),
        F.countDistinct("symbol").alias("symbols"),
        F.count_if((F.col("price") <= 0) | (F.col("quantity") <= 0)).alias("price_violations"),
        F.round(F.avg("price"), 4).alias("avg_price"),
    )


def backtest_candles(rows: DataFrame) -> DataFrame:
    broken = (
        (F.col("high") < F.col("open")) | (F.col("high") < F.col("close"))
        | (F.col("low") > F.col("open")) | (F.col("low") > F.col("close")) | (F.col("low") > F.col("high"))
    )
    return rows.agg(
        F.count(F.lit(1)).alias("total_candles"),
        F.min("window_start").alias("earliest"),
        F.max("window_end").alias("latest"),
        F.countDistinct("symbol").alias("symbols"),
        F.count_if(broken).alias("ohlc_violations"),
        F.round(F.sum("volume"), 4).alias("total_volume"),
    )


def run_backtest(
    spark: SparkSession,
    root: str,
    table: LakeTable,
    *,
    snapshot_id: int | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Figures of the table at one version, with the version and the verdict on them.

    ``status`` is failed on invariant violations, empty without rows, else ok.
    """
    if not lake.table_exists(spark, root, table):
        raise ValueError(f"no table {table.name}")
    seq = lake.resolve_snapshot(spark, root, table, snapshot_id, as_of)
    rows = lake.scan_as_of(spark, root, table, snapshot_id=seq)
    trades = "trades" in table.name
    figures = backtest_trades(rows) if trades else backtest_candles(rows)
    violations = F.col("price_violations" if trades else "ohlc_violations")
    total = F.col("total_trades" if trades else "total_candles")
    return figures.select(
        F.lit(table.name).alias("table_name"),
        F.lit(seq).cast("bigint").alias("snapshot_id"),
        "*",
        F.when(violations > 0, "failed").when(total == 0, "empty").otherwise("ok").alias("status"),
    )

"""Candle, volatility and late-trade streams. Aggregations are those of the batch operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark import schemas
from tidemark.operators import candles as c
from tidemark.operators.serving import matching_subscribers

# The volatility table has no lateness bound of its own; state is kept this long.
VOLATILITY_DELAY = "1 day"


def sealed_candles(trades: DataFrame, interval: str) -> DataFrame:
    """Candles of a trade stream, each once, after its window end plus grace (append mode).

    Every interval is a query of its own because the grace is that query's watermark delay.
    Trades of windows already sealed are dropped and counted by the engine.
    """
    grace = schemas.INTERVALS[schemas.check_interval(interval)].grace
    return c.candles(trades.withWatermark("event_time", grace), interval)


def open_candles(trades: DataFrame, interval: str) -> DataFrame:
    """Every change of the candles still open (update mode)."""
    grace = schemas.INTERVALS[schemas.check_interval(interval)].grace
    return c.candles(trades.withWatermark("event_time", grace), interval, final=False)


def volatility(
    trades: DataFrame, size: str = "5 minutes", hop: str = "1 minute", delay: str = VOLATILITY_DELAY
) -> DataFrame:
    """Price deviation over hopping windows with every change visible (update mode)."""
    windows = (
        trades.withWatermark("event_time", delay)
        .groupBy("symbol", F.window("event_time", size, hop).alias("window"))
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            F.sum("price").alias("price_sum"),
            F.sum(F.col("price") * F.col("price")).alias("square_sum"),
        )
    )
    return c.volatility_columns(windows)


def late_trades(trades: DataFrame) -> DataFrame:
    """Trades that arrived more than ten seconds late; a second query on the same log."""
    return c.late_trades(trades)


def without_repeats(trades: DataFrame, delay: str) -> DataFrame:
    """Drop repeated deliveries within the delay; state is bounded by it.

    A row further behind the newest event than ``delay`` is dropped, repeated or not: choose it above
    the longest lateness that is to be kept. This only thins the stream early. That no trade is stored
    twice is the lake sink's guarantee, which needs no delay.
    """
    return trades.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        list(schemas.TRADES_TABLE.keys)
    )


def push_feed(candles: DataFrame, subscriptions: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Sealed candles per subscriber, as a stream-static equi join."""
    return matching_subscribers(candles, subscriptions, symbols)

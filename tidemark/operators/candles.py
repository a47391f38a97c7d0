"""OHLCV candles, volatility and late trades; the same functions serve batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas

LATE_AFTER_MS = 10_000


def _positions(order: str | None) -> Column | str:
    """Log order; where a lake row has no offset, event time, arrival and id stand in for it."""
    return order if order else F.struct("event_time", "ingest_time", "trade_id")


def _ohlcv(order: Column | str) -> list[Column]:
    """Aggregates in the order of the candle's columns, so that plans using all of them are alike."""
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.col("price") * F.col("quantity")).alias("notional"),
    ]


def _as_candles(grouped: DataFrame, interval: str, final: bool) -> DataFrame:
    return grouped.select(
        "symbol",
        F.lit(interval).alias("interval"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.try_divide("notional", "volume").alias("vwap"),
        "trade_count",
        F.lit(final).alias("is_final"),
        "notional",
    )


def candles(
    trades: DataFrame, interval: str, order: str | None = "kafka_offset", final: bool = True
) -> DataFrame:
    """One candle per symbol and tumbling window. Open and close follow the log offset.

    Partial aggregation runs before the only shuffle, on (symbol, window), so a hot symbol
    costs one row per window and map task.
    """
    size = schemas.INTERVALS[schemas.check_interval(interval)].size
    grouped = trades.groupBy("symbol", F.window("event_time", size).alias("window")).agg(
        *_ohlcv(_positions(order))
    )
    return _as_candles(grouped, interval, final).drop("notional")


def candle_pyramid(trades: DataFrame, order: str | None = "kafka_offset") -> DataFrame:
    """M1, M5 and H1 candles from a single pass over the trades: M5 and H1 are folded from M1."""
    minute = schemas.INTERVALS["M1"].size
    m1 = _as_candles(
        trades.groupBy("symbol", F.window("event_time", minute).alias("window")).agg(
            *_ohlcv(_positions(order)),
        ),
        "M1",
        True,
    ).filter(F.col("window_start").isNotNull())  # as the roll-ups' windows ask: all share one shuffle
    result = m1
    for interval in ("M5", "H1"):
        folded = m1.groupBy(
            "symbol", F.window("window_start", schemas.INTERVALS[interval].size).alias("window")
        ).agg(
            F.min_by("open", "window_start").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "window_start").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("notional").alias("notional"),
            F.sum("trade_count").alias("trade_count"),
        )
        result = result.unionByName(_as_candles(folded, interval, True))
    return result.drop("notional")


def sealed(candles: DataFrame, newest_event: Column, interval: str) -> DataFrame:
    """Candles whose window end lies at least the grace behind ``newest_event``.

    ``newest_event`` is a column or scalar subquery, such as
    ``trades.select(F.max("event_time")).scalar()``.
    """
    grace = schemas.INTERVALS[schemas.check_interval(interval)].grace_seconds
    return candles.filter(F.col("window_end") <= newest_event - F.make_dt_interval(secs=F.lit(grace)))


_VOLATILITY_SUMS = ("trade_count", "price_sum", "square_sum")


def volatility(trades: DataFrame, size: str = "5 minutes", hop: str = "1 minute") -> DataFrame:
    """Price deviation over hopping windows: sqrt(max(E[p^2] - E[p]^2, 0)).

    Trades are summed per hop first; only those sums are copied into the overlapping windows.
    """
    per_hop = trades.groupBy("symbol", F.window("event_time", hop).alias("hop")).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("price").alias("price_sum"),
        F.sum(F.col("price") * F.col("price")).alias("square_sum"),
    )
    windows = per_hop.groupBy("symbol", F.window("hop.start", size, hop).alias("window")).agg(
        *[F.sum(name).alias(name) for name in _VOLATILITY_SUMS]
    )
    return volatility_columns(windows)


def volatility_columns(windows: DataFrame) -> DataFrame:
    mean = F.col("price_sum") / F.col("trade_count")
    variance = F.col("square_sum") / F.col("trade_count") - mean * mean
    return windows.select(
        "symbol",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "trade_count",
        mean.alias("mean_price"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("volatility"),
    )


def skew_ms(ingest: str = "ingest_time", event: str = "event_time") -> Column:
    return F.unix_millis(ingest) - F.unix_millis(event)


def late_trades(trades: DataFrame, after_ms: int = LATE_AFTER_MS) -> DataFrame:
    """Trades whose arrival lags their event time by more than ``after_ms``, unchanged."""
    return trades.filter(skew_ms() > after_ms)

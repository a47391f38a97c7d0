"""Staging views and marts over the trade and candle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.candles import skew_ms


def staged_trades(trades: DataFrame) -> DataFrame:
    return trades.select(
        "trade_id",
        F.lower("exchange").alias("exchange"),
        "symbol",
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        F.upper("side").alias("side"),
        "event_time",
        "ingest_time",
        skew_ms().alias("ingest_skew_ms"),
    )


def staged_candles(candles: DataFrame) -> DataFrame:
    prices = [F.col(c).cast("double").alias(f"{c}_price") for c in ("open", "high", "low", "close")]
    return candles.select(
        "symbol",
        "interval",
        "window_start",
        "window_end",
        *prices,
        F.col("volume").cast("double").alias("volume"),
        F.col("vwap").cast("double").alias("vwap"),
        F.col("trade_count").cast("long").alias("trade_count"),
        "is_final",
    )


def enriched_candles(staged: DataFrame) -> DataFrame:
    """Range, body, direction and fractional return of each candle."""
    body = F.col("close_price") - F.col("open_price")
    return staged.drop("is_final").withColumns({
        "price_range": F.col("high_price") - F.col("low_price"),
        "body": body,
        "direction": F.when(F.col("close_price") >= F.col("open_price"), "BULLISH").otherwise("BEARISH"),
        "return_pct": F.when(
            F.col("open_price") > 0, F.try_divide(body, F.col("open_price"))
        ).otherwise(F.lit(0.0)),
        "window_date": F.to_date("window_start"),
    })


def fct_candle(candles: DataFrame) -> DataFrame:
    return enriched_candles(staged_candles(candles)).select(
        "symbol", "interval", "window_start", "window_end", "window_date",
        "open_price", "high_price", "low_price", "close_price",
        "volume", "vwap", "trade_count", "price_range", "body", "direction", "return_pct",
    )


def fct_trade(trades: DataFrame) -> DataFrame:
    return staged_trades(trades).select(
        "trade_id", "exchange", "symbol", "side", "price", "quantity",
        (F.col("price") * F.col("quantity")).alias("notional"),
        "ingest_skew_ms", "event_time", "ingest_time",
        F.to_date("event_time").alias("event_date"),
    )


def dim_symbol(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("canonical").alias("symbol"),
        F.col("base").alias("base_asset"),
        F.col("quote").alias("quote_asset"),
        "binance_symbol",
        "coinbase_symbol",
        F.col("active").alias("is_active"),
    )


def fct_symbol_daily(fct_candle: DataFrame) -> DataFrame:
    """Daily roll-up of the M1 candles per symbol."""
    volume = F.sum("volume")
    return (
        fct_candle.filter(F.col("interval") == "M1")
        .groupBy("symbol", F.col("window_date").alias("trade_date"))
        .agg(
            F.count(F.lit(1)).alias("candle_count"),
            F.sum("trade_count").alias("trade_count"),
            volume.alias("volume"),
            F.min_by("open_price", "window_start").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "window_start").alias("close_price"),
            F.when(
                volume > 0, F.try_divide(F.sum(F.col("vwap") * F.col("volume")), volume)
            ).otherwise(F.avg("vwap")).alias("vwap"),
        )
    )

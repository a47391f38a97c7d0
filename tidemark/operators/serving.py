"""Read models: candle history, daily history, open window, market overview, anomaly feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import schemas
from tidemark.functions import indicators

CANDLE_LIMIT = 5000
ANOMALY_LIMIT = 500
SPARK_CANDLES = 60


def clamp_limit(limit: int, ceiling: int = CANDLE_LIMIT) -> int:
    """What an interface grants of the limit that a caller of it asks for. The read models take any limit."""
    return max(1, min(int(limit), ceiling))


def require_symbol(seed: DataFrame, symbol: str) -> str:
    """Return ``symbol`` if the seed has it, else raise."""
    if seed.filter(F.col("canonical") == symbol).isEmpty():
        raise ValueError(f"unknown symbol {symbol!r}")
    return symbol


def symbol_list(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("canonical").alias("symbol"),
        F.col("base").alias("base_asset"),
        F.col("quote").alias("quote_asset"),
        F.col("active").alias("is_active"),
    )


def _prices() -> list[Column]:
    return [F.col(f"{name}_price").alias(name) for name in ("open", "high", "low", "close")]


def api_candles(fct_candle: DataFrame) -> DataFrame:
    return fct_candle.select(
        "symbol", "interval", "window_start", "window_end", *_prices(),
        "volume", "vwap", "trade_count", "direction", "return_pct",
    )


def api_daily(fct_symbol_daily: DataFrame) -> DataFrame:
    return fct_symbol_daily.select(
        "symbol", "trade_date", *_prices(), "volume", "vwap", "trade_count", "candle_count"
    )


def _newest(df: DataFrame, time: str, limit: int) -> DataFrame:
    return df.orderBy(F.col(time).desc()).limit(limit).orderBy(time)


def latest_candles(fct_candle: DataFrame, symbol: str, interval: str = "M1", limit: int = 200) -> DataFrame:
    """The newest ``limit`` candles in time order; both filters reach the scan."""
    wanted = (F.col("symbol") == symbol) & (F.col("interval") == schemas.check_interval(interval))
    return _newest(api_candles(fct_candle.filter(wanted)), "window_start", limit)


def latest_daily(fct_symbol_daily: DataFrame, symbol: str, limit: int = 90) -> DataFrame:
    return _newest(api_daily(fct_symbol_daily.filter(F.col("symbol") == symbol)), "trade_date", limit)


def live_candles(open_candles: DataFrame) -> DataFrame:
    """The newest window per symbol of a table of open windows."""
    newest = Window.partitionBy("symbol").orderBy(F.col("window_start").desc())
    return (
        open_candles.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def live_candle(open_candles: DataFrame, symbol: str, interval: str = "M1") -> DataFrame:
    """The open window of one symbol; no row if there is none."""
    wanted = (F.col("symbol") == symbol) & (F.col("interval") == schemas.check_interval(interval))
    return live_candles(open_candles.filter(wanted))


def recent_closes(fct_candle: DataFrame, rows: int = SPARK_CANDLES) -> DataFrame:
    """The last ``rows`` M1 closes of each symbol as an array in time order, with the last candle."""
    newest = Window.partitionBy("symbol").orderBy(F.col("window_start").desc())
    last = (
        fct_candle.filter(F.col("interval") == "M1")
        .select("symbol", "window_start", "window_end", "close_price")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= rows)
    )
    return last.groupBy("symbol").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("window_start", "close_price"))),
            lambda x: x["close_price"],
        ).alias("spark"),
        F.max("window_end").alias("updated_at"),
    )


def latest_daily_per_symbol(fct_symbol_daily: DataFrame) -> DataFrame:
    newest = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    return (
        fct_symbol_daily.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def market_rows(dim_symbol: DataFrame, fct_candle: DataFrame, fct_symbol_daily: DataFrame) -> DataFrame:
    """One row per active symbol: last close, change of the day, volume, trades, recent closes."""
    today = latest_daily_per_symbol(fct_symbol_daily).select(
        "symbol",
        (F.try_divide(F.col("close_price") - F.col("open_price"), F.col("open_price")) * 100).alias("change_pct"),
        F.col("close_price").alias("daily_close"),
        F.col("volume").alias("volume_24h"),
        F.col("trade_count").alias("trades_24h"),
    )
    recent = recent_closes(fct_candle)
    return (
        dim_symbol.filter("is_active")
        .select("symbol", "base_asset")
        .join(recent, "symbol", "left")
        .join(today, "symbol", "left")
        .select(
            "symbol",
            "base_asset",
            F.coalesce(F.try_element_at("spark", F.lit(-1)), F.col("daily_close")).alias("last"),
            "change_pct",
            "volume_24h",
            "trades_24h",
            F.coalesce("spark", F.array().cast("array<double>")).alias("spark"),
            "updated_at",
        )
    )


def stats_grid(fct_candle: DataFrame, fct_symbol_daily: DataFrame) -> DataFrame:
    """Last price of each symbol placed in its day: range position and premium over VWAP."""
    price = F.coalesce(F.try_element_at("spark", F.lit(-1)), F.col("close_price"))
    return (
        latest_daily_per_symbol(fct_symbol_daily)
        .join(recent_closes(fct_candle, 1), "symbol", "left")
        .select(
            "symbol",
            "trade_date",
            price.alias("price"),
            indicators.range_position(price, F.col("low_price"), F.col("high_price")).alias("range_position"),
            indicators.vwap_premium_pct(price, F.col("vwap")).alias("vwap_premium_pct"),
        )
    )


def merge_candle_feed(history: DataFrame, pushed: DataFrame, live: DataFrame) -> DataFrame:
    """History, pushed and open candles as one series; per window pushed beats history beats open.

    An open window gets its direction from its prices and a return of 0.
    """
    forming = live.select(
        *[c for c in history.columns if c not in ("direction", "return_pct")],
        F.when(F.col("close") >= F.col("open"), "BULLISH").otherwise("BEARISH").alias("direction"),
        F.lit(0.0).alias("return_pct"),
    )
    ranked = (
        pushed.withColumn("_priority", F.lit(1))
        .unionByName(history.withColumn("_priority", F.lit(2)))
        .unionByName(forming.withColumn("_priority", F.lit(3)))
    )
    return first_of_each_window(ranked)


def first_of_each_window(ranked: DataFrame) -> DataFrame:
    """Per window the row of the least ``_priority``."""
    first = Window.partitionBy("symbol", "interval", "window_start").orderBy("_priority")
    return (
        ranked.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_priority")
    )


def recent_anomalies(explanations: DataFrame, symbol: str | None = None, limit: int = 20) -> DataFrame:
    """The newest anomalies by detection time, optionally of one symbol."""
    rows = explanations.filter(F.col("symbol") == symbol) if symbol else explanations
    return rows.orderBy(F.col("detected_at").desc(), "anomaly_id").limit(limit)


def matching_subscribers(candles: DataFrame, subscriptions: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Candles with each subscriber that takes them: (subscriber, symbol), a null symbol takes all.

    A subscriber to all is written out over the listed ``symbols``, which leaves one equi join.
    """
    every = F.array(*[F.lit(s) for s in symbols])
    wanted = subscriptions.select(
        "subscriber",
        F.explode(F.when(F.col("symbol").isNull(), every).otherwise(F.array("symbol"))).alias("symbol"),
    )
    return candles.join(wanted, "symbol")

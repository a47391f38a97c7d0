"""Data contracts: one StructType per event or table, with keys and accepted values.

A field with a default (used by schema evolution) carries it in its metadata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the contracts.
EXCHANGES = ("binance", "coinbase")
SIDES = ("BUY", "SELL", "UNKNOWN")
ANOMALY_TYPES = ("PRICE_SPIKE", "VOLUME_SPIKE", "VOLATILITY_SPIKE")
DIRECTIONS = ("BULLISH", "BEARISH")


@dataclass(frozen=True)
class CandleInterval:
    size: str
    grace: str
    grace_seconds: int
    topic: str


# Window size, lateness allowance and topic of each interval.
INTERVALS = {
    "M1": CandleInterval("1 minute", "10 seconds", 10, "candles.m1"),
    "M5": CandleInterval("5 minutes", "30 seconds", 30, "candles.m5"),
    "H1": CandleInterval("1 hour", "60 seconds", 60, "candles.h1"),
}
TRADES_TOPIC = "trades.raw"
ORDERBOOK_TOPIC = "orderbook.delta"
ANOMALY_TOPIC = "events.anomaly"


def _field(name: str, dtype: T.DataType, nullable: bool = False, default=None, symbols: tuple[str, ...] = ()) -> T.StructField:
    metadata = {} if default is None else {"default": default}
    if symbols:  # an enum on the wire
        metadata["symbols"] = list(symbols)
    return T.StructField(name, dtype, nullable, metadata)


_string, _double, _long = T.StringType(), T.DoubleType(), T.LongType()
_timestamp = T.TimestampType()

TRADE = T.StructType([
    _field("trade_id", _string),
    _field("exchange", _string),
    _field("symbol", _string),
    _field("price", _double),
    _field("quantity", _double),
    _field("side", _string, default="UNKNOWN", symbols=SIDES),
    _field("event_time", _timestamp),
    _field("ingest_time", _timestamp),
])

# The lake keeps the log offset too, so that open and close can be recomputed in log order.
TRADE_LAKE = T.StructType(TRADE.fields + [_field("kafka_offset", _long, nullable=True)])

# On the bus the symbol is the message key; in the lake it is a column.
CANDLE = T.StructType([
    _field("interval", _string),
    _field("window_start", _timestamp),
    _field("window_end", _timestamp),
    _field("open", _double),
    _field("high", _double),
    _field("low", _double),
    _field("close", _double),
    _field("volume", _double),
    _field("vwap", _double),
    _field("trade_count", _long),
    _field("is_final", T.BooleanType(), default=True),
])
CANDLE_LAKE = T.StructType([_field("symbol", _string), *CANDLE.fields])

PRICE_LEVEL = T.StructType([_field("price", _double), _field("quantity", _double)])
ORDERBOOK_DELTA = T.StructType([
    _field("exchange", _string),
    _field("symbol", _string),
    _field("first_update_id", _long),
    _field("final_update_id", _long),
    _field("bids", T.ArrayType(PRICE_LEVEL, False)),
    _field("asks", T.ArrayType(PRICE_LEVEL, False)),
    _field("event_time", _timestamp),
    _field("ingest_time", _timestamp),
])

ANOMALY = T.StructType([
    _field("anomaly_id", _string),
    _field("symbol", _string),
    _field("detected_at", _timestamp),
    _field("anomaly_type", _string, symbols=ANOMALY_TYPES),
    _field("severity", _double),
    _field("current_value", _double),
    _field("baseline_value", _double),
    _field("candle_window_start", _timestamp),
    _field("candle_interval", _string, default="M1"),
])

EXPLANATION = T.StructType([
    _field("anomaly_id", _string),
    _field("symbol", _string),
    _field("detected_at", _timestamp),
    _field("anomaly_type", _string),
    _field("severity", _double, nullable=True),
    _field("current_value", _double, nullable=True),
    _field("baseline_value", _double, nullable=True),
    _field("candle_window_start", _timestamp, nullable=True),
    _field("candle_interval", _string, nullable=True),
    _field("explanation", _string, nullable=True),
    _field("key_factors", T.ArrayType(_string)),
    _field("news_headlines", T.ArrayType(_string)),
    _field("model_used", _string, nullable=True),
    _field("explained_at", _timestamp, nullable=True),
    _field("prompt_tokens", T.IntegerType(), nullable=True),
    _field("completion_tokens", T.IntegerType(), nullable=True),
])

SYMBOL = T.StructType([
    _field("canonical", _string),
    _field("base", _string),
    _field("quote", _string),
    _field("binance_symbol", _string),
    _field("coinbase_symbol", _string),
    _field("active", _string),
])

CONTRACTS = {
    "trade": TRADE,
    "candle": CANDLE,
    "orderbook_delta": ORDERBOOK_DELTA,
    "anomaly": ANOMALY,
}


def contract_schema(name: str) -> T.StructType:
    """The contract called ``name``; unknown names are an error."""
    if name not in CONTRACTS:
        raise ValueError(f"unknown contract {name!r}, expected one of {sorted(CONTRACTS)}")
    return CONTRACTS[name]


def check_interval(interval: str) -> str:
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval {interval!r}, expected one of {sorted(INTERVALS)}")
    return interval


@dataclass(frozen=True)
class LakeTable:
    """An insert-only table: business key, time column and how its files are laid out.

    ``time_in_key`` says that the time column is part of the key, so that a batch can only
    collide with rows of its own days.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    time_column: str
    day_column: str
    partition_column: str
    time_in_key: bool


TRADES_TABLE = LakeTable(
    "bronze.trades", TRADE_LAKE, ("exchange", "symbol", "trade_id"),
    "event_time", "event_day", "symbol", time_in_key=False,
)
CANDLES_TABLE = LakeTable(
    "silver.candles", CANDLE_LAKE, ("symbol", "interval", "window_start"),
    "window_start", "window_day", "interval", time_in_key=True,
)
LAKE_TABLES = (TRADES_TABLE, CANDLES_TABLE)

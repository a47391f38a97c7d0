"""SQL of the derived market tables, as common table expressions for the checks."""

from __future__ import annotations

from tidemark.plans.registry import settle_sql

TRADES = """trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id,
         CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'coinbase' END AS exchange,
         CASE event_type WHEN 'click' THEN 'BTC-USD' WHEN 'view' THEN 'ETH-USD'
                         WHEN 'purchase' THEN 'SOL-USD' WHEN 'signup' THEN 'XRP-USD'
                         ELSE 'DOGE-USD' END AS symbol,
         value AS price,
         CAST(CAST(json_extract_string(props, '$.k') AS INT) + 1 AS DOUBLE) AS quantity,
         CASE event_id % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'UNKNOWN' END AS side,
         date_trunc('millisecond', ts) AS event_time,
         date_trunc('millisecond', ts)
           + CAST(json_extract_string(props, '$.k') AS INT) * INTERVAL 150 MILLISECOND AS ingest_time,
         event_id AS kafka_offset
  FROM events)"""

SYMBOLS = """symbols(canonical, base, quote, binance_symbol, coinbase_symbol, active) AS (
  VALUES ('BTC-USD', 'BTC', 'USD', 'BTCUSDT', 'BTC-USD', true),
         ('ETH-USD', 'ETH', 'USD', 'ETHUSDT', 'ETH-USD', true),
         ('SOL-USD', 'SOL', 'USD', 'SOLUSDT', 'SOL-USD', true),
         ('XRP-USD', 'XRP', 'USD', 'XRPUSDT', 'XRP-USD', true),
         ('DOGE-USD', 'DOGE', 'USD', 'DOGEUSDT', 'DOGE-USD', true))"""

DELTAS = f"""{TRADES},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY kafka_offset) AS seq FROM trades),
deltas AS (
  SELECT exchange, symbol,
         10 * seq + CASE WHEN kafka_offset % 11 = 0 THEN -3
                         WHEN kafka_offset % 7 = 0 THEN 4 ELSE 0 END AS first_update_id,
         10 * seq + 9 AS final_update_id, price, quantity, event_time, ingest_time, kafka_offset
  FROM numbered)"""

_SIZES = {"M1": "1 MINUTE", "M5": "5 MINUTE", "H1": "1 HOUR"}
GRACE = {"M1": "10 SECOND", "M5": "30 SECOND", "H1": "60 SECOND"}


def candles(interval: str, source: str = "trades", name: str = "candles") -> str:
    size = _SIZES[interval]
    start = f"time_bucket(INTERVAL {size}, event_time)"
    return f"""{name} AS (
  SELECT symbol, '{interval}' AS "interval", {start} AS window_start,
         {start} + INTERVAL {size} AS window_end,
         min_by(price, kafka_offset) AS "open", max(price) AS high, min(price) AS low,
         max_by(price, kafka_offset) AS "close", sum(quantity) AS volume,
         sum(price * quantity) / sum(quantity) AS vwap,
         count(*) AS trade_count, true AS is_final
  FROM {source} GROUP BY symbol, {start})"""


ENRICHED_COLUMNS = """symbol, "interval", window_start, window_end,
         "open" AS open_price, high AS high_price, low AS low_price, "close" AS close_price,
         volume, vwap, trade_count, high - low AS price_range, "close" - "open" AS body,
         CASE WHEN "close" >= "open" THEN 'BULLISH' ELSE 'BEARISH' END AS direction,
         CASE WHEN "open" > 0 THEN ("close" - "open") / "open" ELSE 0.0 END AS return_pct,
         CAST(window_start AS DATE) AS window_date"""

CANDLE_COLUMNS = f"""symbol, "interval", window_start, window_end, "open", high, low, "close",
       volume, {settle_sql('vwap')} AS vwap, trade_count, is_final"""

DAILY = """daily AS (
  SELECT symbol, CAST(window_start AS DATE) AS trade_date, count(*) AS candle_count,
         CAST(sum(trade_count) AS BIGINT) AS trade_count, sum(volume) AS volume,
         min_by("open", window_start) AS open_price, max(high) AS high_price,
         min(low) AS low_price, max_by("close", window_start) AS close_price,
         CASE WHEN sum(volume) > 0 THEN sum(vwap * volume) / sum(volume) ELSE avg(vwap) END AS vwap
  FROM m1 GROUP BY symbol, CAST(window_start AS DATE))"""

"""Anomalies, order-book gaps and parsed exchange frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import indicators
from tidemark.operators import anomalies as a
from tidemark.operators import books, candles as c, parse
from tidemark.plans import oracle as o
from tidemark.plans.registry import query, settle, settle_sql
from tidemark.sources import market, seed


def anomaly_ctes(interval: str = "H1") -> str:
    """Baselines and spikes over the candles of ``interval``, as CTEs ending in ``anomalies``."""

    def spike(kind: str, hit: str, severity: str, current: str, base: str) -> str:
        return f"""SELECT symbol, "interval", window_start, '{kind}' AS anomaly_type,
           {severity} AS severity, {current} AS current_value, {base} AS baseline_value
    FROM zscores WHERE n >= 5 AND {hit}"""

    return f"""{o.TRADES}, {o.candles(interval)},
ranged AS (SELECT *, high - low AS rng FROM candles),
baseline AS (
  SELECT *, count(*) OVER prior AS n, lag("close") OVER ordered AS prev_close,
         avg(volume) OVER prior AS volume_mean, stddev_samp(volume) OVER prior AS volume_sd,
         min(volume) OVER prior = max(volume) OVER prior AS volume_constant,
         avg(rng) OVER prior AS range_mean, stddev_samp(rng) OVER prior AS range_sd,
         min(rng) OVER prior = max(rng) OVER prior AS range_constant
  FROM ranged
  WINDOW ordered AS (PARTITION BY symbol ORDER BY window_start),
         prior AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
zscores AS (
  SELECT *, abs("close" - prev_close) / nullif(prev_close, 0) * 100 AS pct,
         CASE WHEN volume_constant OR volume_sd IS NULL OR volume_sd <= 0 THEN 0
              ELSE (volume - volume_mean) / volume_sd END AS volume_z,
         CASE WHEN range_constant OR range_sd IS NULL OR range_sd <= 0 THEN 0
              ELSE (rng - range_mean) / range_sd END AS range_z
  FROM baseline),
spikes AS (
  {spike('PRICE_SPIKE', 'prev_close > 0 AND pct >= 2.0', 'round_even(pct / 100, 6)', '"close"', 'prev_close')}
  UNION ALL {spike('VOLUME_SPIKE', 'volume_z >= 3.0', 'round_even(volume_z, 4)', 'volume', 'volume_mean')}
  UNION ALL {spike('VOLATILITY_SPIKE', 'range_z >= 3.0', 'round_even(range_z, 4)', 'rng', 'range_mean')}),
anomalies AS (
  SELECT sha256(concat_ws('|', symbol, "interval", CAST(epoch_ms(window_start) AS VARCHAR), anomaly_type))
           AS anomaly_id,
         symbol, anomaly_type, severity, current_value, baseline_value,
         window_start AS candle_window_start, "interval" AS candle_interval
  FROM spikes)"""


ANOMALY_OUTPUT = f"""anomaly_id, symbol, anomaly_type, severity,
       {settle_sql('current_value', 4)} AS current_value, {settle_sql('baseline_value', 4)} AS baseline_value,
       candle_window_start, candle_interval"""


def comparable_anomalies(df: DataFrame) -> DataFrame:
    """Anomalies without the processing time, floats rounded for comparison."""
    return df.drop("detected_at").withColumns({
        "current_value": settle(F.col("current_value"), 4),
        "baseline_value": settle(F.col("baseline_value"), 4),
    })


def hourly_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.detect_anomalies(c.candles(market.trades(spark, sf_dir), "H1"))


@query("anomalies", f"WITH {anomaly_ctes()} SELECT {ANOMALY_OUTPUT} FROM anomalies")
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_anomalies(hourly_anomalies(spark, sf_dir))


@query("anomaly_counts", f"""WITH {anomaly_ctes()}
SELECT symbol, anomaly_type, count(*) AS anomalies FROM anomalies GROUP BY symbol, anomaly_type""")
def anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.anomaly_counts(hourly_anomalies(spark, sf_dir))


@query("candles_processed", f"""WITH {o.TRADES}, {o.candles('M1')}
SELECT symbol, count(*) AS candles_processed FROM candles GROUP BY symbol""")
def candles_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.candles_processed(c.candles(market.trades(spark, sf_dir), "M1"))


@query("severity_tiers", f"""WITH {anomaly_ctes()}
SELECT anomaly_id,
       CASE WHEN severity >= 10 THEN 'critical' WHEN severity >= 5 THEN 'high'
            WHEN severity >= 3 THEN 'moderate' ELSE 'info' END AS tier,
       CASE anomaly_type WHEN 'VOLUME_SPIKE' THEN 'Pico de volume' WHEN 'PRICE_SPIKE' THEN 'Salto de preço'
            ELSE 'Pico de volatilidade' END AS label,
       {settle_sql('current_value / nullif(baseline_value, 0)', 4)} AS multiple
FROM anomalies""")
def severity_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    multiple = indicators.multiple_of_baseline(F.col("current_value"), F.col("baseline_value"))
    return hourly_anomalies(spark, sf_dir).select(
        "anomaly_id",
        indicators.severity_tier(F.col("severity")).alias("tier"),
        indicators.anomaly_type_label(F.col("anomaly_type")).alias("label"),
        settle(multiple, 4).alias("multiple"),
    )


GAPS_SQL = f"""WITH {o.DELTAS},
previous AS (
  SELECT *, max(final_update_id) OVER (PARTITION BY exchange, symbol ORDER BY kafka_offset
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_final_id
  FROM deltas WHERE exchange = 'binance'),
checked AS (
  SELECT exchange, symbol, kafka_offset, first_update_id, final_update_id, previous_final_id,
         previous_final_id IS NULL AS first_seen,
         coalesce(first_update_id - previous_final_id - 1 > 0, false) AS is_gap,
         greatest(coalesce(first_update_id - previous_final_id - 1, 0), 0) AS missing
  FROM previous)"""
GAP_COLUMNS = (
    "exchange", "symbol", "kafka_offset", "first_update_id", "final_update_id", "previous_final_id",
    "first_seen", "is_gap", "missing",
)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books.sequence_gaps(market.orderbook_deltas(market.trades(spark, sf_dir)))


@query("orderbook_gaps", f"{GAPS_SQL} SELECT * FROM checked")
def orderbook_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(*GAP_COLUMNS)


@query("orderbook_gap_counts", f"""{GAPS_SQL}
SELECT exchange, symbol, count(*) AS deltas, count_if(is_gap)::BIGINT AS gaps,
       CAST(sum(missing) AS BIGINT) AS missing_ids
FROM checked GROUP BY exchange, symbol""")
def orderbook_gap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books.gap_counts(_checked(spark, sf_dir))


@query("parsed_binance_trades", f"""WITH {o.TRADES}
SELECT trade_id, exchange, symbol, price, quantity, CASE side WHEN 'SELL' THEN 'SELL' ELSE 'BUY' END AS side,
       event_time, ingest_time, kafka_offset FROM trades WHERE exchange = 'binance'""")
def parsed_binance_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = market.binance_trade_frames(market.trades(spark, sf_dir))
    return parse.known_trades(parse.resolve(parse.binance_trades(frames), seed.read_symbol_seed(spark)))


@query("parsed_coinbase_trades", f"""WITH {o.TRADES}
SELECT trade_id, exchange, symbol, price, quantity, side, event_time, ingest_time, kafka_offset
FROM trades WHERE exchange = 'coinbase'""")
def parsed_coinbase_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = market.coinbase_trade_frames(market.trades(spark, sf_dir))
    return parse.known_trades(parse.resolve(parse.coinbase_trades(frames), seed.read_symbol_seed(spark)))


def _levels(df: DataFrame) -> DataFrame:
    """Book levels as plain columns: one bid and one ask per derived delta."""
    first = lambda side, field: settle(F.get(F.col(side), 0)[field], 6)
    return df.select(
        "exchange", "symbol", "first_update_id", "final_update_id", "event_time", "ingest_time", "kafka_offset",
        F.size("bids").alias("bids"), F.size("asks").alias("asks"),
        first("bids", "price").alias("bid"), first("asks", "price").alias("ask"),
        first("bids", "quantity").alias("bid_quantity"), first("asks", "quantity").alias("ask_quantity"),
    )


def _delta_sql(exchange: str, first_id: str) -> str:
    return f"""WITH {o.DELTAS}
SELECT exchange, symbol, {first_id} AS first_update_id, final_update_id, event_time, ingest_time, kafka_offset,
       1 AS bids, 1 AS asks, {settle_sql('price * 0.999')} AS bid, {settle_sql('price * 1.001')} AS ask,
       {settle_sql('quantity')} AS bid_quantity, {settle_sql('quantity')} AS ask_quantity
FROM deltas WHERE exchange = '{exchange}'"""


@query("parsed_binance_depth", _delta_sql("binance", "first_update_id"))
def parsed_binance_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = market.binance_depth_frames(market.orderbook_deltas(market.trades(spark, sf_dir)))
    return _levels(parse.known_deltas(parse.resolve(parse.binance_depth(frames), seed.read_symbol_seed(spark))))


@query("parsed_coinbase_l2", _delta_sql("coinbase", "final_update_id"))
def parsed_coinbase_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = market.coinbase_l2_frames(market.orderbook_deltas(market.trades(spark, sf_dir)))
    return _levels(parse.known_deltas(parse.resolve(parse.coinbase_l2(frames), seed.read_symbol_seed(spark))))


@query("dropped_events", f"""WITH {o.TRADES}
SELECT exchange, 'unknown_symbol' AS reason, count(*) AS dropped
FROM trades WHERE symbol = 'DOGE-USD' GROUP BY exchange""")
def dropped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop counts of both exchanges against a seed that does not list DOGE-USD."""
    trades = market.trades(spark, sf_dir)
    listed = seed.read_symbol_seed(spark).filter(F.col("canonical") != "DOGE-USD")
    parsed = parse.binance_trades(market.binance_trade_frames(trades)).unionByName(
        parse.coinbase_trades(market.coinbase_trade_frames(trades))
    )
    return parse.dropped_counts(parse.resolve(parsed, listed))

"""Candles, volatility, late trades and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import candles as c
from tidemark.operators import marts
from tidemark.plans import oracle as o
from tidemark.plans.registry import query, settle, settle_sql
from tidemark.sources import market, seed


def _settled(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: settle(F.col(name)) for name in names})


@query("trades_staged", f"""WITH {o.TRADES}
SELECT trade_id, exchange, symbol, price, quantity, side, event_time, ingest_time,
       epoch_ms(ingest_time) - epoch_ms(event_time) AS ingest_skew_ms FROM trades""")
def trades_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.staged_trades(market.trades(spark, sf_dir))


@query("fct_trade", f"""WITH {o.TRADES}
SELECT trade_id, exchange, symbol, side, price, quantity, price * quantity AS notional,
       epoch_ms(ingest_time) - epoch_ms(event_time) AS ingest_skew_ms, event_time, ingest_time,
       CAST(event_time AS DATE) AS event_date FROM trades""")
def fct_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_trade(market.trades(spark, sf_dir))


@query("late_trades", f"""WITH {o.TRADES}
SELECT * FROM trades WHERE epoch_ms(ingest_time) - epoch_ms(event_time) > 10000""")
def late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.late_trades(market.trades(spark, sf_dir))


def _register_candles(interval: str) -> None:
    @query(f"candles_{interval.lower()}",
           f"WITH {o.TRADES}, {o.candles(interval)} SELECT {o.CANDLE_COLUMNS} FROM candles")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _settled(c.candles(market.trades(spark, sf_dir), interval), "vwap")


for _interval in ("M1", "M5", "H1"):
    _register_candles(_interval)


@query("candle_pyramid", f"""WITH {o.TRADES}, {o.candles('M1', name='m1')}, {o.candles('M5', name='m5')},
{o.candles('H1', name='h1')},
candles AS (SELECT * FROM m1 UNION ALL SELECT * FROM m5 UNION ALL SELECT * FROM h1)
SELECT {o.CANDLE_COLUMNS} FROM candles""")
def candle_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(c.candle_pyramid(market.trades(spark, sf_dir)), "vwap")


@query("candles_h1_sealed", f"""WITH {o.TRADES}, {o.candles('H1')}
SELECT {o.CANDLE_COLUMNS} FROM candles
WHERE window_end <= (SELECT max(event_time) FROM trades) - INTERVAL {o.GRACE['H1']}""")
def candles_h1_sealed(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = market.trades(spark, sf_dir)
    newest = trades.select(F.max("event_time")).scalar()
    return _settled(c.sealed(c.candles(trades, "H1"), newest, "H1"), "vwap")


VOLATILITY_SQL = f"""WITH {o.TRADES},
windows AS (
  SELECT symbol, price,
         time_bucket(INTERVAL 1 MINUTE, event_time) - CAST(hop AS INT) * INTERVAL 1 MINUTE AS window_start
  FROM trades, range(5) hops(hop)),
sums AS (
  SELECT symbol, window_start, count(*) AS n, sum(price) AS s, sum(price * price) AS s2
  FROM windows GROUP BY symbol, window_start)
SELECT symbol, window_start, window_start + INTERVAL 5 MINUTE AS window_end, n AS trade_count,
       {settle_sql('s / n')} AS mean_price,
       {settle_sql('sqrt(greatest(s2 / n - (s / n) * (s / n), 0.0))', 4)} AS volatility
FROM sums"""


@query("volatility_5m", VOLATILITY_SQL)
def volatility_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = c.volatility(market.trades(spark, sf_dir))
    return df.withColumns({
        "mean_price": settle(F.col("mean_price")), "volatility": settle(F.col("volatility"), 4),
    })


_ENRICHED = f"""WITH {o.TRADES}, {o.candles('H1')}, enriched AS (SELECT {o.ENRICHED_COLUMNS} FROM candles)
SELECT symbol, "interval", window_start, window_end, open_price, high_price, low_price, close_price,
       volume, {settle_sql('vwap')} AS vwap, trade_count, {settle_sql('price_range')} AS price_range,
       {settle_sql('body')} AS body, direction, {settle_sql('return_pct')} AS return_pct, window_date
FROM enriched"""


@query("candles_enriched", _ENRICHED)
def candles_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = c.candles(market.trades(spark, sf_dir), "H1")
    df = marts.enriched_candles(marts.staged_candles(candles))
    return _settled(df, "vwap", "price_range", "body", "return_pct")


@query("fct_candle", _ENRICHED.replace(o.candles("H1"), o.candles("M1")))
def fct_candle(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = marts.fct_candle(c.candles(market.trades(spark, sf_dir), "M1"))
    return _settled(df, "vwap", "price_range", "body", "return_pct")


@query("fct_symbol_daily", f"""WITH {o.TRADES}, {o.candles('M1', name='m1')}, {o.DAILY}
SELECT symbol, trade_date, candle_count, trade_count, volume, open_price, high_price, low_price,
       close_price, {settle_sql('vwap')} AS vwap FROM daily""")
def fct_symbol_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    fct = marts.fct_candle(c.candles(market.trades(spark, sf_dir), "M1"))
    return _settled(marts.fct_symbol_daily(fct), "vwap")


@query("dim_symbol", f"""WITH {o.TRADES}, {o.SYMBOLS}
SELECT canonical AS symbol, base AS base_asset, quote AS quote_asset, binance_symbol, coinbase_symbol,
       active AS is_active, (SELECT count(*) FROM trades t WHERE t.symbol = canonical) AS trades FROM symbols""")
def dim_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every symbol of the seed, with the number of its trades."""
    dim = marts.dim_symbol(seed.read_symbol_seed(spark))
    counts = market.trades(spark, sf_dir).groupBy("symbol").agg(F.count("*").alias("trades"))
    return dim.join(counts, "symbol", "left").withColumn("trades", F.coalesce("trades", F.lit(0)))

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, ms_of
from tidemark import schemas
from tidemark.functions import indicators as i
from tidemark.operators import candles as c, marts, serving as s
from tidemark.sources.seed import read_symbol_seed

DAY = 1700006400000  # midnight


@pytest.fixture
def candle_table(spark):
    """rows: (symbol, start ms, open, high, low, close, volume, vwap, trades[, interval])"""
    def build(*rows):
        data = []
        for symbol, start, o, h, l, cl, v, vwap, n, *rest in rows:
            data.append((symbol, rest[0] if rest else "M1", at(start), at(start + 60_000), float(o), float(h), float(l),
                         float(cl), float(v), float(vwap), n, True))
        return spark.createDataFrame(data, schemas.CANDLE_LAKE)

    return build


def test_trade_mart(make_trades):
    trades = make_trades([(DAY, 100, 0.5, "BTC-USD", 250), (DAY + 1, 200, 0.5, "BTC-USD", -3)])
    rows = marts.fct_trade(trades.withColumn("exchange", F.upper("exchange")).withColumn("side", F.lower("side"))).collect()
    assert [(r.notional, r.ingest_skew_ms, r.exchange, r.side) for r in rows] == [
        (50, 250, "binance", "BUY"), (100, -3, "binance", "BUY")]
    assert {str(r.event_date) for r in rows} == {"2023-11-15"}


def test_skew_counts_millisecond_borders(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.0009' e, timestamp'2024-01-01 00:00:00.0011' i")
    assert df.select(c.skew_ms("i", "e")).first()[0] == 1


def test_candle_mart(candle_table):
    row, other, zero = marts.fct_candle(candle_table(
        ("BTC-USD", DAY, 100, 110, 90, 105, 10, 102, 5), ("ETH-USD", DAY, 100, 110, 90, 95, 10, 102, 5),
        ("SOL-USD", DAY, 0, 1, 0, 0, 1, 1, 1),
    )).collect()
    assert (row.price_range, row.body, row.direction, row.return_pct) == (20, 5, "BULLISH", 0.05)
    assert (other.direction, other.return_pct) == ("BEARISH", -0.05)
    assert (zero.direction, zero.return_pct) == ("BULLISH", 0)


def test_daily_mart(candle_table):
    fct = marts.fct_candle(candle_table(
        ("BTC-USD", DAY + 60_000, 105, 120, 104, 118, 30, 110, 3),
        ("BTC-USD", DAY, 100, 110, 90, 105, 10, 102, 5),
        ("BTC-USD", DAY, 1, 999, 1, 1, 10, 1, 5, "H1"),
        ("ETH-USD", DAY, 1, 1, 1, 1, 0, 7, 1),
        ("ETH-USD", DAY + 60_000, 1, 1, 1, 1, 0, 9, 1),
    ))
    rows = {r.symbol: r for r in marts.fct_symbol_daily(fct).collect()}
    b = rows["BTC-USD"]
    assert (b.candle_count, b.trade_count, b.volume, b.open_price, b.high_price, b.low_price, b.close_price, b.vwap) == (
        2, 8, 40, 100, 120, 90, 118, 108)
    assert rows["ETH-USD"].vwap == 8


def test_dim_and_symbol_list(spark):
    seed = read_symbol_seed(spark)
    assert marts.dim_symbol(seed).filter("is_active AND base_asset = 'BTC'").first().binance_symbol == "BTCUSDT"
    assert s.symbol_list(seed).columns == ["symbol", "base_asset", "quote_asset", "is_active"]
    assert s.require_symbol(seed, "BTC-USD") == "BTC-USD"
    with pytest.raises(ValueError):
        s.require_symbol(seed, "FOO-USD")


def test_latest_candles(candle_table):
    fct = marts.fct_candle(candle_table(
        *[("BTC-USD", DAY + 60_000 * n, 1, 2, 0.5, n, 1, 1, 1) for n in range(5)],
        ("ETH-USD", DAY + 60_000 * 9, 1, 1, 1, 1, 1, 1, 1),
    ))
    assert [r.close for r in s.latest_candles(fct, "BTC-USD", "M1", 1).collect()] == [4]
    assert [r.close for r in s.latest_candles(fct, "BTC-USD").collect()] == [0, 1, 2, 3, 4]
    assert s.latest_candles(fct, "FOO").count() == 0
    with pytest.raises(ValueError):
        s.latest_candles(fct, "BTC-USD", "D1")
    plan = s.latest_candles(fct, "BTC-USD", "M1", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_latest_daily_and_clamp(candle_table):
    daily = marts.fct_symbol_daily(marts.fct_candle(candle_table(
        *[("BTC-USD", DAY + 86_400_000 * n, 1, 2, 0.5, n, 1, 1, 1) for n in range(4)])))
    assert [r.close for r in s.latest_daily(daily, "BTC-USD", 2).collect()] == [2, 3]
    assert [s.clamp_limit(n) for n in (-5, 0, 7, 99_999)] == [1, 1, 7, 5000]
    assert s.clamp_limit(9999, s.ANOMALY_LIMIT) == 500


def test_live_candle(candle_table):
    table = candle_table(("BTC-USD", DAY, 1, 1, 1, 1, 1, 1, 1), ("BTC-USD", DAY + 60_000, 2, 2, 2, 2, 1, 1, 1))
    assert ms_of(s.live_candle(table, "BTC-USD").first().window_start) == DAY + 60_000
    assert s.live_candle(table, "ETH-USD").isEmpty()


def test_market_rows(spark, candle_table):
    fct = marts.fct_candle(candle_table(
        *[("BTC-USD", DAY + 60_000 * n, 100, 200, 50, 100 + n, 1, 1, 1) for n in range(70)]))
    rows = {r.symbol: r for r in s.market_rows(
        marts.dim_symbol(read_symbol_seed(spark)), fct, marts.fct_symbol_daily(fct)).collect()}
    assert len(rows) == 5
    b = rows["BTC-USD"]
    assert (b.last, b.change_pct, b.volume_24h, b.trades_24h) == (169, 69, 70, 70)
    assert b.spark == [100.0 + n for n in range(10, 70)]
    assert ms_of(b.updated_at) == DAY + 60_000 * 70
    assert (rows["ETH-USD"].last, rows["ETH-USD"].spark) == (None, [])


def test_stats_grid(candle_table):
    fct = marts.fct_candle(candle_table(
        ("BTC-USD", DAY, 100, 110, 90, 105, 10, 100, 5), ("ETH-USD", DAY, 1, 1, 1, 1, 1, 1, 1)))
    rows = {r.symbol: r for r in s.stats_grid(fct, marts.fct_symbol_daily(fct)).collect()}
    assert (rows["BTC-USD"].range_position, rows["BTC-USD"].vwap_premium_pct) == (0.75, 5.0)
    assert rows["ETH-USD"].range_position is None


def test_merged_feed(candle_table):
    api = lambda *r: s.api_candles(marts.fct_candle(candle_table(*r)))
    b = "BTC-USD"
    history = api((b, DAY, 1, 1, 1, 1, 1, 1, 1), (b, DAY + 60_000, 2, 2, 2, 2, 1, 1, 1))
    pushed = api((b, DAY + 60_000, 2, 3, 2, 3, 1, 1, 1), (b, DAY + 120_000, 4, 4, 4, 4, 1, 1, 1))
    live = candle_table((b, DAY + 120_000, 9, 9, 9, 9, 1, 1, 1), (b, DAY + 180_000, 5, 5, 4, 4, 1, 1, 1))
    rows = s.merge_candle_feed(history, pushed, live).orderBy("window_start").collect()
    assert [(r.close, r.direction, r.return_pct) for r in rows] == [
        (1, "BULLISH", 0), (3, "BULLISH", 0.5), (4, "BULLISH", 0), (4, "BEARISH", 0)]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_indicators(spark):
    d = lambda x: F.lit(x).cast("double")
    assert [one(spark, i.severity_tier(d(x))) for x in (None, 2.9, 3, 5, 10)] == [
        "info", "info", "moderate", "high", "critical"]
    assert one(spark, i.anomaly_type_label(F.lit("PRICE_SPIKE"))) == "Salto de preço"
    assert one(spark, i.anomaly_type_label(F.lit("ODD_THING_HERE"))) == "odd thing here"
    assert [one(spark, i.multiple_of_baseline(d(a), d(b))) for a, b in ((6, 2), (6, 0), (None, 2))] == [3, None, None]
    assert [one(spark, i.range_position(d(p), d(1), d(h))) for p, h in ((0, 2), (9, 2), (1.5, 2), (1, 1))] == [0, 1, 0.5, None]
    assert [one(spark, i.vwap_premium_pct(d(110), d(v))) for v in (100, 0, None)] == [10, None, None]
    now, t = F.lit(at(100_000)), lambda ms: F.lit(at(ms))
    assert [one(spark, i.window_progress(now, t(a), t(b))) for a, b in ((50_000, 150_000), (0, 1), (9, 9))] == [0.5, 1, 0]
    null = F.lit(None).cast("timestamp")
    big = F.lit(at(1_000_000))
    assert [one(spark, i.freshness_light(x, big)) for x in (t(950_000), t(800_000), t(1), null, t(2_000_000))] == [
        "green", "amber", "red", "no data", "green"]
    assert one(spark, i.sparkline(F.array(d(1)))) is None
    line = one(spark, i.sparkline(F.array(d(1), d(3), d(2))))
    assert (line.points, line.direction) == ([0, 1, 0.5], "up")
    assert one(spark, i.sparkline(F.array(d(4), d(4)))).points == [0, 0]
    assert one(spark, i.base_asset(F.lit("btc-USD"))) == "BTC"


def test_recent_anomalies_and_subscribers(spark, candle_table):
    rows = [(str(n), ("BTC-USD", "ETH-USD")[n % 2], at(n)) for n in range(30)]
    table = spark.createDataFrame(rows, "anomaly_id string, symbol string, detected_at timestamp")
    assert [r.anomaly_id for r in s.recent_anomalies(table, limit=2).collect()] == ["29", "28"]
    assert [r.anomaly_id for r in s.recent_anomalies(table, "BTC-USD", 1).collect()] == ["28"]
    assert s.recent_anomalies(table.limit(0)).count() == 0
    subscriptions = spark.createDataFrame([("a", None), ("b", "ETH-USD")], "subscriber string, symbol string")
    candles = candle_table(("BTC-USD", DAY, 1, 1, 1, 1, 1, 1, 1), ("ETH-USD", DAY, 1, 1, 1, 1, 1, 1, 1))
    got = s.matching_subscribers(candles, subscriptions, ["BTC-USD", "ETH-USD"]).collect()
    assert sorted((r.subscriber, r.symbol) for r in got) == [("a", "BTC-USD"), ("a", "ETH-USD"), ("b", "ETH-USD")]

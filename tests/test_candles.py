import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import candles as c
from tests.conftest import ms_of

GOLDEN = [(1700000040000, 100, 1), (1700000055000, 200, 1), (1700000080000, 150, 2)]


@pytest.mark.parametrize("interval, start, end", [
    ("M1", 1700000040000, 1700000100000),
    ("M5", 1699999800000, 1700000100000),
    ("H1", 1699999200000, 1700002800000),
])
def test_golden_candle(make_trades, interval, start, end):
    row, = c.candles(make_trades(GOLDEN), interval).collect()
    assert (ms_of(row.window_start), ms_of(row.window_end)) == (start, end)
    assert (row.open, row.high, row.low, row.close) == (100, 200, 100, 150)
    assert (row.volume, row.vwap, row.trade_count, row.is_final) == (4, 150, 3, True)
    assert (row.symbol, row.interval) == ("BTC-USD", interval)


def test_open_and_close_follow_the_log_not_the_clock(make_trades):
    late_first = [(1700000080000, 150, 2), (1700000040000, 100, 1), (1700000055000, 200, 1)]
    row, = c.candles(make_trades(late_first), "M1").collect()
    assert (row.open, row.close) == (150, 200)
    row, = c.candles(make_trades(late_first).drop("kafka_offset"), "M1", order=None).collect()
    assert (row.open, row.close) == (100, 150)


def test_columns_match_the_contract(make_trades):
    assert c.candles(make_trades(GOLDEN), "M1").columns == schemas.CANDLE_LAKE.fieldNames()


def test_unknown_interval_is_refused(make_trades):
    with pytest.raises(ValueError):
        c.candles(make_trades(GOLDEN), "D1")


def test_pyramid_equals_direct_candles(make_trades):
    trades = make_trades([(1700000000000 + 7919 * i, 100 + (i * 37) % 11, 1 + i % 3) for i in range(400)])
    pyramid = c.candle_pyramid(trades)
    for interval in schemas.INTERVALS:
        direct = {r.window_start: r for r in c.candles(trades, interval).collect()}
        folded = pyramid.filter(F.col("interval") == interval).collect()
        assert len(folded) == len(direct)
        for row in folded:
            other = direct[row.window_start]
            assert row.vwap == pytest.approx(other.vwap, rel=1e-12)
            assert row.asDict() | {"vwap": 0} == other.asDict() | {"vwap": 0}


def test_volatility_counts_overlapping_windows(make_trades):
    rows = c.volatility(make_trades([(1700000040000, 10, 1), (1700000041000, 14, 1)])).collect()
    assert len(rows) == 5
    assert {(r.trade_count, r.mean_price, r.volatility) for r in rows} == {(2, 12.0, 2.0)}


def test_volatility_of_equal_prices_is_not_negative(make_trades):
    rows = c.volatility(make_trades([(1700000040000 + i, 0.1, 1) for i in range(7)])).collect()
    assert all(0 <= r.volatility < 1e-8 for r in rows)


def test_late_trades_are_routed_unchanged(make_trades):
    trades = make_trades([
        (1700000050000, 1, 1, "ETH-USD", 300), (1700000050000, 2, 1, "ETH-USD", 25_000),
        (1700000050000, 3, 1, "ETH-USD", 10_000), (1700000050000, 4, 1, "ETH-USD", 10_001),
    ])
    late = c.late_trades(trades)
    assert sorted(r.price for r in late.collect()) == [2, 4]
    assert late.exceptAll(trades).isEmpty()


def test_pyramid_scans_and_shuffles_trades_once(spark, make_trades, tmp_path):
    make_trades(GOLDEN).write.parquet(str(tmp_path / "t"))
    pyramid = c.candle_pyramid(spark.read.parquet(str(tmp_path / "t")))
    pyramid.collect()
    plan = pyramid._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 2


def test_candles_read_only_the_columns_they_use(spark, make_trades, tmp_path):
    make_trades(GOLDEN).write.parquet(str(tmp_path / "t"))
    plan = c.candles(spark.read.parquet(str(tmp_path / "t")), "H1")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<symbol:string,price:double,quantity:double,event_time:timestamp,kafka_offset:bigint>" in plan
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan and "SortAggregate" not in plan

import random
import statistics
from collections import deque

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, ms_of
from tidemark.operators import anomalies as a

MINUTE = 60_000
COLUMNS = "symbol string, interval string, window_start timestamp, high double, low double, close double, volume double"


def candles(spark, rows, symbol="BTC-USD", start=1_700_000_000_000 // MINUTE * MINUTE, step=MINUTE):
    """rows: (high, low, close, volume)"""
    return spark.createDataFrame(
        [(symbol, "M1", at(start + step * i), *map(float, r)) for i, r in enumerate(rows)], COLUMNS
    )


def kinds(df):
    return [r.anomaly_type for r in a.detect_anomalies(df).orderBy("candle_window_start").collect()]


def test_no_anomaly_before_five_candles(spark):
    quiet = [(1, 0.9, 1, 100)] * 4
    assert kinds(candles(spark, quiet + [(5, 0.1, 5, 1e6)])) == []


def test_each_kind_of_spike(spark):
    rng = random.Random(3)
    calm = [(100.2, 100, 100.1, 100 + rng.uniform(-5, 5)) for _ in range(20)]
    assert kinds(candles(spark, calm + [(100.2, 100, 100.1, 100_000)])) == ["VOLUME_SPIKE"]
    assert kinds(candles(spark, calm + [(110.2, 110, 110.11, 100)])) == ["PRICE_SPIKE"]
    ranges = [(1 + 0.001 * (1 + i % 4), 1, 1, 100) for i in range(20)]
    assert kinds(candles(spark, ranges + [(1 + 1.9, 1, 1, 100)])) == ["VOLATILITY_SPIKE"]


def test_identical_candles_are_no_anomaly(spark):
    assert kinds(candles(spark, [(0.301, 0.299, 0.30, 50.1)] * 50)) == []


def test_order_and_ids(spark):
    calm = [(100 + 0.1 * (i % 3), 100, 100, 100 + i % 5) for i in range(20)]
    df = candles(spark, calm + [(200, 100, 150, 10_000)])
    rows = a.detect_anomalies(df).collect()
    assert [r.anomaly_type for r in rows] == ["PRICE_SPIKE", "VOLUME_SPIKE", "VOLATILITY_SPIKE"]
    assert [r.anomaly_id for r in rows] == [r.anomaly_id for r in a.detect_anomalies(df).collect()]
    assert len({r.anomaly_id for r in rows}) == 3


def brute_force(rows, size=20, warm=5):
    """Expected anomalies of one symbol, candle by candle."""
    volumes, ranges, last, found = deque(maxlen=size), deque(maxlen=size), None, []

    def z(values, x):
        deviation = statistics.stdev(values)
        return (x - statistics.mean(values)) / deviation if deviation > 0 else 0.0

    for at_ms, high, low, close, volume in rows:
        if len(volumes) >= warm:
            if last > 0 and abs(close - last) / last * 100 >= 2:
                found.append((at_ms, "PRICE_SPIKE", round(abs(close - last) / last, 6)))
            if z(volumes, volume) >= 3:
                found.append((at_ms, "VOLUME_SPIKE", round(z(volumes, volume), 4)))
            if z(ranges, high - low) >= 3:
                found.append((at_ms, "VOLATILITY_SPIKE", round(z(ranges, high - low), 4)))
        volumes.append(volume)
        ranges.append(high - low)
        last = close
    return found


@pytest.mark.parametrize("step", [6 * 3600_000, 9 * 86400_000])
def test_long_history_over_many_months(spark, step):
    """Months with many and with few candles: baselines cross the month borders."""
    rng = random.Random(11)
    rows, price = [], 100.0
    for i in range(500):
        price *= 1 + rng.uniform(-0.015, 0.015) * (4 if rng.random() < 0.05 else 1)
        width = price * 0.001 * (rng.random() + (20 if rng.random() < 0.03 else 0.1))
        volume = 100 + 10 * rng.random() + (5000 if rng.random() < 0.03 else 0)
        rows.append((1_600_000_000_000 + step * i, price + width, price - width, price, volume))
    df = spark.createDataFrame([("BTC-USD", "M1", at(r[0]), *r[1:]) for r in rows], COLUMNS)
    quiet = spark.createDataFrame([("ETH-USD", "M1", at(r[0]), 2.0, 1.0, 1.5, 3.0) for r in rows], COLUMNS)
    got = a.detect_anomalies(df.unionByName(quiet)).collect()
    assert {r.symbol for r in got} == {"BTC-USD"}
    expected = brute_force(rows)
    assert len(expected) > 30
    assert sorted((ms_of(r.candle_window_start), r.anomaly_type) for r in got) == sorted(e[:2] for e in expected)
    by_key = {e[:2]: e[2] for e in expected}
    for r in got:
        assert r.severity == pytest.approx(by_key[(ms_of(r.candle_window_start), r.anomaly_type)], abs=2e-4)


def test_counts(spark):
    calm = [(100 + 0.1 * (i % 3), 100, 100, 100 + i % 5) for i in range(20)]
    df = candles(spark, calm + [(200, 100, 150, 10_000)])
    counts = {r.anomaly_type: r.anomalies for r in a.anomaly_counts(a.detect_anomalies(df)).collect()}
    assert counts == {"PRICE_SPIKE": 1, "VOLUME_SPIKE": 1, "VOLATILITY_SPIKE": 1}
    assert a.candles_processed(df).first().candles_processed == 21
    assert a.detect_anomalies(df, detected_at=F.lit(0)).select("detected_at").distinct().count() == 1

"""The hourly chain by touched days."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_keyed import files
from tidemark import schemas
from tidemark.operators import candles as c, lake, marts
from tidemark.plans import REGISTRY, jobs

TRADES, CANDLES = schemas.LAKE_TABLES
DAY = 86_400_000
START = 1700006400000  # midnight


@pytest.fixture
def chain(spark, make_trades, tmp_path):
    root, target = str(tmp_path / "lake"), str(tmp_path / "out")
    for table in schemas.LAKE_TABLES:
        lake.ensure_table(spark, root, table)

    class Chain:
        number = 0

        def commit(self, *rows, **changes):
            trades = make_trades(list(rows)).withColumns({
                "kafka_offset": F.col("kafka_offset") + 100 * self.number,
                "trade_id": F.concat(F.lit(f"{self.number}-"), "trade_id"),
            })
            candles = c.candles(trades, "M1").withColumn("kafka_offset", F.unix_millis("window_start"))
            lake.write_batch(trades.withColumns({k: F.lit(v) for k, v in changes.items()}), root, TRADES, self.number)
            lake.write_batch(candles, root, CANDLES, self.number)
            self.number += 1

        def run(self):
            return jobs.hourly_run(spark, root, target)

        def files(self):
            found = {}
            for place in ("copy/bronze/trades", "copy/silver/candles", "marts/fct_trade", "marts/fct_candle", "marts/fct_symbol_daily"):
                path = f"{target}/{place}"
                found |= {f"{place}/{k}": v for k, v in files(path).items()} if os.path.isdir(path) else {}
            return found

        def mart(self, name):
            return jobs.read_mart(spark, f"{target}/marts", name)

        def whole(self):
            return lake.read_table(spark, root, TRADES), lake.read_table(spark, root, CANDLES)

    return Chain()


def minutes(day, *of, symbol="BTC-USD"):
    return [(START + day * DAY + 60_000 * m, 100 + m, 1, symbol) for m in of]


def rows(df):
    return sorted(map(repr, df.collect()))


def test_a_run_rewrites_the_days_that_were_touched(chain):
    chain.commit(*minutes(0, 0, 1), *minutes(1, 0, 1), *minutes(2, 0, 1))
    report = chain.run()
    assert report.copied == {"bronze.trades": 6, "silver.candles": 6} and report.stopped == "marts"
    assert report.failed == ["candle check minute_gaps"]
    before = chain.files()
    assert len(before) == 15
    chain.commit(*minutes(1, 5), (START + DAY + 60_000, 7, 1))
    report = chain.run()
    after = chain.files()
    changed = {name for name in after if after[name] != before.get(name)}
    assert changed and all("2023-11-16" in name for name in changed) and len(changed) == 5
    trades, candles = chain.whole()
    fct = marts.fct_candle(candles)
    for name, want in (("fct_trade", marts.fct_trade(trades)), ("fct_candle", fct), ("fct_symbol_daily", marts.fct_symbol_daily(fct))):
        got = chain.mart(name)
        assert rows(got.select(*want.columns)) == rows(want)
    again = chain.files()
    assert chain.run().copied == {"bronze.trades": 0, "silver.candles": 0} and chain.files() == again


def test_a_failed_stage_is_the_last(chain):
    chain.commit(*minutes(0, 0, 1))
    assert chain.run().failed == []
    chain.commit(*minutes(1, 0, 1), exchange="kraken")
    built = chain.files()
    report = chain.run()
    assert (report.stopped, report.failed) == ("staging", ["stg_trades exchange accepted"])
    assert {k: v for k, v in chain.files().items() if k.startswith("marts")} == {k: v for k, v in built.items() if k.startswith("marts")}
    assert chain.mart("fct_trade").count() == 2


def test_marts_catch_up_after_a_stopped_run(chain, monkeypatch):
    """Days copied by a run that stopped are built by the next one that does not."""
    monkeypatch.setattr(schemas, "EXCHANGES", ("binance",))
    chain.commit(*minutes(0, 0, 1), exchange="coinbase")
    assert chain.run().stopped == "staging"
    monkeypatch.setattr(schemas, "EXCHANGES", ("binance", "coinbase"))
    chain.commit(*minutes(1, 0, 1))
    assert chain.run().stopped in (None, "marts")
    assert chain.mart("fct_trade").count() == 4 and chain.mart("fct_symbol_daily").count() == 2


def test_touched_days(spark, chain, tmp_path):
    chain.commit(*minutes(0, 0))
    chain.commit(*minutes(1, 0), *minutes(3, 0))
    chain.commit(*minutes(1, 1))
    days = lambda since, through: {str(r[0]) for r in lake.touched_days(spark, str(tmp_path / "lake"), TRADES, since, through).collect()}
    assert days(0, 1) == {"2023-11-15"} and days(1, 2) == {"2023-11-16", "2023-11-18"} and days(2, 3) == {"2023-11-16"}
    assert days(3, 3) == set() and len(days(0, 3)) == 3 and at(START).day == 15


def test_runs_query_keeps_to_sound_trades(spark, tmp_path):
    """Events of value 0, as in larger tables, fail no test of prices in the run on sound trades."""
    rows = [(n, n * 180, n % 4, "click", 0.0 if n in (3, 8) else 5.0, '{"k": 1}') for n in range(1, 15)]
    events = spark.createDataFrame(rows, "event_id bigint, s bigint, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_seconds(F.col("s") + START // 1000).cast("timestamp_ntz")).drop("s").write.parquet(
        str(tmp_path / "events.parquet"))
    found = REGISTRY["hourly_runs"].run(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [
        ("sound", "marts", "candle check minute_gaps", 12), ("spoiled", "staging", "stg_trades exchange accepted", 12)]

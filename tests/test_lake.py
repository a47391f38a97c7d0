import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidemark import schemas
from tidemark.operators import backtest, candles as c, lake, metrics
from tidemark.plans import REGISTRY, streams

T = schemas.TRADES_TABLE


@pytest.fixture
def root(spark, tmp_path):
    lake.ensure_table(spark, str(tmp_path), T)
    return str(tmp_path)


@pytest.fixture
def trades(spark):
    """rows: trade ids, or (id, price), or (id, price, symbol)"""
    def build(*rows, start=0, partition=0):
        data = []
        for n, row in enumerate(rows):
            ident, price, symbol = (*row, *(100.0, "BTC-USD")[len(row) - 1:]) if isinstance(row, tuple) else (row, 100.0, "BTC-USD")
            ms = 1_700_000_000_000 + 1000 * int(ident)
            data.append((str(ident), "binance", symbol, float(price), 0.5, "BUY", at(ms), at(ms + 5), start + n,
                         "trades.raw", partition))
        return spark.createDataFrame(
            data,
            "trade_id string, exchange string, symbol string, price double, quantity double, side string, "
            "event_time timestamp, ingest_time timestamp, kafka_offset bigint, topic string, partition int",
        )

    return build


def result(r):
    return (r.received, r.inserted, r.skipped)


def test_insert_replay_and_partial_replay(spark, root, trades):
    assert result(lake.write_batch(trades(1, 2), root, T, 0)) == (2, 2, 0)
    assert result(lake.write_batch(trades(1, 2), root, T, 1)) == (2, 0, 2)
    assert result(lake.write_batch(trades(1, 2, 3), root, T, 2)) == (3, 1, 2)
    assert lake.read_table(spark, root, T).count() == 3


def test_last_arrival_wins_in_a_batch_and_first_batch_wins_later(spark, root, trades):
    assert result(lake.write_batch(trades((1, 100), (1, 999)), root, T, 0)) == (2, 1, 1)
    assert result(lake.write_batch(trades((1, 5)), root, T, 1)) == (1, 0, 1)
    assert [r.price for r in lake.read_table(spark, root, T).collect()] == [999]


def test_empty_batch_commits_nothing(spark, root, trades):
    assert result(lake.write_batch(trades(1).limit(0), root, T, 0)) == (0, 0, 0)
    assert lake.list_snapshots(spark, root, T).count() == 0
    assert lake.committed_offsets(spark, root, T) == {}


def test_offsets_of_idle_partitions_are_kept(spark, root, trades):
    lake.write_batch(trades(1, 2, start=10), root, T, 0)
    lake.write_batch(trades(3, start=40, partition=1), root, T, 1)
    assert lake.committed_offsets(spark, root, T) == {"trades.raw.0": 12, "trades.raw.1": 41}


def test_ids_are_local_to_exchange_and_symbol(spark, root, trades):
    assert result(lake.write_batch(trades((1, 1, "BTC-USD"), (1, 1, "ETH-USD")), root, T, 0)) == (2, 2, 0)


def test_a_correction_with_another_day_is_still_a_repeat(spark, root, trades):
    lake.write_batch(trades(1), root, T, 0)
    moved = trades(1).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 40 DAYS"))
    assert result(lake.write_batch(moved, root, T, 1)) == (1, 0, 1)


def test_retry_of_a_committed_batch_returns_its_result(spark, root, trades):
    first = lake.write_batch(trades(1, 2), root, T, 7)
    assert lake.write_batch(trades(1, 2), root, T, 7) == first
    assert lake.list_snapshots(spark, root, T).count() == 1


def test_files_of_a_lost_writer_are_invisible_and_replaced(spark, root, trades):
    """The writer dies after its files and before its log row; the retry writes them again."""
    lake.write_batch(trades(1), root, T, 0)
    half = trades(2, 3).withColumn(lake.COMMIT, F.lit(2).cast("bigint"))
    lake._write_part(half, root, T, "sink-000000000001")
    assert lake.read_table(spark, root, T).count() == 1
    assert result(lake.write_batch(trades(2, 3, 4), root, T, 1)) == (3, 3, 0)
    assert sorted(r.trade_id for r in lake.read_table(spark, root, T).collect()) == ["1", "2", "3", "4"]


def test_candles_are_distinct_by_their_whole_key(spark, root, make_trades):
    table = schemas.CANDLES_TABLE
    lake.ensure_table(spark, root, table)
    trades = make_trades([(1700000040000, 1, 1), (1700000100000, 1, 1)])
    rows = c.candles(trades, "M1").unionByName(c.candles(trades, "H1")).withColumn("kafka_offset", F.lit(0))
    assert result(lake.write_batch(rows, root, table, 0)) == (3, 3, 0)
    assert result(lake.write_batch(rows, root, table, 1)) == (3, 0, 3)
    back = lake.read_table(spark, root, table)
    assert set(back.columns) == {*schemas.CANDLE_LAKE.fieldNames(), "window_day"}


def test_as_of(spark, root, trades):
    lake.write_batch(trades((1, 100), (2, 200)), root, T, 0)
    between = datetime.now(timezone.utc)
    lake.write_batch(trades((3, 900)), root, T, 1)
    first, second = [r.snapshot_id for r in lake.list_snapshots(spark, root, T).collect()]
    assert lake.scan_as_of(spark, root, T, snapshot_id=first).count() == 2
    assert lake.scan_as_of(spark, root, T, snapshot_id=second).count() == 3
    assert lake.scan_as_of(spark, root, T, as_of=between).agg(F.avg("price")).first()[0] == 150
    figures = backtest.run_backtest(spark, root, T, as_of=between).first()
    assert (figures.total_trades, figures.avg_price, figures.symbols, figures.status) == (2, 150, 1, "ok")
    with pytest.raises(ValueError):
        lake.scan_as_of(spark, root, T)
    with pytest.raises(ValueError):
        lake.scan_as_of(spark, root, T, snapshot_id=first, as_of=between)
    with pytest.raises(ValueError):
        lake.scan_as_of(spark, root, T, as_of=between - timedelta(days=1))
    with pytest.raises(ValueError):
        lake.scan_as_of(spark, root, T, snapshot_id=99)
    with pytest.raises(ValueError):
        backtest.run_backtest(spark, root, schemas.CANDLES_TABLE, snapshot_id=1)


def test_backtest_reports_violations(spark, root, trades):
    lake.write_batch(trades((1, 100), (2, -1)), root, T, 0)
    figures = backtest.run_backtest(spark, root, T, snapshot_id=1).first()
    assert (figures.price_violations, figures.status) == (1, "failed")


def test_two_writers_insert_no_key_twice(spark, root, trades, monkeypatch):
    """The other writer commits between this one's files and its log row."""
    commit, others = lake._commit, []

    def late(*args, **values):
        if values["writer"] == "sink" and not others:
            others.append(lake.write_batch(trades(2, 3), root, T, 0, writer="replay"))
        return commit(*args, **values)

    monkeypatch.setattr(lake, "_commit", late)
    assert result(lake.write_batch(trades(1, 2), root, T, 0)) == (2, 1, 1)
    assert result(others[0]) == (2, 2, 0)
    assert sorted(r.trade_id for r in lake.read_table(spark, root, T).collect()) == ["1", "2", "3"]
    assert [r.snapshot_id for r in lake.list_snapshots(spark, root, T).collect()] == [1, 2]


def test_insert_reads_only_the_ids_of_its_symbols(spark, root, trades):
    lake.write_batch(trades(*range(1, 40), (1, 1, "ETH-USD")), root, T, 0)
    batch = trades(5, 6, (9, 1, "ETH-USD"))
    bounds = lake._profile(batch, T.keys).bounds
    assert sorted((b["symbol"][0], *b["trade_id"]) for b in bounds) == [("BTC-USD", "5", "6"), ("ETH-USD", "9", "9")]
    one = lake._profile(trades(5, 6), T.keys).bounds
    scan = lake._possible_matches(lake._published(spark, root, T), T, one)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "(symbol#" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(trade_id,5), LessThanOrEqual(trade_id,6)" in scan


def test_common_bounds_for_many_symbols(spark, root, trades, monkeypatch):
    monkeypatch.setattr(lake, "MOST_BOUNDS", 1)
    lake.write_batch(trades(1, (1, 1, "ETH-USD")), root, T, 0)
    assert len(lake._profile(trades(2, (3, 1, "ETH-USD")), T.keys).bounds) == 1
    assert result(lake.write_batch(trades(1, (1, 1, "ETH-USD"), (2, 1, "ETH-USD")), root, T, 1)) == (3, 1, 2)


def test_layout_and_codec(spark, root, trades):
    lake.write_batch(trades(1, (2, 1, "ETH-USD")), root, T, 0)
    folders = {os.path.basename(d) for d, _, _ in os.walk(root)}
    assert {"event_day=2023-11-14", "symbol=BTC-USD", "symbol=ETH-USD"} <= folders
    files = [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "zstd" in f]
    assert files
    plan = lake.read_table(spark, root, T).filter(
        (F.col("symbol") == "BTC-USD") & (F.col("event_day") == "2023-11-14")
    )._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_copy_skips_missing_tables(spark, root, trades, tmp_path):
    lake.write_batch(trades(1, 2), root, T, 0)
    assert lake.refresh_copy(spark, root, str(tmp_path / "copy")) == {"bronze.trades": 2}
    assert lake.refresh_copy(spark, root, str(tmp_path / "copy")) == {"bronze.trades": 2}


def test_run_records(spark, root, trades):
    lake.write_batch(trades(1, 2), root, T, 0)
    row, = lake.run_records(lake.commit_log(spark, root, T)).collect()
    assert (row.job_name, row.inputs, row.output, row.rows_written, row.state) == (
        "sink-trades", "trades.raw", "bronze.trades", 2, "COMPLETE")


def test_a_failed_batch_is_counted_and_can_be_retried(spark, root, trades):
    broken = trades(1).withColumn("price", F.raise_error(F.lit("bad page")).cast("double"))
    with pytest.raises(Exception, match="bad page"):
        lake.write_batch(broken, root, T, 0)
    assert result(lake.write_batch(trades(1), root, T, 0)) == (1, 1, 0)
    log = lake.commit_log(spark, root, T)
    counters = metrics.sink_counters(log).first()
    assert (counters.inserted, counters.batches, counters.errors) == (1, 1, 1)
    assert lake.list_snapshots(spark, root, T).count() == 1
    buckets = metrics.commit_histogram(log).orderBy("le").collect()
    assert [b.le for b in buckets] == [*metrics.COMMIT_BOUNDS_SECONDS, float("inf")] and buckets[-1]["count"] == 1


@pytest.mark.parametrize("column", ["trade_id", "price", "event_time"])
def test_a_missing_value_fails_the_whole_batch(spark, root, trades, column):
    rows = trades(1, 2)
    broken = rows.withColumn(column, F.when(F.col("trade_id") == "1", F.col(column)))
    with pytest.raises(Exception, match=f"{column} is missing"):
        lake.write_batch(broken, root, T, 0)
    assert lake.read_table(spark, root, T).isEmpty()



def test_a_query_of_trades_builds_no_candles(spark, tmp_path):
    events = spark.createDataFrame([(n, n * 100_000, n % 4, "click", 5.0, '{"k": 1}') for n in range(1, 15)],
                                   "event_id bigint, s bigint, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz")).drop("s").write.parquet(
        str(tmp_path / "events.parquet"))
    row, = REGISTRY["backtest_trades_asof"].run(spark, str(tmp_path)).collect()
    root, = [path for (_, folder), path in streams._LAKES.items() if folder == str(tmp_path)]
    assert row.total_trades > 0 and not lake.table_exists(spark, root, schemas.CANDLES_TABLE)
    assert REGISTRY["lake_layout"].run(spark, str(tmp_path)).filter("table_name = 'silver.candles'").count() > 0

import itertools
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, ms_of
from tidemark import schemas
from tidemark.operators import anomalies, books, candles as c, lake
from tidemark.sources import streams as s
from tidemark.streaming import candles as sc, jobs

T = schemas.TRADES_TABLE


@pytest.fixture
def log(spark, tmp_path, make_trades):
    """A folder of trade log files; each call to ``add`` makes one file, hence one micro-batch."""
    path, numbers = str(tmp_path / "log"), itertools.count()

    class Log:
        def add(self, *rows, first_offset=0):
            trades = make_trades(list(rows)).withColumn("kafka_offset", F.col("kafka_offset") + first_offset)
            trades = trades.withColumn("trade_id", F.col("kafka_offset").cast("string"))
            s.trade_records(trades).coalesce(1).write.parquet(f"{path}/n={next(numbers):04d}")

        def stream(self):
            reader = spark.readStream.schema(s.log_schema(schemas.TRADE)).option("maxFilesPerTrigger", 1)
            return reader.parquet(f"{path}/n=*")

        def trades(self):
            return s.trades_of(self.stream())

    return Log()


def run_candles(spark, log, tmp_path, interval="M1"):
    query = jobs.start_files(
        sc.sealed_candles(log.trades(), interval), str(tmp_path / "out"), str(tmp_path / "ck"), bounded=True
    )
    query.awaitTermination()
    return query, spark.read.schema(schemas.CANDLE_LAKE).parquet(str(tmp_path / "out")).collect()


def test_a_window_is_sealed_at_its_end_plus_grace(spark, log, tmp_path):
    log.add((1700000040000, 100, 1), (1700000055000, 200, 1), (1700000080000, 150, 2))
    log.add((1700000109000, 1, 1), first_offset=10)
    _, rows = run_candles(spark, log, tmp_path)
    assert rows == []
    log.add((1700000110000, 1, 1), first_offset=20)
    _, rows = run_candles(spark, log, tmp_path)
    row, = rows
    assert (ms_of(row.window_start), row.open, row.high, row.low, row.close, row.volume, row.vwap, row.trade_count) == (
        1700000040000, 100, 200, 100, 150, 4, 150, 3)
    # The window is closed: a straggler is dropped, and no candle comes out twice.
    log.add((1700000090000, 999, 1), first_offset=30)
    log.add((1700000111000, 1, 1), first_offset=40)
    query, rows = run_candles(spark, log, tmp_path)
    assert len(rows) == 1 and rows[0].high == 200
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1


def test_a_late_trade_within_the_grace_still_counts(spark, log, tmp_path):
    log.add((1700000040000, 100, 1), (1700000105000, 5, 1))
    log.add((1700000099000, 300, 1), first_offset=10)
    log.add((1700000120000, 5, 1), first_offset=20)
    _, rows = run_candles(spark, log, tmp_path)
    assert [(r.high, r.close, r.trade_count) for r in rows] == [(300, 300, 2)]


def test_late_trades_go_to_their_own_log(spark, log, tmp_path):
    log.add((1700000050000, 1, 1, "ETH-USD", 300), (1700000050000, 2, 1, "ETH-USD", 25_000))
    jobs.start_files(
        sc.late_trades(log.trades()), str(tmp_path / "dlq"), str(tmp_path / "ck"), bounded=True
    ).awaitTermination()
    assert [r.price for r in spark.read.parquet(str(tmp_path / "dlq")).collect()] == [2]


def test_live_table_follows_open_windows(spark, log, tmp_path):
    path, ck = str(tmp_path / "live"), str(tmp_path / "ck")

    def live():
        jobs.start_live_table(sc.open_candles(log.trades(), "M1"), path, ck, bounded=True).awaitTermination()
        return {ms_of(r.window_start): r for r in jobs.read_live(spark, path).collect()}

    log.add((1700000040000, 100, 1))
    assert live()[1700000040000].close == 100
    log.add((1700000041000, 130, 1), first_offset=10)
    log.add((1700000101000, 7, 1), first_offset=20)
    rows = live()
    assert (rows[1700000040000].close, rows[1700000040000].trade_count) == (130, 2)
    assert rows[1700000040000].is_final is False and len(rows) == 2
    log.add((1700000040000 + 86_400_000 * 2, 9, 1), first_offset=30)
    assert list(live()) == [1700000040000 + 86_400_000 * 2]


def test_repeated_deliveries_are_thinned(spark, log, tmp_path):
    log.add((1700000040000, 1, 1), (1700000041000, 2, 1))
    log.add((1700000040000, 1, 1), (1700000041000, 2, 1))
    jobs.start_files(
        sc.without_repeats(log.trades(), "10 seconds"), str(tmp_path / "out"), str(tmp_path / "ck"), bounded=True
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_volatility_shows_every_change(spark, log, tmp_path):
    log.add((1700000040000, 10, 1))
    log.add((1700000041000, 14, 1), first_offset=10)
    jobs.start_volatility_table(
        sc.volatility(log.trades()), str(tmp_path / "out"), str(tmp_path / "ck"), bounded=True
    ).awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "out"))
    assert changes.count() == 10
    latest = jobs.read_latest(changes, ["symbol", "window_start"])
    assert {(r.trade_count, r.volatility) for r in latest.collect()} == {(2, 2.0)}


def test_lake_sink_resumes_where_it_stopped(spark, log, tmp_path):
    root, ck = str(tmp_path / "lake"), str(tmp_path / "ck")
    results = []

    def drain():
        jobs.start_lake_sink(log.trades(), root, T, ck, bounded=True, on_result=results.append).awaitTermination()

    log.add((1700000040000, 1, 1), (1700000041000, 2, 1))
    drain()
    log.add((1700000042000, 3, 1), first_offset=2)
    drain()
    drain()
    assert [(r.received, r.inserted) for r in results] == [(2, 2), (1, 1)]
    assert lake.committed_offsets(spark, root, T) == {"trades.raw.0": 3}


def test_replay(spark, log, tmp_path):
    root, ck = str(tmp_path / "lake"), str(tmp_path / "ck")
    log.add((1700000040000, 1, 1), (1700000041000, 2, 1), (1700000042000, 3, 1))
    replay = lambda **kw: jobs.replay({"trades": log.stream()}, root, ck, **kw)
    assert replay(dry_run=True) == jobs.ReplaySummary(0, 0, 0, 0.0)
    assert not lake.table_exists(spark, root, T)
    late_half = replay(pipeline="trades", group="from-ts", start=at(1700000041000))
    assert (late_half.received, late_half.inserted, late_half.skipped) == (2, 2, 0)
    whole = replay(group="all")
    assert (whole.received, whole.inserted, whole.skipped) == (3, 1, 2)
    again = replay(group="again")
    assert (again.received, again.inserted, again.skipped) == (3, 0, 3)
    assert again.records_per_second > 0 and jobs.ReplaySummary(5, 0, 0, 0.0).records_per_second == 0
    assert replay(group="again").received == 0  # the same group resumes at its end
    beyond = replay(pipeline="trades", group="beyond", start=at(1800000000000))
    assert beyond.received == 0
    with pytest.raises(ValueError):
        replay(pipeline="orders")


def _logged(spark, path, rows):
    """Log records (partition, offset, log time in ms) in a file of their own."""
    value = "named_struct('trade_id', concat(partition, '-', offset), 'exchange', 'binance', 'symbol', 'BTC-USD', 'price', 1d, 'quantity', 1d, " \
            "'side', 'BUY', 'event_time', timestamp, 'ingest_time', timestamp)"
    df = spark.createDataFrame([(p, o, at(ms)) for p, o, ms in rows], "partition int, offset bigint, timestamp timestamp")
    df.select(
        F.lit(b"BTC-USD").alias("key"), F.expr(value).alias("value"), F.lit("trades.raw").alias("topic"), "partition", "offset", "timestamp"
    ).coalesce(1).write.mode("append").parquet(path)


def test_a_replay_seeks_the_first_late_enough_record(spark, tmp_path):
    """Behind it, records with older stamps count; partitions without one are skipped or read whole."""
    path = str(tmp_path / "log")
    _logged(spark, path, [(0, 0, 10), (0, 1, 60), (0, 2, 20), (1, 0, 10), (1, 1, 20)])
    _logged(spark, path, [(0, 3, 30), (2, 5, 50), (2, 6, 1), (2, 4, 49), (1, 2, 49)])
    batch = spark.read.schema(s.log_schema(schemas.TRADE)).parquet(path)
    want = {(0, 1), (1, None), (2, 5)}
    assert {(r.partition, r.start_offset) for r in s.seek_offsets(batch, at(50)).collect()} == want
    log = lambda: s.file_log(spark, path, schemas.TRADE, 1)
    starts = jobs.probe_offsets(log(), at(50), str(tmp_path / "seek"))
    assert {(r.partition, r.start_offset) for r in starts.collect()} == want
    kept = lambda beyond: {(r.partition, r.offset) for r in s.from_offsets(batch, starts, beyond).collect()}
    late = {(0, 1), (0, 2), (0, 3), (2, 5), (2, 6)}
    assert kept("skip") == late and kept("beginning") == late | {(1, 0), (1, 1), (1, 2)}
    with pytest.raises(ValueError, match="beyond|choice"):
        s.from_offsets(batch, starts, "end")
    replay = lambda **kw: jobs.replay({"trades": log()}, str(tmp_path / "lake"), str(tmp_path / "ck"), start=at(50), **kw)
    assert replay(group="a").received == 5
    again = replay(group="b", beyond="beginning")
    assert (again.received, again.skipped) == (8, 5)


def _candle_stream(spark, path):
    reader = spark.readStream.schema(s.log_schema(schemas.CANDLE)).option("maxFilesPerTrigger", 1)
    return s.candles_of(reader.parquet(path))


def test_stream_anomalies_equal_batch_over_restarts(spark, make_trades, tmp_path):
    trades = make_trades([
        (1700000000000 + 40_000 * i, 100 * (1.05 if i % 17 == 0 else 1) + i % 3, 500 if i % 23 == 0 else 1 + i % 4,
         ("BTC-USD", "ETH-USD")[i % 2]) for i in range(300)
    ])
    candles = c.candles(trades, "M1").cache()
    base = str(tmp_path)
    first = ms_of(candles.agg(F.min("window_start")).first()[0])
    for part in range(4):
        span = 3_000_000
        rows = candles.filter(F.floor((F.unix_millis("window_start") - first) / span) == part)
        s.candle_records(rows).coalesce(1).write.parquet(f"{base}/log/n={part}")
        jobs.start_anomalies(
            _candle_stream(spark, f"{base}/log/n=*"), f"{base}/out", f"{base}/state", f"{base}/ck", bounded=True
        ).awaitTermination()
    got = {r.anomaly_id: r.severity for r in spark.read.parquet(f"{base}/out").collect()}
    expected = {r.anomaly_id: r.severity for r in anomalies.detect_anomalies(candles).collect()}
    assert len(expected) > 10 and got == expected


def test_stream_gaps_equal_batch_over_restarts(spark, tmp_path):
    columns = ("exchange string, symbol string, first_update_id bigint, final_update_id bigint, "
               "kafka_offset bigint, note string")
    rows = [("binance", ("BTC-USD", "ETH-USD")[i % 2], 10 * i + (3 if i % 5 == 0 else 0), 10 * i + 19, i, "x")
            for i in range(40)]
    whole = spark.createDataFrame(rows, columns)
    base = str(tmp_path)
    for part in range(3):
        spark.createDataFrame(rows[part * 14:(part + 1) * 14], columns).coalesce(1).write.parquet(f"{base}/log/n={part}")
        stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(f"{base}/log/n=*")
        jobs.start_gaps(stream, f"{base}/out", f"{base}/state", f"{base}/ck", bounded=True).awaitTermination()
    pick = ("kafka_offset", "first_seen", "is_gap", "missing")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").select(*pick).collect())
    assert got == sorted(tuple(r) for r in books.sequence_gaps(whole).select(*pick).collect())
    assert any(r[2] for r in got)


def test_sealed_candles_reach_the_lake_over_a_restart(spark, log, tmp_path):
    root, table = str(tmp_path / "lake"), schemas.CANDLES_TABLE

    def drain():
        jobs.start_lake_sink(
            sc.sealed_candles(log.trades(), "M1"), root, table, str(tmp_path / "ck"), bounded=True, stateful=True,
            order="window_end",
        ).awaitTermination()
        return sorted((ms_of(r.window_start), r.close) for r in lake.read_table(spark, root, table).collect())

    log.add((1700000040000, 1, 1), (1700000110000, 2, 1))
    assert drain() == [(1700000040000, 1)]
    log.add((1700000170000, 3, 1), first_offset=10)
    assert drain() == [(1700000040000, 1), (1700000100000, 2)]


def test_anomaly_records_are_keyed_by_symbol(spark, make_trades):
    trades = make_trades([(1700000000000 + 60_000 * i, 100 if i < 10 else 200, 1) for i in range(11)])
    record, = s.anomaly_records(anomalies.detect_anomalies(c.candles(trades, "M1"))).collect()
    assert (bytes(record.key), record.topic) == (b"BTC-USD", "events.anomaly")
    assert (record.value.anomaly_type, record.value.severity) == ("PRICE_SPIKE", 1.0)


def test_push_feed(spark, make_trades, tmp_path):
    candles = c.candles(make_trades([(1700000040000, 1, 1), (1700000040000, 1, 1, "ETH-USD")]), "M1")
    s.candle_records(candles).coalesce(1).write.parquet(str(tmp_path / "log/n=0"))
    subscriptions = spark.createDataFrame(
        [("all", None), ("eth", "ETH-USD"), ("none", "SOL-USD")], "subscriber string, symbol string"
    )
    feed = sc.push_feed(_candle_stream(spark, str(tmp_path / "log/n=*")), subscriptions, ["BTC-USD", "ETH-USD", "SOL-USD"])
    jobs.start_files(feed, str(tmp_path / "out"), str(tmp_path / "ck"), bounded=True).awaitTermination()
    got = sorted((r.subscriber, r.symbol) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("all", "BTC-USD"), ("all", "ETH-USD"), ("eth", "ETH-USD")]


def test_keys(spark):
    df = spark.createDataFrame([("BTC-USD", at(1700000040000))], "symbol string, start timestamp")
    key = s.encode_windowed_key(F.col("symbol"), F.col("start"))
    row = df.select(
        key.alias("key"), s.decode_windowed_key(key).alias("symbol"), s.windowed_key_start(key).alias("start"),
        s.decode_plain_key(F.encode("symbol", "UTF-8")).alias("plain"),
    ).first()
    assert bytes(row.key) == b"BTC-USD" + (1700000040000).to_bytes(8, "big")
    assert (row.symbol, ms_of(row.start), row.plain) == ("BTC-USD", 1700000040000, "BTC-USD")
    null = F.lit(None).cast("binary")
    assert df.select(s.decode_windowed_key(null)).first()[0] is None
    with pytest.raises(Exception, match="8 bytes"):
        df.select(s.decode_windowed_key(F.lit(b"12345678"))).collect()


def test_a_candle_without_a_key_is_an_error(spark, make_trades):
    records = s.candle_records(c.candles(make_trades([(1700000040000, 1, 1)]), "M1"))
    with pytest.raises(Exception, match="without a key"):
        s.candles_of(records.withColumn("key", F.lit(None).cast("binary"))).collect()


def test_kafka_reader_options_and_avro_contract():
    options = s.kafka_options("broker:9092", s.CANDLE_TOPICS, from_timestamp=at(1700000000000), max_offsets=500)
    assert options["subscribe"] == "candles.m1,candles.m5,candles.h1"
    assert options["startingTimestamp"] == "1700000000000" and options["maxOffsetsPerTrigger"] == "500"
    assert '"default": true' in s.avro_schema(schemas.CANDLE, "Candle")
    trade = {f["name"]: f for f in json.loads(s.avro_schema(schemas.TRADE, "Trade"))["fields"]}
    assert trade["event_time"]["type"] == {"type": "long", "logicalType": "timestamp-millis"}
    assert trade["side"]["type"] == {"type": "enum", "name": "Side", "symbols": ["BUY", "SELL", "UNKNOWN"]}
    anomaly = {f["name"]: f for f in json.loads(s.avro_schema(schemas.ANOMALY, "Anomaly"))["fields"]}
    assert anomaly["anomaly_type"]["type"]["symbols"] == list(schemas.ANOMALY_TYPES)
    for fields in (trade, anomaly):
        assert all("default" in f for f in fields.values() if isinstance(f["type"], list))


def test_registry_framing(spark):
    df = spark.createDataFrame([(b"\x02abc",), (b"",), (None,)], "body binary")
    framed = df.select(s.framed(F.col("body"), 258).alias("v"))
    assert [None if r.v is None else bytes(r.v) for r in framed.collect()] == [b"\x00\x00\x00\x01\x02\x02abc", b"\x00\x00\x00\x01\x02", None]
    assert [None if r.b is None else bytes(r.b) for r in framed.select(s.unframed(F.col("v")).alias("b")).collect()] == [b"\x02abc", b"", None]
    with pytest.raises(Exception, match="registry header"):
        df.limit(1).select(s.unframed(F.col("body"))).collect()


def test_a_micro_batch_of_a_large_log_has_files_for_many_cores():
    from tidemark.plans import streams

    assert streams._files(6_000_000) >= 8 and streams._files(36_000_000) >= 48 and streams._files(10) == 1

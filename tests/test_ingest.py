"""Raw frames of both exchanges to both topics in one pass."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidemark import schemas
from tidemark.operators import parse
from tidemark.sources import market, seed, streams as s
from tidemark.streaming import ingest

FRAMES = "exchange string, value string, ingest_time timestamp, kafka_offset bigint"


@pytest.fixture
def trades(make_trades):
    symbols, exchanges = ("BTC-USD", "ETH-USD", "DOGE-USD"), ("binance", "coinbase")
    return make_trades([
        (1700000040000 + 1000 * i, 100 + i, 1 + i % 4, symbols[i % 3], 25 * i, exchanges[i // 2 % 2]) for i in range(40)
    ])


def rows(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_one_pass_finds_what_the_single_parsers_find(trades):
    frames = market.exchange_frames(trades).cache()
    events = parse.events_of(frames).cache()
    of = lambda exchange: frames.filter(F.col("exchange") == exchange).drop("exchange")
    common = ["exchange", "ticker", "event_time", "ingest_time", "kafka_offset"]
    found = parse.binance_trades(of("binance")).unionByName(parse.coinbase_trades(of("coinbase")))
    columns = [*common, "trade_id", "price", "quantity", "side"]
    assert rows(events.filter("kind = 'trade'"), columns) == rows(found, columns) and found.count() == 40
    found = parse.binance_depth(of("binance")).unionByName(parse.coinbase_l2(of("coinbase")))
    columns = [*common, "first_update_id", "final_update_id", "bids", "asks"]
    assert rows(events.filter("kind = 'delta'"), columns) == rows(found, columns) and found.count() == 40
    assert events.filter("kind = 'unreadable'").count() == 4


ODD = [
    ("binance", None), ("binance", ""), ("binance", "not json"), ("coinbase", '{"channel":"market_trades","events":['),
    ("binance", '{"result":null,"id":1}'), ("binance", "{}"), ("coinbase", "{}"), ("coinbase", '{"channel":"subscriptions","events":[{"subscriptions":{}}]}'),
    ("coinbase", '{"channel":"market_trades"}'), ("coinbase", '{"channel":"market_trades","events":[{"type":"update"}]}'),
    ("coinbase", '{"channel":"l2_data","events":[{"type":"snapshot","product_id":"BTC-USD","updates":[]}]}'),
    ("kraken", '{"data":{"e":"trade"}}'), (None, '{"channel":"l2_data"}'),
]


def test_odd_frames(spark):
    frames = spark.createDataFrame([(e, v, at(0), i) for i, (e, v) in enumerate(ODD)], FRAMES)
    assert [(r.kind, r.kafka_offset) for r in parse.events_of(frames).orderBy("kafka_offset").collect()] == [("unreadable", i) for i in range(4)]
    order_ids = '{"data":{"e":"trade","E":1,"s":"BTCUSDT","t":7,"p":"1.5","q":"2","T":3,"m":true,"b":88,"a":50}}'
    row, = parse.events_of(spark.createDataFrame([("binance", order_ids, at(5), 0)], FRAMES)).collect()
    assert (row.kind, row.trade_id, row.price, row.side) == ("trade", "7", 1.5, "SELL")
    bare = '{"channel":"l2_data","events":[{"type":"update","product_id":"BTC-USD","updates":[{"side":"x","price_level":"a","new_quantity":"1"}]}]}'
    row, = parse.events_of(spark.createDataFrame([("coinbase", bare, at(5), 0)], FRAMES)).collect()
    assert (row.first_update_id, row.event_time.timestamp(), row.bids, [tuple(a) for a in row.asks]) == (0, 0.005, [], [(None, 1.0)])


def test_both_topics_and_the_counts_over_a_restart(spark, trades, tmp_path):
    base = str(tmp_path)
    frames = market.exchange_frames(trades).cache()
    listed = seed.read_symbol_seed(spark).filter("canonical != 'DOGE-USD'")
    counts = ingest.IngestCounts()
    spark.streams.addListener(counts)

    def run(low, high):
        frames.filter(F.col("kafka_offset").between(low, high)).repartition(2).write.mode("append").parquet(f"{base}/frames")
        stream = spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(f"{base}/frames")
        query = ingest.start_ingest(stream, listed, ["BTC-USD", "ETH-USD"], f"{base}/out", f"{base}/ck", bounded=True)
        query.awaitTermination()
        return {(r.metric, r.exchange, r.label): r.n for r in counts.table(spark, query).collect()}

    try:
        first, second = run(0, 24), run(25, 39)
    finally:
        spark.streams.removeListener(counts)
    summed = {k: first.get(k, 0) + second.get(k, 0) for k in first | second}
    known = trades.filter("symbol != 'DOGE-USD'")
    want = {(kind, r.exchange, r.symbol): r["count"] for kind in ("trades", "deltas") for r in known.groupBy("exchange", "symbol").count().collect()}
    unknown = {r.exchange: r["count"] for r in trades.filter("symbol = 'DOGE-USD'").groupBy("exchange").count().collect()}
    broken = {r.exchange: r["count"] for r in trades.filter("kafka_offset % 10 = 2").groupBy("exchange").count().collect()}
    want |= {("dropped", e, "unknown_symbol"): 2 * n for e, n in unknown.items()} | {("dropped", e, "unreadable"): n for e, n in broken.items()}
    assert summed == want
    stored = s.trades_of(ingest.read_topic(spark, f"{base}/out", schemas.TRADES_TOPIC))
    columns = ["trade_id", "exchange", "symbol", "price", "quantity", "event_time", "ingest_time", "kafka_offset"]
    assert rows(stored, columns) == rows(known, columns)
    deltas = ingest.read_topic(spark, f"{base}/out", schemas.ORDERBOOK_TOPIC)
    assert deltas.count() == known.count() and deltas.filter(s.decode_plain_key(F.col("key")) != F.col("value.symbol")).isEmpty()


def test_frames_come_from_one_numbering_of_the_trades(trades, tmp_path):
    """Trades are read for the segments' counts and for the rows, not for each kind of frame again."""
    trades.write.parquet(str(tmp_path / "trades"))
    stored = trades.sparkSession.read.parquet(str(tmp_path / "trades"))
    plan = market.exchange_frames(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    frames = market.exchange_frames(stored)
    assert frames.groupBy("exchange").count().count() == 2 and frames.count() == 40 * 2 + 12

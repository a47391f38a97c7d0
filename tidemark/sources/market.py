"""Market tables derived from the test tables: trades, order-book deltas and raw exchange frames.

All but the order-book sequence are plain projections of ``events``, so column pruning reaches the
Parquet scan. Filters on derived columns such as ``event_time`` do not; ``trades_since`` filters the
stored time instead.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.segments import row_number_by_segment, sequence_segment

# Schemas of the test tables read here: with them a read starts no job to look at the files.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
PAGES = "page_id bigint, url string, html string"

# Which symbol each event type stands for; any other type is DOGE-USD.
SYMBOL_OF_EVENT = {"click": "BTC-USD", "view": "ETH-USD", "purchase": "SOL-USD", "signup": "XRP-USD"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def as_trades(events: DataFrame) -> DataFrame:
    """Events as trades; works on a stream too."""
    symbol = F.lit("DOGE-USD")
    for event_type, canonical in SYMBOL_OF_EVENT.items():
        symbol = F.when(F.col("event_type") == event_type, canonical).otherwise(symbol)
    k = F.col("k")
    event_time = F.date_trunc("millisecond", "ts").cast("timestamp")
    # As a generator the JSON is parsed once a row, however often later filters look at k.
    parsed = events.select(
        "event_id", "ts", "user_id", "event_type", "value", F.inline(F.array(F.from_json("props", "k int")))
    )
    return parsed.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.when(F.col("user_id") % 2 == 0, "binance").otherwise("coinbase").alias("exchange"),
        symbol.alias("symbol"),
        F.col("value").alias("price"),
        (k + 1).cast("double").alias("quantity"),
        F.when(F.col("event_id") % 3 == 0, "BUY")
        .when(F.col("event_id") % 3 == 1, "SELL")
        .otherwise("UNKNOWN")
        .alias("side"),
        event_time.alias("event_time"),
        (event_time + F.make_dt_interval(secs=k * F.lit(0.150).cast("decimal(18,6)"))).alias("ingest_time"),
        F.col("event_id").alias("kafka_offset"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(events(spark, sf_dir))


def newest_time(spark: SparkSession, sf_dir: str) -> datetime:
    """Time of the newest trade, in UTC without a zone, in whole milliseconds."""
    newest = events(spark, sf_dir).agg(F.max("ts")).first()[0]
    return newest.replace(microsecond=newest.microsecond // 1000 * 1000)


def trades_since(spark: SparkSession, sf_dir: str, start: datetime) -> DataFrame:
    """Trades at or after ``start``, a whole millisecond; the filter reaches the scan."""
    return as_trades(events(spark, sf_dir).filter(F.col("ts") >= F.lit(start.isoformat(" ")).cast("timestamp_ntz")))


def _with_books(trades: DataFrame) -> DataFrame:
    """Trades with the delta of each: ids in sequence per book, with planted overlaps and 4-id gaps, and one level a side."""
    numbered = row_number_by_segment(
        trades, ["exchange", "symbol"], "kafka_offset", sequence_segment("kafka_offset"), "seq"
    )
    shift = (
        F.when(F.col("kafka_offset") % 11 == 0, -3).when(F.col("kafka_offset") % 7 == 0, 4).otherwise(0)
    )
    level = lambda factor: F.array(
        F.struct((F.col("price") * factor).alias("price"), F.col("quantity").alias("quantity"))
    )
    return numbered.select(
        *trades.columns,
        (10 * F.col("seq") + shift).alias("first_update_id"),
        (10 * F.col("seq") + 9).alias("final_update_id"),
        level(0.999).alias("bids"),
        level(1.001).alias("asks"),
    )


def orderbook_deltas(trades: DataFrame) -> DataFrame:
    """A delta per trade with ids in sequence per book, with planted overlaps and 4-id gaps."""
    return _with_books(trades).select(
        "exchange", "symbol", "first_update_id", "final_update_id", "bids", "asks", "event_time", "ingest_time", "kafka_offset"
    )


def _binance_ticker() -> F.Column:
    return F.concat(F.split_part("symbol", F.lit("-"), F.lit(1)), F.lit("USDT"))


def _binance_body(channel: str, data: F.Column) -> F.Column:
    return F.to_json(F.struct(F.concat(F.lower(_binance_ticker()), F.lit(f"@{channel}")).alias("stream"), data.alias("data")))


def _binance_trade() -> F.Column:
    return _binance_body("trade", F.struct(
        F.lit("trade").alias("e"),
        F.unix_millis("event_time").alias("E"),
        _binance_ticker().alias("s"),
        F.col("trade_id").cast("long").alias("t"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.unix_millis("event_time").alias("T"),
        (F.col("side") == "SELL").alias("m"),
    ))


def _binance_depth() -> F.Column:
    pairs = lambda name: F.transform(
        name, lambda x: F.array(x["price"].cast("string"), x["quantity"].cast("string"))
    )
    return _binance_body("depth", F.struct(
        F.lit("depthUpdate").alias("e"),
        F.unix_millis("event_time").alias("E"),
        _binance_ticker().alias("s"),
        F.col("first_update_id").alias("U"),
        F.col("final_update_id").alias("u"),
        pairs("bids").alias("b"),
        pairs("asks").alias("a"),
    ))


def _iso_millis(name: str) -> F.Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _coinbase_trade() -> F.Column:
    trade = F.struct(
        "trade_id",
        F.col("symbol").alias("product_id"),
        F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("size"),
        F.lower("side").alias("side"),
        _iso_millis("event_time").alias("time"),
    )
    return F.to_json(F.struct(
        F.lit("market_trades").alias("channel"),
        F.col("kafka_offset").alias("sequence_num"),
        F.array(F.struct(F.lit("update").alias("type"), F.array(trade).alias("trades"))).alias("events"),
    ))


def _coinbase_l2() -> F.Column:
    side = lambda name, label: F.transform(
        name,
        lambda x: F.struct(
            F.lit(label).alias("side"),
            x["price"].cast("string").alias("price_level"),
            x["quantity"].cast("string").alias("new_quantity"),
        ),
    )
    event = F.struct(
        F.lit("update").alias("type"),
        F.col("symbol").alias("product_id"),
        F.concat(side("bids", "bid"), side("asks", "offer")).alias("updates"),
    )
    return F.to_json(F.struct(
        F.lit("l2_data").alias("channel"),
        F.col("final_update_id").alias("sequence_num"),
        _iso_millis("event_time").alias("timestamp"),
        F.array(event).alias("events"),
    ))


def _neither() -> F.Column:
    """For every tenth offset a frame that is no event: an acknowledgement, a heartbeat, a snapshot, a broken line."""
    return F.when(F.col("kafka_offset") % 10 == 0, F.when(F.col("exchange") == "binance", '{"result":null,"id":1}').otherwise(
        '{"channel":"heartbeats","sequence_num":7,"events":[{"current_time":"now","heartbeat_counter":"3"}]}')).when(
        F.col("kafka_offset") % 10 == 1, F.when(F.col("exchange") == "coinbase", F.concat(
            F.lit('{"channel":"market_trades","events":[{"type":"snapshot","trades":[{"trade_id":"0","product_id":"'), "symbol",
            F.lit('","price":"1","size":"1","side":"BUY","time":"2024-01-01T00:00:00Z"}]}]}'))).otherwise('{"data":{"e":"kline"}}')).when(
        F.col("kafka_offset") % 10 == 2, F.concat(F.lit('{"data":{"e":"trade","s":"'), "symbol"))


def _frames(rows: DataFrame, exchange: str, body: F.Column) -> DataFrame:
    return rows.filter(F.col("exchange") == exchange).select(body.alias("value"), "ingest_time", "kafka_offset")


def binance_trade_frames(trades: DataFrame) -> DataFrame:
    """Binance trades as combined-stream frames (value, ingest_time, kafka_offset)."""
    return _frames(trades, "binance", _binance_trade())


def binance_depth_frames(deltas: DataFrame) -> DataFrame:
    return _frames(deltas, "binance", _binance_depth())


def coinbase_trade_frames(trades: DataFrame) -> DataFrame:
    return _frames(trades, "coinbase", _coinbase_trade())


def coinbase_l2_frames(deltas: DataFrame) -> DataFrame:
    return _frames(deltas, "coinbase", _coinbase_l2())


def exchange_frames(trades: DataFrame) -> DataFrame:
    """What two connections receive (value, ingest_time, kafka_offset, exchange): trades and deltas of the trades, and for
    every tenth offset something that is neither: an acknowledgement, a heartbeat, a snapshot, a broken line.

    The trades are numbered once, and all frames of a trade are made where it then lies.
    """
    made = F.when(F.col("exchange") == "binance", F.array(_binance_trade(), _binance_depth(), _neither())).when(
        F.col("exchange") == "coinbase", F.array(_coinbase_trade(), _coinbase_l2(), _neither())).otherwise(F.array(_neither()))
    frames = _with_books(trades).select(F.explode(made).alias("value"), "ingest_time", "kafka_offset", "exchange")
    return frames.filter("value IS NOT NULL")


ITEMS_PER_FEED = 50


def headline_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as RSS documents (asset, feed_seq, doc): an item per page title, a document per
    asset and 50 consecutive page ids. The asset follows from the page's language."""
    lang = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    asset = F.when(lang == "en", "BTC").when(lang == "fr", "ETH").when(lang == "de", "SOL").otherwise("XRP")
    items = spark.read.schema(PAGES).parquet(f"{sf_dir}/pages.parquet").select(
        asset.alias("asset"),
        F.floor(F.col("page_id") / ITEMS_PER_FEED).alias("feed_seq"),
        F.struct("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title")).alias("item"),
    )
    documents = items.groupBy("asset", "feed_seq").agg(F.sort_array(F.collect_list("item")).alias("items"))
    body = F.array_join(
        F.transform("items", lambda i: F.concat(F.lit("<item><title>"), i["title"], F.lit("</title></item>"))), ""
    )
    return documents.select(
        "asset", "feed_seq", F.concat(F.lit("<rss><channel>"), body, F.lit("</channel></rss>")).alias("doc")
    )

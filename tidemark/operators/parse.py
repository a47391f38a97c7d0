"""Raw exchange frames to normalised trades and order-book deltas.

Input frames carry ``value`` (JSON text), ``ingest_time`` and optionally ``kafka_offset``.
Parsers first yield every event with its exchange ticker; ``resolve`` adds the canonical symbol
and ``known`` / ``dropped`` split off tickers outside the seed. All of it also runs on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sources.seed import resolve_canonical

# The frame's keys differ only by case (e/E, t/T, u/U), which a struct cannot be asked for by
# name; the cast, by position, gives them names that differ.
_BINANCE_WIRE = (
    "data struct<e:string, E:bigint, s:string, t:string, p:string, q:string, T:bigint, m:boolean, "
    "U:bigint, u:bigint, b:array<array<string>>, a:array<array<string>>>"
)
_BINANCE_NAMED = (
    "struct<kind:string, event_ms:bigint, ticker:string, trade_id:string, price:string, quantity:string, "
    "trade_ms:bigint, buyer_is_maker:boolean, first_id:bigint, final_id:bigint, "
    "bids:array<array<string>>, asks:array<array<string>>>"
)
_COINBASE_TRADES = (
    "channel string, events array<struct<type:string, trades:array<struct<trade_id:string, "
    "product_id:string, price:string, size:string, side:string, time:string>>>>"
)
_COINBASE_L2 = (
    "channel string, sequence_num bigint, timestamp string, events array<struct<type:string, "
    "product_id:string, updates:array<struct<side:string, price_level:string, new_quantity:string>>>>"
)

TRADE_COLUMNS = (
    "trade_id", "exchange", "symbol", "price", "quantity", "side", "event_time", "ingest_time",
)
DELTA_COLUMNS = (
    "exchange", "symbol", "first_update_id", "final_update_id", "bids", "asks", "event_time", "ingest_time",
)


def iso_to_timestamp(text: Column | str) -> Column:
    """ISO-8601 text as a timestamp cut to milliseconds; null if it is not one."""
    return F.date_trunc("millisecond", F.try_to_timestamp(text))


def iso_to_ms(text: Column | str) -> Column:
    return F.unix_millis(F.try_to_timestamp(text))


def _double(name: str) -> Column:
    return F.col(name).try_cast("double")


def _extra(frames: DataFrame) -> list[str]:
    return [c for c in frames.columns if c not in ("value", "exchange")]


def _parsed(frames: DataFrame, parsed: Column) -> DataFrame:
    """The fields of a parsed struct as columns.

    A generator, not a projection: Catalyst would copy the parse into every later filter on it.
    """
    return frames.select(*_extra(frames), F.inline(F.array(parsed)))


def _binance(frames: DataFrame, kind: str) -> DataFrame:
    data = F.from_json("value", _BINANCE_WIRE)["data"].cast(_BINANCE_NAMED)
    return _parsed(frames, data).filter(F.col("kind") == kind).withColumn("exchange", F.lit("binance"))


def binance_trades(frames: DataFrame) -> DataFrame:
    """Trades of combined-stream frames; a buyer that is the maker means the seller was active."""
    return _binance(frames, "trade").select(
        *_extra(frames),
        "exchange",
        "ticker",
        "trade_id",
        _double("price").alias("price"),
        _double("quantity").alias("quantity"),
        F.when(F.col("buyer_is_maker"), "SELL").otherwise("BUY").alias("side"),
        F.timestamp_millis("trade_ms").alias("event_time"),
    )


def _pairs(name: str) -> Column:
    return F.transform(
        F.coalesce(F.col(name), F.array()),
        lambda pair: F.struct(
            F.get(pair, 0).try_cast("double").alias("price"),
            F.get(pair, 1).try_cast("double").alias("quantity"),
        ),
    )


def binance_depth(frames: DataFrame) -> DataFrame:
    return _binance(frames, "depthUpdate").select(
        *_extra(frames),
        "exchange",
        "ticker",
        F.col("first_id").alias("first_update_id"),
        F.col("final_id").alias("final_update_id"),
        _pairs("bids").alias("bids"),
        _pairs("asks").alias("asks"),
        F.timestamp_millis("event_ms").alias("event_time"),
    )


def _coinbase(frames: DataFrame, wire: str, channel: str) -> DataFrame:
    """One row per event of the channel, snapshots left out."""
    return (
        _parsed(frames, F.from_json("value", wire))
        .filter(F.col("channel") == channel)
        .withColumn("event", F.explode("events"))
        .filter(~F.col("event.type").eqNullSafe("snapshot"))
    )


def coinbase_trades(frames: DataFrame) -> DataFrame:
    side = F.upper("trade.side")
    return (
        _coinbase(frames, _COINBASE_TRADES, "market_trades")
        .select(*_extra(frames), F.explode("event.trades").alias("trade"))
        .select(
            *_extra(frames),
            F.lit("coinbase").alias("exchange"),
            F.col("trade.product_id").alias("ticker"),
            "trade.trade_id",
            _double("trade.price").alias("price"),
            _double("trade.size").alias("quantity"),
            F.when(side.isin("BUY", "SELL"), side).otherwise("UNKNOWN").alias("side"),
            iso_to_timestamp("trade.time").alias("event_time"),
        )
    )


def coinbase_l2(frames: DataFrame) -> DataFrame:
    def levels(keep) -> Column:
        return F.transform(
            F.filter(F.coalesce(F.col("event.updates"), F.array()), keep),
            lambda u: F.struct(
                u["price_level"].try_cast("double").alias("price"),
                u["new_quantity"].try_cast("double").alias("quantity"),
            ),
        )

    sequence = F.coalesce("sequence_num", F.lit(0))
    return _coinbase(frames, _COINBASE_L2, "l2_data").select(
        *_extra(frames),
        F.lit("coinbase").alias("exchange"),
        F.col("event.product_id").alias("ticker"),
        sequence.alias("first_update_id"),
        sequence.alias("final_update_id"),
        levels(lambda u: u["side"] == "bid").alias("bids"),
        levels(lambda u: ~u["side"].eqNullSafe("bid")).alias("asks"),
        F.coalesce(iso_to_timestamp("timestamp"), F.col("ingest_time")).alias("event_time"),
    )


def resolve(events: DataFrame, seed: DataFrame) -> DataFrame:
    return resolve_canonical(events, seed)


def _contract(resolved: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    extra = ["kafka_offset"] if "kafka_offset" in resolved.columns else []
    return resolved.filter(F.col("symbol").isNotNull()).select(*columns, *extra)


def known_trades(resolved: DataFrame) -> DataFrame:
    return _contract(resolved, TRADE_COLUMNS)


def known_deltas(resolved: DataFrame) -> DataFrame:
    return _contract(resolved, DELTA_COLUMNS)


def dropped_counts(resolved: DataFrame) -> DataFrame:
    """Events outside the seed per (exchange, reason)."""
    return (
        resolved.filter(F.col("symbol").isNull())
        .groupBy("exchange", F.lit("unknown_symbol").alias("reason"))
        .agg(F.count(F.lit(1)).alias("dropped"))
    )


# --- all kinds in one pass ----------------------------------------------------------------------

_COINBASE = (
    "channel string, sequence_num bigint, timestamp string, events array<struct<type:string, product_id:string, "
    "trades:array<struct<trade_id:string, product_id:string, price:string, size:string, side:string, time:string>>, "
    "updates:array<struct<side:string, price_level:string, new_quantity:string>>>>"
)
_LEVELS = "array<struct<price:double,quantity:double>>"
_EVENT = {
    "kind": "string", "ticker": "string", "trade_id": "string", "price": "double", "quantity": "double", "side": "string",
    "first_update_id": "bigint", "final_update_id": "bigint", "bids": _LEVELS, "asks": _LEVELS, "event_time": "timestamp",
}
TRADE_EVENT, DELTA_EVENT, UNREADABLE = "trade", "delta", "unreadable"


def _event(kind: str, **fields: Column) -> Column:
    """An event of any kind; fields that the kind does not have are null."""
    given = {"kind": F.lit(kind), **fields}
    return F.struct(*[given.get(name, F.lit(None)).cast(dtype).alias(name) for name, dtype in _EVENT.items()])


def _levels_of(items: Column, price, quantity) -> Column:
    return F.transform(F.coalesce(items, F.array()), lambda x: F.struct(
        price(x).try_cast("double").alias("price"), quantity(x).try_cast("double").alias("quantity")
    ))


def _binance_events(b: Column) -> Column:
    pairs = lambda side: _levels_of(b[side], lambda x: F.get(x, 0), lambda x: F.get(x, 1))
    trade = _event(
        TRADE_EVENT, ticker=b["ticker"], trade_id=b["trade_id"], price=b["price"].try_cast("double"),
        quantity=b["quantity"].try_cast("double"), side=F.when(b["buyer_is_maker"], "SELL").otherwise("BUY"),
        event_time=F.timestamp_millis(b["trade_ms"]),
    )
    delta = _event(
        DELTA_EVENT, ticker=b["ticker"], first_update_id=b["first_id"], final_update_id=b["final_id"],
        bids=pairs("bids"), asks=pairs("asks"), event_time=F.timestamp_millis(b["event_ms"]),
    )
    return F.when(b["kind"] == "trade", F.array(trade)).when(b["kind"] == "depthUpdate", F.array(delta))


def _coinbase_events(c: Column, ingest_time: Column) -> Column:
    def trade(t: Column) -> Column:
        side = F.upper(t["side"])
        return _event(
            TRADE_EVENT, ticker=t["product_id"], trade_id=t["trade_id"], price=t["price"].try_cast("double"),
            quantity=t["size"].try_cast("double"), side=F.when(side.isin("BUY", "SELL"), side).otherwise("UNKNOWN"),
            event_time=iso_to_timestamp(t["time"]),
        )

    def delta(e: Column) -> Column:
        def levels(keep) -> Column:
            kept = F.filter(F.coalesce(e["updates"], F.array()), keep)
            return _levels_of(kept, lambda u: u["price_level"], lambda u: u["new_quantity"])

        sequence = F.coalesce(c["sequence_num"], F.lit(0))
        return _event(
            DELTA_EVENT, ticker=e["product_id"], first_update_id=sequence, final_update_id=sequence,
            bids=levels(lambda u: u["side"] == "bid"), asks=levels(lambda u: ~u["side"].eqNullSafe("bid")),
            event_time=F.coalesce(iso_to_timestamp(c["timestamp"]), ingest_time),
        )

    news = F.filter(F.coalesce(c["events"], F.array()), lambda e: ~e["type"].eqNullSafe("snapshot"))
    trades = F.flatten(F.transform(news, lambda e: F.transform(F.coalesce(e["trades"], F.array()), trade)))
    return F.when(c["channel"] == "market_trades", trades).when(c["channel"] == "l2_data", F.transform(news, delta))


def events_of(frames: DataFrame) -> DataFrame:
    """Every event of frames (exchange, value, ingest_time, ...) of both exchanges, each frame read and parsed once.

    ``kind`` tells trades from deltas; the fields of the other kind are null. Acknowledgements, heartbeats, other
    channels and snapshots give no row. A frame that is no JSON object gives one of kind ``unreadable``.
    """
    spoiled = {"columnNameOfCorruptRecord": "spoiled"}
    binance = F.from_json("value", f"{_BINANCE_WIRE}, spoiled string", spoiled)
    coinbase = F.from_json("value", f"{_COINBASE}, spoiled string", spoiled)
    parsed = frames.select("*", F.inline(F.array(F.struct(
        F.when(F.col("exchange") == "binance", binance).alias("_binance"),
        F.when(F.col("exchange") == "coinbase", coinbase).alias("_coinbase"),
    )))).select(
        "*", F.inline(F.array(F.struct(F.col("_binance.data").cast(_BINANCE_NAMED).alias("_data")))),
    )
    # A field of another type spoils no frame whose event was found: other kinds use the same short names.
    broken = F.when(F.col("exchange") == "binance", F.col("_binance.spoiled").isNotNull() & F.col("_data.kind").isNull()).when(
        F.col("exchange") == "coinbase", F.col("_coinbase.spoiled").isNotNull() & F.col("_coinbase.events").isNull()
    )
    unreadable = F.col("value").isNull() | (F.trim("value") == "") | F.coalesce(broken, F.lit(False))
    none = F.array().cast("array<struct<" + ",".join(f"{n}:{t}" for n, t in _EVENT.items()) + ">>")
    events = F.when(unreadable, F.array(_event(UNREADABLE))).otherwise(F.coalesce(
        _binance_events(F.col("_data")), _coinbase_events(F.col("_coinbase"), F.col("ingest_time")), none
    ))
    return parsed.select(*[c for c in frames.columns if c != "value"], F.inline(events))

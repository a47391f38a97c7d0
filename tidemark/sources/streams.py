"""Event logs as streams: decoding of keys and values, replay positions.

A log record is (key, value, topic, partition, offset, timestamp), with the value already a
struct of the contract. Kafka and folders of log files give the same frame.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas

CANDLE_TOPICS = tuple(i.topic for i in schemas.INTERVALS.values())
LIVE_BATCH_RECORDS = 500
_REGISTRY_HEADER_BYTES = 5  # magic byte and schema id in front of the Avro body


def log_schema(value: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("key", T.BinaryType()),
        T.StructField("value", value),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ])


# --- keys -------------------------------------------------------------------------------------

def decode_plain_key(key: Column) -> Column:
    return F.decode(key, "UTF-8")


def encode_windowed_key(symbol: Column, window_start: Column) -> Column:
    """Symbol followed by the window start as 8 bytes, most significant first."""
    start = F.unhex(F.lpad(F.hex(F.unix_millis(window_start)), 16, "0"))
    return F.concat(F.encode(symbol, "UTF-8"), start)


def decode_windowed_key(key: Column) -> Column:
    """Symbol of a windowed key; null for a null key, an error if the key is too short."""
    symbol = F.decode(F.substring(key, F.lit(1), F.length(key) - 8), "UTF-8")
    return (
        F.when(key.isNull(), F.lit(None).cast("string"))
        .when(F.length(key) <= 8, F.raise_error(F.lit("windowed key of 8 bytes or less")).cast("string"))
        .otherwise(symbol)
    )


def windowed_key_start(key: Column) -> Column:
    digits = F.hex(F.substring(key, F.length(key) - 7, F.lit(8)))
    return F.timestamp_millis(F.conv(digits, 16, 10).cast("bigint"))


# --- logs -------------------------------------------------------------------------------------

def file_log(spark: SparkSession, path: str, value: T.StructType, max_files: int | None = None) -> DataFrame:
    """Stream over a folder of Parquet log files, ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(log_schema(value))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


#: Fields that are enums on the wire, with their symbols in order.
ENUMS = {"side": ("Side", schemas.SIDES), "anomaly_type": ("AnomalyType", schemas.ANOMALY_TYPES)}


def avro_schema(value: T.StructType, name: str) -> str:
    """The contract as Avro JSON: instants are milliseconds, enums have their symbols, defaults are kept.

    A field that may be null and has no other default has null.
    """
    simple = {
        "string": "string", "double": "double", "bigint": "long", "int": "int", "boolean": "boolean",
        "timestamp": {"type": "long", "logicalType": "timestamp-millis"},
    }

    def of(dtype: T.DataType, path: str):
        if isinstance(dtype, T.ArrayType):
            return {"type": "array", "items": of(dtype.elementType, path)}
        if isinstance(dtype, T.StructType):
            return record(dtype, path)
        return simple[dtype.simpleString()]

    def record(struct: T.StructType, path: str) -> dict:
        fields = []
        for f in struct.fields:
            inner = of(f.dataType, f"{path}_{f.name}")
            if f.name in ENUMS and f.dataType == T.StringType():
                kind, symbols = ENUMS[f.name]
                inner = {"type": "enum", "name": kind, "symbols": list(symbols)}
            default = f.metadata.get("default")
            order = [inner, "null"] if default is not None else ["null", inner]  # a default has the first type of a union
            field = {"name": f.name, "type": order if f.nullable else inner}
            if "default" in f.metadata or f.nullable:
                field["default"] = default
            fields.append(field)
        return {"type": "record", "name": path, "fields": fields}

    return json.dumps(record(value, name))


def kafka_options(
    servers: str,
    topics: Sequence[str],
    *,
    starting: str = "earliest",
    from_timestamp: datetime | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Reader options. From a timestamp, a partition without such a record is not read again.

    ``max_offsets`` bounds a micro-batch, for a live sink say LIVE_BATCH_RECORDS; a replay of
    a long log leaves it open or sets it by what the executors hold.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "failOnDataLoss": "true",
        "startingOffsets": starting,
    }
    if from_timestamp is not None:
        options["startingTimestamp"] = str(int(from_timestamp.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def framed(body: Column, schema_id: int) -> Column:
    """An Avro body behind the registry's header: a zero byte and the schema id in four bytes."""
    return F.concat(F.unhex(F.lit(f"00{schema_id:08X}")), body)


def unframed(value: Column) -> Column:
    """The body behind the header; an error if there is none. Null stays null."""
    headed = (F.length(value) >= _REGISTRY_HEADER_BYTES) & (F.hex(F.substring(value, 1, 1)) == "00")
    body = F.substring(value, F.lit(_REGISTRY_HEADER_BYTES + 1), F.length(value) - _REGISTRY_HEADER_BYTES)
    return F.when(value.isNull(), None).when(headed, body).otherwise(
        F.raise_error(F.lit("a value without a registry header")).cast("binary")
    )


def kafka_log(
    spark: SparkSession, options: dict[str, str], value: T.StructType, name: str, registry: bool = True
) -> DataFrame:
    """Stream over Kafka topics with Avro values, behind registry headers or bare; needs the Kafka and Avro packages."""
    from pyspark.sql.avro.functions import from_avro

    raw = spark.readStream.format("kafka").options(**options).load()
    body = unframed(F.col("value")) if registry else F.col("value")
    return raw.withColumn("value", from_avro(body, avro_schema(value, name)))


_POSITION = ("topic", "partition")


def trades_of(log: DataFrame) -> DataFrame:
    """Trade rows of ``trades.raw`` with their log position."""
    return log.select("value.*", *_POSITION, F.col("offset").alias("kafka_offset"))


def candles_of(log: DataFrame) -> DataFrame:
    """Candle rows of the three candle topics; the symbol comes from the key, which must be there."""
    symbol = F.when(
        F.col("key").isNull(), F.raise_error(F.lit("candle record without a key")).cast("string")
    ).otherwise(decode_windowed_key(F.col("key")))
    return log.select(symbol.alias("symbol"), "value.*", *_POSITION, F.col("offset").alias("kafka_offset"))


def seek_offsets(records: DataFrame, start: datetime) -> DataFrame:
    """(topic, partition, start_offset): the least offset of each partition that was logged at or after ``start``.

    Null where a partition has no such record. Log times need not rise with the offset; a seek finds the first record
    that reaches the instant, and all that stands behind it belongs to the replay, whatever its own time.
    """
    reached = F.when(F.col("timestamp") >= F.lit(start), F.col("offset"))
    return records.groupBy(*_POSITION).agg(F.min(reached).alias("start_offset"))


def log_ends(records: DataFrame) -> DataFrame:
    """(topic, partition, start_offset): the offset behind the last record of each partition, where what comes next begins."""
    return records.groupBy(*_POSITION).agg((F.max("offset") + 1).alias("start_offset"))


def from_offsets(log: DataFrame, starts: DataFrame, beyond: str = "skip") -> DataFrame:
    """Records from each partition's start offset on; ``starts`` has a row for each partition, so it is small.

    A partition without a start offset yields nothing (``skip``) or is read from its beginning (``beginning``): an
    idempotent sink comes to the same state by both.
    """
    if beyond not in ("skip", "beginning"):
        raise ValueError(f"unknown choice {beyond!r} for partitions without a start, expected skip or beginning")
    joined = log.join(starts, list(_POSITION), "inner" if beyond == "skip" else "left")
    start = F.col("start_offset") if beyond == "skip" else F.coalesce("start_offset", F.lit(0))
    return joined.filter(F.col("offset") >= start).select(*log.columns)


# --- records for the sinks ----------------------------------------------------------------------

def trade_records(trades: DataFrame, topic: str = schemas.TRADES_TOPIC) -> DataFrame:
    """Trades as log records keyed by symbol: what a Kafka sink or a file log is given."""
    return _records(trades, F.encode("symbol", "UTF-8"), schemas.TRADE, F.lit(topic), "ingest_time")


def delta_records(deltas: DataFrame) -> DataFrame:
    return _records(
        deltas, F.encode("symbol", "UTF-8"), schemas.ORDERBOOK_DELTA, F.lit(schemas.ORDERBOOK_TOPIC), "ingest_time"
    )


def candle_records(candles: DataFrame) -> DataFrame:
    topics = F.create_map(*[F.lit(x) for name, i in schemas.INTERVALS.items() for x in (name, i.topic)])
    key = encode_windowed_key(F.col("symbol"), F.col("window_start"))
    return _records(candles, key, schemas.CANDLE, topics[F.col("interval")], "window_end")


def anomaly_records(anomalies: DataFrame) -> DataFrame:
    return _records(
        anomalies, F.encode("symbol", "UTF-8"), schemas.ANOMALY, F.lit(schemas.ANOMALY_TOPIC), "detected_at"
    )


def _records(rows: DataFrame, key: Column, value: T.StructType, topic: Column, time: str) -> DataFrame:
    offset = F.col("kafka_offset") if "kafka_offset" in rows.columns else F.lit(None).cast("bigint")
    return rows.select(
        key.alias("key"),
        F.struct(*value.fieldNames()).alias("value"),
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        F.col(time).alias("timestamp"),
    )

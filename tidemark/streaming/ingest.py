"""Raw exchange frames to the logs of trades and of order-book deltas, in one running query.

Each frame is read and parsed once. One file sink takes the records of both topics, in a folder for each, so a
micro-batch is in both or in neither. What was kept and dropped is counted while it passes (``observe``) and summed by
a listener, without another look at the data.
"""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark import schemas
from tidemark.operators import parse
from tidemark.streaming.jobs import start_partitioned

#: Name of the counts in a query's progress.
COUNTS = "ingest"
COUNT_COLUMNS = "metric string, exchange string, label string, n bigint"
_DROPPED = ("unknown_symbol", "unreadable")


def normalised(frames: DataFrame, seed: DataFrame) -> DataFrame:
    """Events of both kinds with their canonical ``symbol``; ``dropped`` says why one has none."""
    events = parse.resolve(parse.events_of(frames), seed)
    reason = F.when(F.col("kind") == parse.UNREADABLE, "unreadable").when(F.col("symbol").isNull(), "unknown_symbol")
    return events.withColumn("dropped", reason)


def counted(events: DataFrame, symbols: Sequence[str], exchanges: Iterable[str] = schemas.EXCHANGES) -> DataFrame:
    """Counts trades and deltas per exchange and symbol, and drops per exchange and reason, as the rows pass.

    One counter for each combination: ``symbols`` are those of the seed, a small closed list.
    """
    def count(metric: str, exchange: str, label: str, which: Column) -> Column:
        return F.count_if(which & (F.col("exchange") == exchange)).alias(f"{metric}/{exchange}/{label}")

    kept = [
        count(f"{kind}s", exchange, symbol, (F.col("kind") == kind) & (F.col("symbol") == symbol))
        for kind in (parse.TRADE_EVENT, parse.DELTA_EVENT) for exchange in exchanges for symbol in symbols
    ]
    gone = [count("dropped", exchange, reason, F.col("dropped") == reason) for exchange in exchanges for reason in _DROPPED]
    return events.observe(COUNTS, *kept, *gone)


def _value(contract: T.StructType, kind: str) -> Column:
    return F.when(F.col("kind") == kind, F.struct(*contract.fieldNames()))


def records(events: DataFrame) -> DataFrame:
    """Log records of both topics, keyed by symbol: the value is ``trade`` or ``delta``, the other one is null."""
    is_trade = F.col("kind") == parse.TRADE_EVENT
    offset = F.col("kafka_offset") if "kafka_offset" in events.columns else F.lit(None).cast("bigint")
    return events.filter(F.col("dropped").isNull()).select(
        F.encode("symbol", "UTF-8").alias("key"),
        _value(schemas.TRADE, parse.TRADE_EVENT).alias("trade"), _value(schemas.ORDERBOOK_DELTA, parse.DELTA_EVENT).alias("delta"),
        F.lit(0).alias("partition"), offset.alias("offset"), F.col("ingest_time").alias("timestamp"),
        F.when(is_trade, schemas.TRADES_TOPIC).otherwise(schemas.ORDERBOOK_TOPIC).alias("topic"),
    )


def start_ingest(
    frames: DataFrame, seed: DataFrame, symbols: Sequence[str], out: str, checkpoint: str, bounded: bool = False
) -> StreamingQuery:
    """Frames (exchange, value, ingest_time, ...) into the logs under ``out``; ``read_topic`` reads one of them."""
    events = counted(normalised(frames, seed), symbols)
    return start_partitioned(records(events), ["topic"], out, checkpoint, bounded)


def read_topic(spark: SparkSession, out: str, topic: str) -> DataFrame:
    """The records of one topic (key, value, topic, partition, offset, timestamp); only its folder is read."""
    name, contract = {
        schemas.TRADES_TOPIC: ("trade", schemas.TRADE), schemas.ORDERBOOK_TOPIC: ("delta", schemas.ORDERBOOK_DELTA),
    }[topic]
    stored = T.StructType([
        T.StructField("key", T.BinaryType()), T.StructField(name, contract), T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()), T.StructField("topic", T.StringType()),
    ])
    rows = spark.read.schema(stored).parquet(out).filter(F.col("topic") == topic)
    return rows.withColumnRenamed(name, "value").select("key", "value", "topic", "partition", "offset", "timestamp")


class IngestCounts(StreamingQueryListener):
    """Sums the counts of every micro-batch, per run of a query. Add it to the session before the query starts."""

    def __init__(self) -> None:
        self._sums: dict[str, Counter] = defaultdict(Counter)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(COUNTS)
        if counts is not None:
            self._sums[str(event.progress.runId)].update({k: v for k, v in counts.asDict().items() if v})

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def table(self, spark: SparkSession, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """(metric, exchange, label, n) of a run, once it has ended; counters that stayed at 0 are left out."""
        run = str(query.runId)
        if not self._ended[run].wait(seconds):
            raise TimeoutError("the query has not ended")
        rows = [(*name.split("/", 2), n) for name, n in sorted(self._sums[run].items())]
        return spark.createDataFrame(rows, COUNT_COLUMNS)

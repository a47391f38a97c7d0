"""Streaming queries run to the end of the given tables, and the lake they feed."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.operators import backtest, candles as c, lake, metrics
from tidemark.plans import oracle as o
from tidemark.plans.core import VOLATILITY_SQL
from tidemark.plans.detection import (
    ANOMALY_OUTPUT, GAP_COLUMNS, GAPS_SQL, anomaly_ctes, comparable_anomalies,
)
from tidemark.plans.registry import query, settle, settle_sql
from tidemark.session import scratch_dir
from tidemark.sources import market
from tidemark.sources import seed, streams as s
from tidemark.streaming import candles as sc, ingest, jobs


LOG_FILES = 6
_LOGS: dict[tuple[str, str], list[DataFrame]] = {}


def _event_log(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The trades in LOG_FILES stretches of event time; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOGS:
        path = scratch_dir(spark, "stretches")
        trades = market.trades(spark, sf_dir)
        steps = [i / LOG_FILES for i in range(1, LOG_FILES)]
        cuts = trades.agg(F.percentile_approx(F.unix_millis("event_time"), steps, 10_000)).first()[0]
        stretch = sum((F.when(F.unix_millis("event_time") > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
        trades.withColumn("stretch", stretch).write.partitionBy("stretch").parquet(path)
        _LOGS[key] = [
            spark.read.schema(trades.schema).parquet(f"{path}/stretch={i}") for i in range(LOG_FILES)
        ]
    return _LOGS[key]


def _stragglers(log: list[DataFrame]) -> DataFrame:
    """Trades of the first stretch once more, under new ids and with other prices: far too late at the end."""
    return log[0].withColumns({
        "trade_id": F.concat(F.lit("late-"), "trade_id"), "price": F.col("price") * 7, "quantity": F.col("quantity") + 1000,
    })


#: Rows of a log file; a stretch is written as so many files that none has more. A file is the least that a task of a
#: micro-batch takes, so large files would leave cores idle.
ROWS_PER_FILE = 100_000


class _Log:
    """A folder of log files that grows. Each append is ``files`` files, which make a micro-batch."""

    def __init__(self, spark: SparkSession, label: str, schema, files: int = 1):
        self.spark, self.path, self.schema, self.files = spark, f"{scratch_dir(spark, label)}/log", schema, files

    def append(self, *rows: DataFrame) -> None:
        for part in rows:
            part.select(*self.schema.fieldNames()).repartition(self.files).write.mode("append").parquet(self.path)

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files).parquet(self.path)


def _files(rows: int) -> int:
    """Files of a stretch, if all rows are cut into LOG_FILES of them."""
    return max(1, -(-rows // (LOG_FILES * ROWS_PER_FILE)))


def _trade_log(spark: SparkSession, sf_dir: str, late: bool = False) -> _Log:
    log = _event_log(spark, sf_dir)
    out = _Log(spark, "trade-log", log[0].schema, _files(market.events(spark, sf_dir).count()))
    out.append(*log[:-1], *([_stragglers(log)] if late else []), log[-1])
    return out


def _trade_stream(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """The trades as a stream in order of event time, a file per micro-batch.

    With ``late`` the last file but one holds trades of windows that were sealed long before.
    """
    return _trade_log(spark, sf_dir, late).stream()


def _drained(stream: DataFrame, label: str, base: str | None = None) -> DataFrame:
    """Run a stream into files and read them back."""
    spark = stream.sparkSession
    base = base or scratch_dir(spark, label)
    jobs.start_files(stream, f"{base}/out", f"{base}/checkpoint", bounded=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _register_sealed(interval: str) -> None:
    @query(f"candles_{interval.lower()}_sealed_stream", f"""WITH {o.TRADES}, {o.candles(interval)}
SELECT {o.CANDLE_COLUMNS} FROM candles
WHERE window_end <= (SELECT max(event_time) FROM trades) - INTERVAL {o.GRACE[interval]}""")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Run, stopped half way, and run on from its checkpoint; late trades of sealed windows change nothing."""
        log = _event_log(spark, sf_dir)
        files = _Log(spark, f"sealed-{interval}", log[0].schema, _files(market.events(spark, sf_dir).count()))
        base = scratch_dir(spark, f"sealed-{interval}")
        files.append(*log[: LOG_FILES // 2])
        _drained(sc.sealed_candles(files.stream(), interval), "", base)
        files.append(*log[LOG_FILES // 2: -1], _stragglers(log), log[-1])
        rows = _drained(sc.sealed_candles(files.stream(), interval), "", base)
        return rows.withColumn("vwap", settle(F.col("vwap")))


for _interval in ("M1", "M5", "H1"):
    _register_sealed(_interval)


@query("sealed_candles_in_lake", f"""WITH {o.TRADES}, {o.candles('M1')}
SELECT {o.CANDLE_COLUMNS} FROM candles
WHERE window_end <= (SELECT max(event_time) FROM trades) - INTERVAL {o.GRACE['M1']}""")
def sealed_candles_in_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades to sealed minute candles to the lake table, as one running query."""
    base = scratch_dir(spark, "to-lake")
    table = schemas.CANDLES_TABLE
    jobs.start_lake_sink(
        sc.sealed_candles(_trade_stream(spark, sf_dir, late=True), "M1"), f"{base}/lake", table, f"{base}/checkpoint",
        bounded=True, stateful=True, order="window_end",
    ).awaitTermination()
    rows = lake.read_table(spark, f"{base}/lake", table).drop(table.day_column)
    return rows.withColumn("vwap", settle(F.col("vwap")))


@query("late_trades_stream", f"""WITH {o.TRADES}
SELECT * FROM trades WHERE epoch_ms(ingest_time) - epoch_ms(event_time) > 10000""")
def late_trades_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(sc.late_trades(_trade_stream(spark, sf_dir)), "late")


@query("deduplicated_stream", f"WITH {o.TRADES} SELECT * FROM trades")
def deduplicated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade delivered twice, in files apart, and thinned to one; some first come long after their time.

    The first stretch of time comes last but one, so its trades are late and still the only ones of their ids.
    """
    log = _event_log(spark, sf_dir)
    files = _Log(spark, "dedup-log", log[0].schema, _files(market.events(spark, sf_dir).count()))
    files.append(*log[1:-1], log[1], log[0], *log[2:], log[-1], log[0])
    return _drained(sc.without_repeats(files.stream(), "1000 days"), "dedup")


@query("volatility_stream", VOLATILITY_SQL)
def volatility_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of all windows after several micro-batches, each of which changed some days of it."""
    base = scratch_dir(spark, "volatility")
    stream, keys = sc.volatility(_trade_stream(spark, sf_dir)), ["symbol", "window_start"]
    jobs.start_latest_table(stream, f"{base}/out", f"{base}/checkpoint", keys, bounded=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out").select(*stream.columns).withColumns({
        "mean_price": settle(F.col("mean_price")), "volatility": settle(F.col("volatility"), 4),
    })


@query("live_window_stream", f"""WITH {o.TRADES}, {o.candles('H1')}
SELECT symbol, "interval", window_start, window_end, "open", high, low, "close", volume,
       {settle_sql('vwap')} AS vwap, trade_count, false AS is_final
FROM candles WHERE window_end > (SELECT max(window_end) FROM candles) - INTERVAL 24 HOUR""")
def live_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live table after the whole stream: the windows of its last day."""
    base = scratch_dir(spark, "live")
    stream = sc.open_candles(_trade_stream(spark, sf_dir, late=True), "H1")
    jobs.start_live_table(stream, f"{base}/live", f"{base}/checkpoint", bounded=True).awaitTermination()
    return jobs.read_live(spark, f"{base}/live").withColumn("vwap", settle(F.col("vwap")))


def _stretches(
    rows: DataFrame, order: Column, label: str, parts: int = LOG_FILES, numbers: DataFrame | None = None
) -> list[DataFrame]:
    """Rows written once in ``parts`` stretches of a number, each of which is read by itself.

    Where ``rows`` are dear to make, ``numbers`` is a plainer frame with the same numbers, of which the cuts are taken.
    """
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, label)
    cuts = (rows if numbers is None else numbers).agg(
        F.percentile_approx(order, [i / parts for i in range(1, parts)], 10_000)
    ).first()[0]
    stretch = sum((F.when(order > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    rows.withColumn("stretch", stretch).write.partitionBy("stretch").parquet(path)
    return [spark.read.schema(rows.schema).parquet(f"{path}/stretch={i}") for i in range(parts)]


@query("stream_anomalies", f"WITH {anomaly_ctes()} SELECT {ANOMALY_OUTPUT} FROM anomalies")
def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies found while streaming hourly candles from their log: several micro-batches, stopped half way."""
    base = scratch_dir(spark, "anomalies")
    records = s.candle_records(c.candles(market.trades(spark, sf_dir), "H1"))
    stretches = _stretches(records, F.unix_millis("value.window_start"), "candle-stretches")
    log = _Log(spark, "candle-log", s.log_schema(schemas.CANDLE), _files(market.events(spark, sf_dir).count()))
    for part in (stretches[: LOG_FILES // 2], stretches[LOG_FILES // 2:]):
        log.append(*part)
        jobs.start_anomalies(
            s.candles_of(log.stream()), f"{base}/out", f"{base}/state", f"{base}/checkpoint", bounded=True
        ).awaitTermination()
    return comparable_anomalies(spark.read.parquet(f"{base}/out").drop("batch"))


def _gaps_found(spark: SparkSession, sf_dir: str, deltas: DataFrame, session: str | None = None) -> DataFrame:
    """Gaps of a stream of deltas in order of their offset: several micro-batches, stopped half way."""
    base, events = scratch_dir(spark, "gaps"), market.events(spark, sf_dir)
    numbers = events.select(F.col("event_id").alias("kafka_offset"))  # a delta for each event
    stretches = _stretches(deltas, F.col("kafka_offset"), "delta-stretches", numbers=numbers)
    log = _Log(spark, "delta-log", deltas.schema, _files(events.count()))
    for part in (stretches[: LOG_FILES // 2], stretches[LOG_FILES // 2:]):
        log.append(*part)
        jobs.start_gaps(
            log.stream(), f"{base}/out", f"{base}/state", f"{base}/checkpoint", bounded=True, session=session
        ).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("stream_gaps", f"{GAPS_SQL} SELECT * FROM checked")
def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = market.orderbook_deltas(market.trades(spark, sf_dir))
    rows = s.delta_records(deltas).select("value.*", F.col("offset").alias("kafka_offset"))
    return _gaps_found(spark, sf_dir, rows).select(*GAP_COLUMNS)


@query("stream_gaps_reset", f"""WITH {o.DELTAS},
connected AS (
  SELECT exchange, symbol, kafka_offset, kafka_offset // 700 AS connection,
         first_update_id + 5000 * ((kafka_offset // 700) * 2 % 5) AS first_update_id,
         final_update_id + 5000 * ((kafka_offset // 700) * 2 % 5) AS final_update_id
  FROM deltas WHERE exchange = 'binance'),
previous AS (
  SELECT *, max(final_update_id) OVER (PARTITION BY exchange, symbol, connection ORDER BY kafka_offset
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_final_id FROM connected)
SELECT exchange, symbol, kafka_offset, connection, first_update_id, final_update_id, previous_final_id,
       previous_final_id IS NULL AS first_seen, coalesce(first_update_id - previous_final_id - 1 > 0, false) AS is_gap,
       greatest(coalesce(first_update_id - previous_final_id - 1, 0), 0) AS missing
FROM previous""")
def stream_gaps_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of books whose connection is made anew every 700 records, with ids that jump up or down by it."""
    connection = F.expr("kafka_offset DIV 700")
    jump = 5000 * (connection * 2 % 5)
    deltas = market.orderbook_deltas(market.trades(spark, sf_dir)).withColumns({
        "connection": connection,
        "first_update_id": F.col("first_update_id") + jump, "final_update_id": F.col("final_update_id") + jump,
    }).select("exchange", "symbol", "first_update_id", "final_update_id", "kafka_offset", "connection")
    found = _gaps_found(spark, sf_dir, deltas, "connection")
    return found.select(*GAP_COLUMNS, "connection")


_THIRDS = """edge AS (
  SELECT min(epoch_ms(window_start)) AS lo, (max(epoch_ms(window_start)) - min(epoch_ms(window_start))) // 3 AS third FROM candles),
parted AS (SELECT candles.*, least((epoch_ms(window_start) - lo) // greatest(third, 1), 2) AS part FROM candles, edge)"""


@query("pushed_stream", f"""WITH {o.TRADES}, {o.candles('M1')}, {_THIRDS},
subscriptions(part, subscriber, symbol) AS (
  VALUES (1, 'everything', NULL), (1, 'bitcoin', 'BTC-USD'), (1, 'gone', 'ETH-USD'),
         (2, 'bitcoin', 'BTC-USD'), (2, 'late', 'ETH-USD'), (2, 'late', 'SOL-USD'))
SELECT subscriber, parted.symbol, "interval", window_start, "open", "close", trade_count
FROM parted JOIN subscriptions AS s ON s.part = parted.part AND (s.symbol IS NULL OR s.symbol = parted.symbol)""")
def pushed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute candles pushed from the second third on, to subscribers that change for the last one, over a restart.

    What the log held when the push began is not pushed.
    """
    base = scratch_dir(spark, "push")
    candles = c.candles(market.trades(spark, sf_dir), "M1").withColumn("kafka_offset", F.unix_millis("window_start"))
    low, high = candles.agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
    third = max((high - low) // 3, 1)
    parted = s.candle_records(candles).withColumn("part", F.least(F.expr(f"(offset - {low}) DIV {third}"), F.lit(2)))
    parted.write.partitionBy("part").parquet(f"{base}/parts")
    schema, symbols = s.log_schema(schemas.CANDLE), list(market.SYMBOL_OF_EVENT.values()) + ["DOGE-USD"]
    followers = {
        1: [("everything", None), ("bitcoin", "BTC-USD"), ("gone", "ETH-USD")],
        2: [("bitcoin", "BTC-USD"), ("late", "ETH-USD"), ("late", "SOL-USD")],
    }
    for part in range(3):
        spark.read.schema(schema).parquet(f"{base}/parts/part={part}").write.mode("append").parquet(f"{base}/log")
        now = spark.createDataFrame(followers.get(part, []), jobs.SUBSCRIPTION)
        now.write.mode("overwrite").parquet(f"{base}/subscriptions")
        ends = s.log_ends(spark.read.schema(schema).parquet(f"{base}/log"))
        jobs.start_push(
            s.file_log(spark, f"{base}/log", schemas.CANDLE), ends, f"{base}/subscriptions", symbols, f"{base}/out",
            f"{base}/checkpoint", bounded=True,
        ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "subscriber", "symbol", "interval", "window_start", "open", "close", "trade_count"
    )


@query("decoded_candle_log", f"""WITH {o.TRADES}, {o.candles('M1', name='m1')}, {o.candles('M5', name='m5')},
{o.candles('H1', name='h1')}, candles AS (SELECT * FROM m1 UNION ALL SELECT * FROM m5 UNION ALL SELECT * FROM h1)
SELECT symbol, window_start AS key_start, CASE "interval" WHEN 'M1' THEN 'candles.m1' WHEN 'M5' THEN 'candles.m5'
       ELSE 'candles.h1' END AS topic, "open", high, low, "close", trade_count FROM candles""")
def decoded_candle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of all intervals written as log records and decoded from key and value again."""
    records = s.candle_records(c.candle_pyramid(market.trades(spark, sf_dir)))
    return records.select(
        s.decode_windowed_key(F.col("key")).alias("symbol"),
        s.windowed_key_start(F.col("key")).alias("key_start"),
        "topic",
        *[F.col(f"value.{n}").alias(n) for n in ("open", "high", "low", "close", "trade_count")],
    )


# --- the lake ----------------------------------------------------------------------------------

_LAKES: dict[tuple[str, str], str] = {}
_FILLED: set[tuple[str, str]] = set()


def _weekly_lake(spark: SparkSession, sf_dir: str, *tables: schemas.LakeTable) -> str:
    """A lake with ``tables``, each filled with one commit per week; a table is built once per session, when first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root = _LAKES.setdefault(key, scratch_dir(spark, "lake"))
    for table in tables:
        if (root, table.name) not in _FILLED:
            _fill_weeks(spark, sf_dir, root, table)
            _FILLED.add((root, table.name))
    return root


def _fill_weeks(spark: SparkSession, sf_dir: str, root: str, table: schemas.LakeTable) -> None:
    if table is schemas.TRADES_TABLE:
        rows = market.trades(spark, sf_dir).withColumns({"topic": F.lit(schemas.TRADES_TOPIC), "partition": F.lit(0)})
    else:
        hourly = c.candles(market.trades(spark, sf_dir), "H1")
        rows = hourly.withColumn("kafka_offset", F.unix_millis("window_start"))
    lake.ensure_table(spark, root, table)
    # Written once by week, so that each commit reads its own week only.
    staged = scratch_dir(spark, "weeks")
    rows = rows.withColumn("week", F.to_date(F.date_trunc("week", table.time_column)))
    rows.write.partitionBy("week").parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    weeks = [r[0] for r in rows.select("week").distinct().orderBy("week").collect()]
    for number, start in enumerate(weeks):
        lake.write_batch(rows.filter(F.col("week") == F.lit(start)), root, table, number)


_WEEKS = f"""WITH {o.TRADES},
weeks AS (SELECT date_trunc('week', event_time) AS week, count(*) AS n, max(kafka_offset) + 1 AS next_offset
          FROM trades GROUP BY ALL),
commits AS (SELECT row_number() OVER (ORDER BY week) AS commit_seq, week, n, next_offset FROM weeks)"""


@query("snapshots", f"""{_WEEKS}
SELECT commit_seq AS snapshot_id, 'append' AS operation, n AS received, n AS inserted, CAST(0 AS BIGINT) AS skipped,
       next_offset FROM commits""")
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, table = _weekly_lake(spark, sf_dir, schemas.TRADES_TABLE), schemas.TRADES_TABLE
    log = lake.commit_log(spark, root, table).select(
        F.col("commit_seq").alias("snapshot_id"), "received", "inserted", "skipped",
        F.col("offsets")["trades.raw.0"].alias("next_offset"),
    )
    return lake.list_snapshots(spark, root, table).drop("timestamp").join(log, "snapshot_id")


@query("backtest_trades_asof", f"""{_WEEKS}
SELECT 'bronze.trades' AS table_name, CAST(2 AS BIGINT) AS snapshot_id, count(*) AS total_trades,
       min(event_time) AS earliest, max(event_time) AS latest, count(DISTINCT symbol) AS symbols,
       count_if(price <= 0 OR quantity <= 0)::BIGINT AS price_violations, {settle_sql('avg(price)', 4)} AS avg_price,
       CASE WHEN count_if(price <= 0 OR quantity <= 0) > 0 THEN 'failed' ELSE 'ok' END AS status
FROM trades WHERE date_trunc('week', event_time) IN (SELECT week FROM commits WHERE commit_seq <= 2)""")
def backtest_trades_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _weekly_lake(spark, sf_dir, schemas.TRADES_TABLE)
    return backtest.run_backtest(spark, root, schemas.TRADES_TABLE, snapshot_id=2)


@query("backtest_candles_asof", f"""WITH {o.TRADES}, {o.candles('H1')},
weeks AS (SELECT DISTINCT date_trunc('week', window_start) AS week FROM candles ORDER BY week LIMIT 3)
SELECT 'silver.candles' AS table_name, CAST(3 AS BIGINT) AS snapshot_id, count(*) AS total_candles,
       min(window_start) AS earliest, max(window_end) AS latest, count(DISTINCT symbol) AS symbols,
       count_if(high < "open" OR high < "close" OR low > "open" OR low > "close" OR low > high)::BIGINT AS ohlc_violations,
       round(sum(volume), 4) AS total_volume, 'ok' AS status
FROM candles WHERE date_trunc('week', window_start) IN (SELECT week FROM weeks)""")
def backtest_candles_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _weekly_lake(spark, sf_dir, schemas.CANDLES_TABLE)
    return backtest.run_backtest(spark, root, schemas.CANDLES_TABLE, snapshot_id=3)


@query("sink_counters", f"""{_WEEKS}
SELECT 'bronze.trades' AS table_name, CAST(sum(n) AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS duplicates,
       count(*) AS batches, CAST(0 AS BIGINT) AS errors FROM commits""")
def sink_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _weekly_lake(spark, sf_dir, schemas.TRADES_TABLE)
    return metrics.sink_counters(lake.commit_log(spark, root, schemas.TRADES_TABLE))


@query("commit_histogram", f"""{_WEEKS},
bounds(le) AS (VALUES {", ".join(f"(CAST({b} AS DOUBLE))" for b in metrics.COMMIT_BOUNDS_SECONDS)}, (CAST('Infinity' AS DOUBLE)))
SELECT 'bronze.trades' AS table_name, le, count_if(n / 200.0 <= le)::BIGINT AS "count", count(*) AS total
FROM commits, bounds GROUP BY le""")
def commit_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All buckets. Commit times depend on the machine, so a two-hundredth of the rows of a commit stands for them."""
    root = _weekly_lake(spark, sf_dir, schemas.TRADES_TABLE)
    log = lake.commit_log(spark, root, schemas.TRADES_TABLE)
    return metrics.commit_histogram(log.withColumn("seconds", F.col("received") / 200.0)).drop("sum_seconds")


@query("sink_replay_result", f"""WITH {o.TRADES},
half AS (SELECT count(*) AS n FROM trades WHERE side <> 'UNKNOWN'), whole AS (SELECT count(*) AS n FROM trades)
SELECT 1 AS step, half.n AS received, half.n AS inserted, CAST(0 AS BIGINT) AS skipped FROM half
UNION ALL SELECT 2, whole.n, whole.n - half.n, half.n FROM whole, half
UNION ALL SELECT 3, whole.n, 0, whole.n FROM whole""")
def sink_replay_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some trades stored, then the whole log replayed twice."""
    base = scratch_dir(spark, "replay")
    table = schemas.TRADES_TABLE
    trades = market.trades(spark, sf_dir)
    lake.ensure_table(spark, f"{base}/lake", table)
    first = lake.write_batch(trades.filter(F.col("side") != "UNKNOWN"), f"{base}/lake", table, 0)
    s.trade_records(trades).write.parquet(f"{base}/log")
    results = [first]
    for group in ("first", "second"):
        log = s.file_log(spark, f"{base}/log", schemas.TRADE)
        results.append(
            jobs.replay({"trades": log}, f"{base}/lake", f"{base}/checkpoint", "trades", group)
        )
    rows = [(n, r.received, r.inserted, r.skipped) for n, r in enumerate(results, 1)]
    return spark.createDataFrame(rows, "step int, received bigint, inserted bigint, skipped bigint")


@query("sink_two_writers", f"""WITH {o.TRADES}
SELECT count(*) AS n_rows, count(DISTINCT (exchange, symbol, trade_id)) AS n_keys, CAST(2 AS BIGINT) AS commits FROM trades""")
def sink_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live writer and a replay of overlapping trades; the replay commits while the other writes its files."""
    base, table = scratch_dir(spark, "writers"), schemas.TRADES_TABLE
    trades = market.trades(spark, sf_dir)
    lake.ensure_table(spark, base, table)
    held: list[bool] = []

    def interrupted(rows: DataFrame) -> DataFrame:
        """The replay's batch, asked for when the live one has read the state of the table."""
        if not held:
            held.append(True)
            lake.write_batch(trades.filter(F.col("side") != "BUY"), base, table, 0, writer="replay")
        return rows

    lake.write_batch(trades.filter(F.col("side") != "SELL"), base, table, 0, writer="live", prepare=interrupted)
    rows = lake.read_table(spark, base, table)
    commits = lake.list_snapshots(spark, base, table).agg(F.count("*").alias("commits"))
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct(*table.keys).alias("n_keys")).crossJoin(commits)


@query("sink_dedup_last", f"""WITH {o.TRADES}
SELECT trade_id, exchange, symbol, CASE side WHEN 'SELL' THEN price + 1 ELSE price END AS price, quantity, side,
       event_time, ingest_time FROM trades""")
def sink_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and later corrections of the sales in one batch: the last arrival is stored."""
    base = scratch_dir(spark, "dedup")
    table = schemas.TRADES_TABLE
    trades = market.trades(spark, sf_dir)
    corrected = trades.filter(F.col("side") == "SELL").withColumns({
        "price": F.col("price") + 1, "kafka_offset": F.col("kafka_offset") + 1_000_000_000_000,
    })
    lake.ensure_table(spark, base, table)
    lake.write_batch(trades.unionByName(corrected), base, table, 0)
    return lake.read_table(spark, base, table).drop("kafka_offset", table.day_column)


@query("refreshed_copy", f"""WITH {o.TRADES}, {o.candles('H1')}
SELECT 'bronze.trades' AS table_name, count(*) AS n_rows FROM trades
UNION ALL SELECT 'silver.candles', count(*) FROM candles""")
def refreshed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _weekly_lake(spark, sf_dir, *schemas.LAKE_TABLES)
    counts = lake.refresh_copy(spark, root, scratch_dir(spark, "copy"))
    return spark.createDataFrame(sorted(counts.items()), "table_name string, n_rows bigint")


# --- keys, replays from an instant, layout ------------------------------------------------------------

@query("decoded_trade_keys", f"""WITH {o.TRADES}
SELECT symbol AS key_symbol, symbol, 'trades.raw' AS topic, count(*) AS records FROM trades GROUP BY ALL""")
def decoded_trade_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as log records, counted by the symbol in the key and the one in the value."""
    records = s.trade_records(market.trades(spark, sf_dir))
    return records.groupBy(
        s.decode_plain_key(F.col("key")).alias("key_symbol"), F.col("value.symbol").alias("symbol"), "topic"
    ).agg(F.count("*").alias("records"))


_INSTANT = "(SELECT CAST(floor(median(epoch_ms(ingest_time))) AS BIGINT) FROM trades)"


def _median_arrival(trades: DataFrame) -> datetime:
    middle = trades.agg(F.floor(F.median(F.unix_millis("ingest_time")))).first()[0]
    return datetime.fromtimestamp(middle / 1000, timezone.utc)


@query("replayed_from_instant", f"""WITH {o.TRADES},
log AS (
  SELECT *, CASE WHEN kafka_offset % 4 = 3 AND epoch_ms(ingest_time) >= {_INSTANT} THEN 0 ELSE kafka_offset % 4 END AS part
  FROM trades),
starts AS (SELECT part, min(kafka_offset) AS start FROM log WHERE epoch_ms(ingest_time) >= {_INSTANT} GROUP BY part)
SELECT CAST(part AS INTEGER) AS "partition", symbol, count(*) AS records, min(kafka_offset) AS first_offset,
       count_if(epoch_ms(ingest_time) < {_INSTANT})::BIGINT AS older
FROM log JOIN starts USING (part) WHERE kafka_offset >= start GROUP BY part, symbol""")
def replayed_from_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of four partitions read again from the median arrival on, as a bounded stream.

    Arrivals do not rise with the offset, so older records stand behind the first one that is late enough; the last
    partition has none that is. ``older`` counts them.
    """
    base = scratch_dir(spark, "instant")
    trades = market.trades(spark, sf_dir)
    start = _median_arrival(trades)
    part = F.pmod("offset", F.lit(4)).cast("int")
    late_enough = F.col("timestamp") >= F.lit(start)  # a trade is logged when it arrives
    s.trade_records(trades).withColumn(
        "partition", F.when((part == 3) & late_enough, 0).otherwise(part)
    ).write.parquet(f"{base}/log")
    log = s.file_log(spark, f"{base}/log", schemas.TRADE)
    starts = jobs.probe_offsets(log, start, f"{base}/seek")
    rows = _drained(s.trades_of(s.from_offsets(log, starts)), "", base)
    older = F.count_if(F.col("ingest_time") < F.lit(start))
    return rows.groupBy("partition", "symbol").agg(
        F.count("*").alias("records"), F.min("kafka_offset").alias("first_offset"), older.alias("older")
    )


@query("replayed_pipelines", f"""WITH {o.TRADES}, {o.candles('H1')},
first_trade AS (SELECT min(kafka_offset) AS start FROM trades WHERE epoch_ms(ingest_time) >= {_INSTANT}),
first_candle AS (SELECT min(window_start) AS start FROM candles WHERE epoch_ms(window_end) >= {_INSTANT}),
n AS (SELECT (SELECT count(*) FROM trades) AS t, (SELECT count(*) FROM candles) AS c,
             (SELECT count(*) FROM trades, first_trade WHERE kafka_offset >= start)
             + (SELECT count(*) FROM candles, first_candle WHERE window_start >= start) AS later)
SELECT 1 AS step, 'all, dry run' AS run, CAST(0 AS BIGINT) AS received, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS skipped
UNION ALL SELECT 2, 'candles', c, c, 0 FROM n
UNION ALL SELECT 3, 'all', t + c, t, c FROM n
UNION ALL SELECT 4, 'all, from an instant', later, 0, later FROM n""")
def replayed_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and candles replayed into one lake: dry, one pipeline, both, and both once more from the median arrival on."""
    base = scratch_dir(spark, "pipelines")
    trades = market.trades(spark, sf_dir)
    candles = c.candles(trades, "H1").withColumn("kafka_offset", F.unix_millis("window_start"))
    s.trade_records(trades).write.parquet(f"{base}/trades")
    s.candle_records(candles).write.parquet(f"{base}/candles")
    start = _median_arrival(trades)

    def run(pipeline: str, group: str, **options) -> jobs.ReplaySummary:
        logs = {
            "trades": s.file_log(spark, f"{base}/trades", schemas.TRADE),
            "candles": s.file_log(spark, f"{base}/candles", schemas.CANDLE),
        }
        return jobs.replay(logs, f"{base}/lake", f"{base}/checkpoint", pipeline, group, **options)

    runs = {
        "all, dry run": run("all", "dry", dry_run=True), "candles": run("candles", "candles"), "all": run("all", "all"),
        "all, from an instant": run("all", "instant", start=start),
    }
    rows = [(n, name, r.received, r.inserted, r.skipped) for n, (name, r) in enumerate(runs.items(), 1)]
    return spark.createDataFrame(rows, "step int, run string, received bigint, inserted bigint, skipped bigint")


@query("lake_layout", f"""WITH {o.TRADES}, {o.candles('H1')}
SELECT 'bronze.trades' AS table_name, CAST(event_time AS DATE) AS folder_day, symbol AS folder, count(*) AS n_rows FROM trades GROUP BY ALL
UNION ALL SELECT 'silver.candles', CAST(window_start AS DATE), "interval", count(*) FROM candles GROUP BY ALL""")
def lake_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each day and symbol or interval folder, read from the file names."""
    root, out = _weekly_lake(spark, sf_dir, *schemas.LAKE_TABLES), None
    for table in (schemas.TRADES_TABLE, schemas.CANDLES_TABLE):
        part = lambda name: F.regexp_extract(F.input_file_name(), f"/{name}=([^/]+)/", 1)  # noqa: B023,E731
        rows = spark.read.parquet(lake.data_path(root, table)).select(
            F.lit(table.name).alias("table_name"), part(table.day_column).cast("date").alias("folder_day"),
            part(table.partition_column).alias("folder"),
        ).groupBy("table_name", "folder_day", "folder").agg(F.count("*").alias("n_rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("run_records", f"""{_WEEKS}
SELECT 'sink-trades' AS job_name, 'trades.raw' AS inputs, 'bronze.trades' AS output, n AS rows_written, 'COMPLETE' AS state, commit_seq
FROM commits""")
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.run_records(lake.commit_log(spark, _weekly_lake(spark, sf_dir, schemas.TRADES_TABLE), schemas.TRADES_TABLE))


@query("empty_batch", f"""WITH {o.TRADES}
SELECT CAST(0 AS BIGINT) AS received, CAST(0 AS BIGINT) AS inserted, CAST(1 AS BIGINT) AS commits, count(*) AS n_rows FROM trades""")
def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of no rows after one of all trades: nothing is inserted and nothing committed."""
    base, table = scratch_dir(spark, "empty"), schemas.TRADES_TABLE
    trades = market.trades(spark, sf_dir)
    lake.ensure_table(spark, base, table)
    lake.write_batch(trades, base, table, 0)
    result = lake.write_batch(trades.filter("price IS NULL"), base, table, 1)
    figures = lake.read_table(spark, base, table).agg(F.count("*").alias("n_rows"))
    commits = lake.list_snapshots(spark, base, table).agg(F.count("*").alias("commits"))
    return figures.crossJoin(commits).withColumns({
        "received": F.lit(result.received).cast("bigint"), "inserted": F.lit(result.inserted).cast("bigint")})


# --- ingest ---------------------------------------------------------------------------------------

FRAMES = "exchange string, value string, ingest_time timestamp, kafka_offset bigint"
_UNLISTED = "DOGE-USD"


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Frames of both exchanges, in several micro-batches, sent to their topics; DOGE-USD is not in the seed.

    The folder of the logs, and the counts of the listener. The frames are written once and read once.
    """
    base = scratch_dir(spark, "ingest")
    trades = market.trades(spark, sf_dir)
    # Two frames or more for each trade, so LOG_FILES files at least, wherever the rows lie.
    most = min(ROWS_PER_FILE, -(-2 * market.events(spark, sf_dir).count() // LOG_FILES))
    market.exchange_frames(trades).write.option("maxRecordsPerFile", max(most, 1)).parquet(f"{base}/frames")
    files = len(spark.read.schema(FRAMES).parquet(f"{base}/frames").inputFiles())
    listed = seed.read_symbol_seed(spark).filter(F.col("canonical") != _UNLISTED)
    symbols = [r[0] for r in listed.select("canonical").collect()]  # the seed
    stream = spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", max(-(-files // LOG_FILES), 1)).parquet(f"{base}/frames")
    counts = ingest.IngestCounts()
    spark.streams.addListener(counts)
    try:
        query_ = ingest.start_ingest(stream, listed, symbols, f"{base}/out", f"{base}/checkpoint", bounded=True)
        query_.awaitTermination()
        return f"{base}/out", counts.table(spark, query_)
    finally:
        spark.streams.removeListener(counts)


@query("normalised_events", f"""WITH {o.DELTAS}
SELECT 'trades.raw' AS topic, symbol AS key_symbol, exchange, symbol, trade_id, price, quantity,
       CASE WHEN exchange = 'binance' AND side <> 'SELL' THEN 'BUY' ELSE side END AS side,
       CAST(NULL AS BIGINT) AS first_update_id, CAST(NULL AS BIGINT) AS final_update_id, CAST(NULL AS DOUBLE) AS bid,
       CAST(NULL AS DOUBLE) AS ask, event_time, ingest_time, kafka_offset AS log_offset
FROM trades WHERE symbol <> '{_UNLISTED}'
UNION ALL
SELECT 'orderbook.delta', symbol, exchange, symbol, NULL, NULL, NULL, NULL,
       CASE exchange WHEN 'binance' THEN first_update_id ELSE final_update_id END, final_update_id,
       {settle_sql('price * 0.999')}, {settle_sql('price * 1.001')}, event_time, ingest_time, kafka_offset
FROM deltas WHERE symbol <> '{_UNLISTED}'""")
def normalised_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in both topics after a log of raw frames went through; frames of no event leave nothing there."""
    out, _ = _ingested(spark, sf_dir)
    common = ["topic", s.decode_plain_key(F.col("key")).alias("key_symbol"), "value.*", F.col("offset").alias("log_offset")]
    trades = ingest.read_topic(spark, out, schemas.TRADES_TOPIC).select(*common)
    first = lambda side: settle(F.get(F.col(side), 0)["price"], 6)
    deltas = ingest.read_topic(spark, out, schemas.ORDERBOOK_TOPIC).select(*common).withColumns(
        {"bid": first("bids"), "ask": first("asks")}
    ).drop("bids", "asks")
    return trades.unionByName(deltas, allowMissingColumns=True)


@query("ingest_counts", f"""WITH {o.DELTAS}
SELECT 'trades' AS metric, exchange, symbol AS label, count(*) AS n FROM trades WHERE symbol <> '{_UNLISTED}' GROUP BY ALL
UNION ALL SELECT 'deltas', exchange, symbol, count(*) FROM deltas WHERE symbol <> '{_UNLISTED}' GROUP BY ALL
UNION ALL SELECT 'dropped', exchange, 'unknown_symbol', 2 * count(*) FROM trades WHERE symbol = '{_UNLISTED}' GROUP BY ALL
UNION ALL SELECT 'dropped', exchange, 'unreadable', count(*) FROM trades WHERE kafka_offset % 10 = 2 GROUP BY ALL""")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and deltas per exchange and symbol and drops per reason, counted while the frames passed."""
    return _ingested(spark, sf_dir)[1]

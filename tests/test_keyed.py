"""Tables kept per partition, and the streams that keep them."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, ms_of
from tidemark import schemas
from tidemark.operators import candles as c, explain, keyed
from tidemark.sources import streams as s
from tidemark.streaming import candles as sc, jobs

ROWS = "k string, v int, day int"


def files(path):
    """Data files by folder, with what tells a file from one written anew."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                stat = os.stat(os.path.join(folder, name))
                found.setdefault(os.path.relpath(folder, path), set()).add((name, stat.st_mtime_ns))
    return found


def merge(spark, path, rows):
    keyed.merge_partitions(spark.createDataFrame(rows, ROWS), path, ["day"], keyed.newest_wins(["k", "day"]))
    return sorted(map(tuple, keyed.read(spark, path, spark.createDataFrame([], ROWS).schema).collect()))


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "table")
    assert merge(spark, path, [("a", 1, 1), ("b", 2, 1), ("a", 3, 2)]) == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]
    before = files(path)
    assert merge(spark, path, [("a", 9, 2), ("c", 4, 3)]) == [("a", 1, 1), ("a", 9, 2), ("b", 2, 1), ("c", 4, 3)]
    after = files(path)
    assert after["day=1"] == before["day=1"] and after["day=2"] != before["day=2"] and "day=3" in after
    assert merge(spark, path, [("a", 9, 2), ("c", 4, 3)]) == [("a", 1, 1), ("a", 9, 2), ("b", 2, 1), ("c", 4, 3)]
    merge(spark, path, [])
    assert files(path)["day=1"] == before["day=1"]


def test_a_merged_table_equals_a_dictionary(spark, tmp_path):
    rng, path, want = random.Random(1), str(tmp_path / "table"), {}
    for _ in range(5):
        rows = list({(k, d): (k, rng.randrange(100), d) for k, d in [(rng.choice("abcdef"), rng.randrange(4)) for _ in range(6)]}.values())
        want |= {(k, d): v for k, v, d in rows}
        assert merge(spark, path, rows) == sorted((k, v, d) for (k, d), v in want.items())


def _append(spark, make_trades, path, rows, numbers=itertools.count()):
    first = next(numbers) * 1000
    trades = make_trades(rows).withColumn("kafka_offset", F.col("kafka_offset") + first)
    trades.withColumn("trade_id", F.col("kafka_offset").cast("string")).coalesce(1).write.mode("append").parquet(path)


def test_the_volatility_table_does_not_grow_with_changes(spark, make_trades, tmp_path):
    log, out, ck = (str(tmp_path / n) for n in ("log", "out", "ck"))
    sizes = []
    for n in range(4):
        _append(spark, make_trades, log, [(1700000040000 + n * 100, 10 + 4 * (n % 2), 1)])
        stream = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log)
        jobs.start_latest_table(sc.volatility(stream), out, ck, ["symbol", "window_start"], bounded=True).awaitTermination()
        sizes.append((spark.read.parquet(out).count(), sum(map(len, files(out).values()))))
    assert len(set(sizes)) == 1 and sizes[0][0] == 5
    trades = spark.read.parquet(log)
    pick = ["symbol", "window_start", "trade_count", "mean_price", "volatility"]
    batch = c.volatility(trades).select(*pick)
    assert sorted(map(tuple, spark.read.parquet(out).select(*pick).collect())) == sorted(map(tuple, batch.collect()))


def test_resets_begin_a_sequence_anew(spark, tmp_path):
    """Against a walk over all deltas that forgets a stream when its session changes."""
    columns = "exchange string, symbol string, first_update_id bigint, final_update_id bigint, kafka_offset bigint, session string"
    rng, rows, last = random.Random(2), [], {}
    for i in range(120):
        symbol, session = ("BTC-USD", "ETH-USD")[i % 2], f"s{i // 25}"
        base = last.get((symbol, session), rng.randrange(1000))
        first = base + 1 + rng.choice([0, 0, 0, 3, -2])
        last[symbol, session] = max(base, first + 4)
        rows.append(("binance", symbol, first, first + 4, i, session))
    seen, want = {}, []
    for _, symbol, first, final, i, session in rows:
        known, highest = seen.get(symbol, (None, None))
        highest = highest if known == session else None
        want.append((i, highest is None, highest is not None and first > highest + 1, max(first - highest - 1, 0) if highest is not None else 0))
        seen[symbol] = (session, max(final, highest) if highest is not None else final)
    base = str(tmp_path)
    for part in range(5):
        chunk = rows[part * 24:(part + 1) * 24]
        spark.createDataFrame(chunk, columns).coalesce(1).write.mode("append").parquet(f"{base}/log")
        if part in (1, 4):  # several micro-batches, with a restart between them
            stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(f"{base}/log")
            jobs.start_gaps(stream, f"{base}/out", f"{base}/state", f"{base}/ck", bounded=True, session="session").awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{base}/out").select("kafka_offset", "first_seen", "is_gap", "missing").collect()))
    assert got == want and any(r[2] for r in got)
    assert spark.read.parquet(f"{base}/state").filter("symbol = 'BTC-USD'").groupBy("slot").count().filter("count > 1").isEmpty()


def test_push_from_now_on_to_whoever_follows(spark, make_trades, tmp_path):
    base = str(tmp_path)

    def run(ms, followers):
        candles = c.candles(make_trades([(ms, 1, 1), (ms, 1, 1, "ETH-USD")]), "M1").withColumn("kafka_offset", F.unix_millis("window_start"))
        s.candle_records(candles).coalesce(1).write.mode("append").parquet(f"{base}/log")
        spark.createDataFrame(followers, jobs.SUBSCRIPTION).write.mode("overwrite").parquet(f"{base}/subs")
        ends = s.log_ends(spark.read.schema(s.log_schema(schemas.CANDLE)).parquet(f"{base}/log"))
        log = s.file_log(spark, f"{base}/log", schemas.CANDLE)
        jobs.start_push(log, ends, f"{base}/subs", ["BTC-USD", "ETH-USD"], f"{base}/out", f"{base}/ck", bounded=True).awaitTermination()
        return sorted((ms_of(r.window_start) // 60000 - 28333334, r.subscriber, r.symbol) for r in spark.read.parquet(f"{base}/out").collect())

    start = 1700000040000
    assert run(start, [("early", None)]) == []
    first = run(start + 60_000, [("early", None), ("btc", "BTC-USD")])
    assert [x[1:] for x in first] == [("btc", "BTC-USD"), ("early", "BTC-USD"), ("early", "ETH-USD")]
    second = run(start + 120_000, [("btc", "BTC-USD"), ("late", "ETH-USD")])
    assert [x[1:] for x in second if x not in first] == [("btc", "BTC-USD"), ("late", "ETH-USD")]


def test_explanations_are_kept_in_buckets(spark, tmp_path):
    path, names = str(tmp_path / "store"), schemas.EXPLANATION.fieldNames()

    def save(anomaly_id, seq, **values):
        row = dict.fromkeys(names) | {
            "anomaly_id": anomaly_id, "symbol": "BTC-USD", "detected_at": at(0), "anomaly_type": "PRICE_SPIKE",
            "key_factors": [], "news_headlines": [],
        }
        return tuple((row | values)[n] for n in names) + (seq,)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.EXPLANATION) + ", seq int"
    write = lambda *rows: explain.save_explanations(spark.createDataFrame(list(rows), schema), path, 8)
    read = lambda: {r.anomaly_id: (r.explanation, r.severity) for r in explain.read_explanations(spark, path).collect()}
    write(*[save(f"a{i}", 0, severity=float(i)) for i in range(20)])
    before = files(path)
    assert len(before) > 3 and read()["a7"] == (None, 7.0)
    write(save("a7", 0, severity=99.0), save("a7", 1, severity=99.0, explanation="why"))
    after = files(path)
    assert read() == {f"a{i}": ("why" if i == 7 else None, float(i)) for i in range(20)}
    assert len([f for f in before if after[f] != before[f]]) == 1
    write(save("a7", 0))
    assert read()["a7"] == (None, 7.0)


@pytest.mark.parametrize("buckets", [1, 64])
def test_buckets_are_stable(spark, buckets):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k")).select(keyed.bucket("k", buckets).alias("b")).collect()
    assert {0 <= r.b < buckets for r in rows} == {True}

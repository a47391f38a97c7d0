import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import at, ms_of
from tidemark import schemas
from tidemark.operators import candles as c, marts, metrics as m, quality as q
from tidemark.plans.jobs import hourly_checks
from tidemark.sources.seed import read_symbol_seed


def test_generic_tests_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "z")], "k int, v string")
    assert q.not_null(df, "v").count() == 1
    assert [(r.k, r.n_rows) for r in q.unique(df, "k").collect()] == [(1, 2)]
    assert q.unique_combination(df, ["k", "v"]).isEmpty()
    assert [r.v for r in q.accepted_values(df, "v", ["a", "b"]).collect()] == ["z"]
    parent = spark.createDataFrame([("a",), ("b",)], "p string")
    assert [r.v for r in q.relationships(df, "v", parent, "p").collect()] == ["z"]


def test_trade_checks(make_trades):
    good = marts.fct_trade(make_trades([(1700000040000, 100, 1), (1700000041000, 5, 2)]))
    assert all(r.passed for r in q.trade_checks(good).collect())
    bad = good.unionByName(good.withColumns({"price": F.lit(-1.0), "exchange": F.lit("kraken")}).limit(1))
    failed = {r.check_name for r in q.trade_checks(bad).collect() if not r.passed}
    assert failed == {"duplicate_trade_id", "min_price", "invalid_exchange"}
    empty = {r.check_name: r.passed for r in q.trade_checks(good.limit(0)).collect()}
    assert empty["row_count"] is False and empty["min_price"] is False


def test_candle_checks_and_minute_gaps(make_trades):
    months = [1700000040000, 1700000100000, 1700000400000, 1702700000000]
    fct = marts.fct_candle(c.candles(make_trades([(ms, 100, 1) for ms in months]), "M1"))
    gaps = q.minute_gaps(fct).orderBy("window_start").collect()
    assert [r.gap_minutes for r in gaps] == [5, 44993]
    failed = {r.check_name: r.value for r in q.candle_checks(fct).collect() if not r.passed}
    assert failed == {"minute_gaps": 2}
    broken = fct.withColumn("low_price", F.col("high_price") + 1)
    assert q.ohlc_violations(broken).count() == 4 and q.ohlc_violations(fct).isEmpty()


def test_contract_check(spark):
    rows = [
        ("1", "binance", "BTC-USD", "10.5", "1", "BUY", "2024-01-01 00:00:00", "2024-01-01 00:00:01"),
        ("2", "binance", "BTC-USD", "abc", "0", "BUY", "2024-01-01 00:00:00", "2024-01-01 00:00:01"),
        (None, "kraken", "BTC-USD", "1", "1", "HOLD", "never", "2024-01-01 00:00:01"),
        ("4", "coinbase", "BTC-USD", "1", "1", None, "2024-01-01 00:00:00", "2024-01-01 00:00:01"),
    ]
    names = schemas.TRADE.fieldNames()
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    valid, rejected = q.contract_check(df, "trade")
    assert {(r.trade_id, r.side, r.price) for r in valid.collect()} == {("1", "BUY", 10.5), ("4", "UNKNOWN", 1.0)}
    assert [f.dataType for f in valid.schema] == [f.dataType for f in schemas.TRADE]
    reasons = sorted(sorted(r.reasons) for r in rejected.collect())
    assert reasons == [
        ["event_time not timestamp", "exchange not accepted", "side not accepted", "trade_id missing"],
        ["price not double", "quantity not positive"],
    ]
    valid, rejected = q.contract_check(df.drop("side"), "trade")
    assert valid.count() == 2 and {r.side for r in valid.collect()} == {"UNKNOWN"}


def test_contract_check_of_candles_and_deltas(spark, make_trades):
    candles = c.candles(make_trades([(1700000040000, 100, 1)]), "M1")
    assert q.contract_check(candles, "candle")[0].count() == 1
    assert q.contract_check(candles.withColumn("high", F.lit(1.0)), "candle")[1].first().reasons == ["ohlc inconsistent"]
    delta = spark.createDataFrame(
        [("binance", "BTC-USD", 5, 4, [(1.0, 2.0)], [], at(0), at(0))], schemas.ORDERBOOK_DELTA)
    assert q.contract_check(delta, "orderbook_delta")[1].first().reasons == ["final id before first"]
    with pytest.raises(ValueError):
        q.contract_check(delta, "orders")


def test_backward_compatibility(spark, tmp_path):
    def struct(*fields):
        return T.StructType([T.StructField(n, t, False, {} if d is None else {"default": d}) for n, t, d in fields])

    old = struct(("a", T.IntegerType(), None), ("b", T.StringType(), None))
    assert q.backward_compatible(None, old) and q.backward_compatible(old, old)
    assert q.backward_compatible(old, struct(("a", T.LongType(), None)))
    assert q.backward_compatible(old, struct(("a", T.IntegerType(), None), ("c", T.StringType(), "x")))
    assert not q.backward_compatible(old, struct(("c", T.StringType(), None)))
    assert not q.backward_compatible(struct(("a", T.LongType(), None)), struct(("a", T.IntegerType(), None)))
    assert not q.backward_compatible(
        T.StructType([T.StructField("a", T.StringType(), True)]), struct(("a", T.StringType(), None)))
    for contract in schemas.CONTRACTS.values():
        assert q.backward_compatible(contract, contract)
    # Old files read with the newer contract.
    spark.createDataFrame([(7, "b")], old).write.parquet(str(tmp_path / "old"))
    new = struct(("a", T.LongType(), None), ("c", T.StringType(), "x"))
    assert q.upgrade(spark.read.parquet(str(tmp_path / "old")), new).collect() == [(7, "x")]


def test_seed_copies(spark):
    seed = read_symbol_seed(spark)
    assert q.same_rows(seed, read_symbol_seed(spark))
    assert not q.same_rows(seed, seed.limit(4)) and not q.same_rows(seed, seed.unionByName(seed.limit(1)))


def samples(spark, *pairs):
    return spark.createDataFrame([("k", at(1000 * s), float(v)) for s, v in pairs], "k string, ts timestamp, value double")


def test_sustained_breaches(spark):
    calm = [(0, 1)]
    long = [(60 * n, 99) for n in range(1, 7)]     # 300 s
    short = [(420, 1)] + [(480 + 60 * n, 99) for n in range(5)]  # 240 s
    df = samples(spark, *calm, *long, *short, (800, 0))
    row, = q.sustained_breaches(df, ["k"], 60.0).collect()
    assert (ms_of(row.breach_start), ms_of(row.breach_end), row.samples, row.peak) == (60_000, 360_000, 6, 99)
    # A stretch that crosses segment borders is one stretch.
    across, = q.sustained_breaches(df, ["k"], 60.0, unit="minute").collect()
    assert across == row


def test_contract_takes_levels_of_text(spark):
    ddl = ("exchange string, symbol string, first_update_id string, final_update_id bigint, "
           "bids array<struct<price:string,quantity:string>>, asks array<struct<price:string,quantity:string>>, "
           "event_time timestamp, ingest_time timestamp, is_snapshot boolean")
    row = lambda bids: ("binance", "BTC-USD", "1", 2, bids, [], at(0), at(0), False)
    df = spark.createDataFrame([row([("1.5", "2")]), row([("x", "2")]), row([("1", None)]), row([])], ddl)
    valid, rejected = q.contract_check(df, "orderbook_delta")
    assert sorted(len(r.bids) for r in valid.collect()) == [0, 1] and valid.schema["bids"].dataType.elementType["price"].dataType == T.DoubleType()
    assert [r.reasons for r in rejected.collect()] == [["bids not " + schemas.ORDERBOOK_DELTA["bids"].dataType.simpleString()]] * 2


def test_silence_ends_a_breach(spark):
    assert q.sustained_breaches(samples(spark, (0, 99), (86_400, 99)), ["k"], 60.0).count() == 0
    df = samples(spark, *[(60 * n, 99) for n in range(6)], *[(2000 + 60 * n, 99) for n in range(7)], (5000, 99))
    for unit in ("month", "minute"):
        rows = q.sustained_breaches(df, ["k"], 60.0, unit=unit).orderBy("breach_start").collect()
        assert [(ms_of(r.breach_start), r.samples) for r in rows] == [(0, 6), (2_000_000, 7)]
    row, = q.sustained_breaches(df, ["k"], 60.0, max_gap_seconds=10_000).collect()
    assert row.samples == 14


def test_a_null_key_has_its_carry(spark):
    rows = [(k, at(60_000 * n), 99.0) for k in ("a", None) for n in range(8)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    found = q.sustained_breaches(df, ["k"], 60.0, unit="minute").collect()
    assert sorted((r.k or "", r.samples) for r in found) == [("", 8), ("a", 8)]


def test_an_absence_may_go_on(spark):
    df = samples(spark, (0, 1), (600, 1))
    now = lambda s: F.lit(at(1000 * s))
    assert q.absences(df, ["k"], now(1200)).count() == 0
    row, = q.absences(df, ["k"], now(1201)).collect()
    assert (ms_of(row.absent_from), row.absent_until, row.seconds) == (600_000, None, 601.0)


def test_absences(spark):
    df = samples(spark, (0, 1), (600, 1), (1201, 1), (3_000_000, 1))
    rows = q.absences(df, ["k"]).orderBy("absent_from").collect()
    assert [(ms_of(r.absent_from), r.seconds) for r in rows] == [(600_000, 601.0), (1_201_000, 2_998_799.0)]


def test_skew_histogram_and_quantiles(make_trades):
    trades = make_trades([(1700000000000, 1, 1, "BTC-USD", d) for d in (1, 5, 6, 100, 40_000)])
    rows = {r.le: r for r in m.skew_histogram(trades).collect()}
    assert [rows[float(b)]["count"] for b in (5, 10, 50, 100, 30000)] == [2, 3, 3, 4, 4]
    assert (rows[float("inf")]["count"], rows[5.0].total, rows[5.0].sum_ms) == (5, 5, 40_112)
    assert m.skew_quantile(trades, 0.5).first().skew_ms == 6
    assert m.histogram_quantile(m.skew_histogram(trades), 0.4).first().value == 5
    assert m.histogram_quantile(m.skew_histogram(trades), 0.5).first().value == 7.5
    assert m.histogram_quantile(m.skew_histogram(trades), 0.99).first().value == 30000


def test_freshness(make_trades, spark):
    trades = make_trades([(1700000000000, 1, 1)])
    check = lambda ms: m.freshness(trades, "event_time", F.lit(at(1700000000000 + ms))).first()
    assert (check(5_000).freshness_seconds, check(5_000).slo_ok, check(120_000).slo_ok) == (5.0, True, False)
    with pytest.raises(Exception, match="empty table"):
        m.freshness(trades.limit(0), "event_time", F.current_timestamp()).collect()


def offsets(spark, name, *rows):
    return spark.createDataFrame(list(rows), f"topic string, partition int, {name} bigint")


@pytest.mark.parametrize("position, end, expected", [
    ([(0, 10), (1, 5)], [(0, 10), (1, 5)], True),
    ([(0, 9)], [(0, 10)], False),
    ([(0, 15)], [(0, 10)], True),
    ([], [(0, 0)], True),
    ([(0, 10), (1, 3)], [(0, 10), (1, 5)], False),
    ([], [], True),
    ([(0, 10)], [(0, 10), (1, 1)], False),
])
def test_caught_up(spark, position, end, expected):
    positions = offsets(spark, "next_offset", *[("t", *p) for p in position])
    ends = offsets(spark, "high_watermark", *[("t", *e) for e in end])
    assert m.caught_up(positions, ends).first().caught_up is expected


def test_lag_counters_and_slos(spark, make_trades):
    ends = offsets(spark, "high_watermark", ("t", 0, 10), ("t", 1, 4), ("t", 2, 7))
    positions = offsets(spark, "next_offset", ("t", 0, 3), ("t", 1, 9))
    assert {r.partition: r.lag for r in m.consumer_lag(ends, positions).collect()} == {0: 7, 1: 0, 2: 7}
    trades = make_trades([(1, 1, 1), (2, 1, 1), (3, 1, 1, "ETH-USD")])
    assert {r.symbol: r.events for r in m.throughput(trades).collect()} == {"BTC-USD": 2, "ETH-USD": 1}
    measures = spark.createDataFrame([("freshness", 61.0), ("consumer_lag", 10_000.0)], "metric string, value double")
    assert {r.metric: r.ok for r in m.evaluate_slos(measures).collect()} == {"freshness": False, "consumer_lag": True}


def test_hourly_checks_report_every_failure(spark, make_trades, tmp_path):
    from tidemark.operators import lake

    root = str(tmp_path / "lake")
    for table in schemas.LAKE_TABLES:
        lake.ensure_table(spark, root, table)
    trades = make_trades([(1700000040000, 100, 0.5), (1700000041000, 200, 0.5)])
    lake.write_batch(trades, root, schemas.TRADES_TABLE, 0)
    lake.write_batch(c.candles(trades, "M1").withColumn("kafka_offset", F.lit(0)), root, schemas.CANDLES_TABLE, 0)
    report = hourly_checks(spark, root, str(tmp_path / "marts"))
    assert report.failed == [] and len(report.passed) == 66 and report.copied == {"bronze.trades": 2, "silver.candles": 1}
    assert spark.read.parquet(str(tmp_path / "marts/fct_symbol_daily")).count() == 1
    assert spark.read.parquet(str(tmp_path / "marts/fct_trade")).agg(F.sum("notional")).first()[0] == 150
    bad = make_trades([(1700000050000, -5, 1)]).withColumn("trade_id", F.lit("99"))
    lake.write_batch(bad, root, schemas.TRADES_TABLE, 1)
    report = hourly_checks(spark, root, str(tmp_path / "marts"))
    assert report.failed == ["fct_trade positive values", "trade check min_price", "trade check min_notional"]


def test_seals_follow_the_newest_event_of_all_symbols(spark, make_trades):
    """Against a walk over the arrivals in order."""
    import random

    rng = random.Random(4)
    rows = [(1700000040000 + rng.randrange(0, 900_000), 1, 1, rng.choice(["BTC-USD", "ETH-USD"]), rng.randrange(0, 40_000)) for _ in range(200)]
    trades = make_trades(rows)
    ends = {(ms // 60_000 + 1) * 60_000 for ms, *_ in rows}
    newest, want = 0, dict.fromkeys(ends)
    for ms, _, _, _, delay in sorted(rows, key=lambda r: r[0] + r[4]):
        newest = max(newest, ms)
        for end in ends:
            if want[end] is None and newest >= end + 10_000:
                want[end] = ms + delay
    for segment in (60, 3600):
        got = {ms_of(r.window_end): r.sealed_at and ms_of(r.sealed_at) for r in m.seal_instants(trades, "M1", segment).collect()}
        assert got == want and None in want.values()
    late = sorted(sealed - end for end, sealed in want.items() if sealed)
    seconds = m.seal_latency(m.seal_instants(trades), 1.0).first().seconds
    assert seconds == late[-1] / 1000
    assert m.seal_latency(m.seal_instants(trades.limit(0))).first().seconds is None


def test_sketches_merge_to_any_span(make_trades):
    rows = [(1700000000000 + 700 * i, 1, 1, "BTC-USD", i * 37 % 5000, ("binance", "coinbase")[i % 3 == 0]) for i in range(3000)]
    sketches = m.skew_sketches(make_trades(rows)).cache()
    assert sketches.count() > 8 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 4000
    for exchange, n, value in sorted(tuple(r) for r in m.merged_quantile(sketches, ["exchange"]).collect()):
        skews = sorted(r[4] for r in rows if r[5] == exchange)
        below, up_to = (sum(s < value for s in skews) / n, sum(s <= value for s in skews) / n)
        assert len(skews) == n and below <= 0.99 + m.SKETCH_RANK_ERROR and up_to >= 0.99 - m.SKETCH_RANK_ERROR
    halves = m.merged_quantile(sketches, ["exchange", (F.unix_seconds("ts") % 600 == 0).alias("even")])
    assert halves.agg(F.sum("n")).first()[0] == 3000


def test_symbols_and_elements_evolve(spark):
    field, text = T.StructField, T.StringType()
    enum = lambda *symbols: T.StructType([field("s", text, False, {"symbols": list(symbols)})])
    assert q.backward_compatible(enum("A"), enum("A", "B"))
    assert q.incompatibilities(enum("A", "B", "C"), enum("B")) == ["s: symbol A removed", "s: symbol C removed"]
    plain = T.StructType([field("s", text, False)])
    assert not q.backward_compatible(enum("A"), plain) and not q.backward_compatible(plain, enum("A"))
    inner = lambda *fields: T.StructType([field("x", T.ArrayType(T.StructType([field("a", T.IntegerType(), False), *fields]), False), False)])
    old, new = inner(), inner(field("b", text, False, {"default": "z"}))
    assert q.backward_compatible(old, new) and not q.backward_compatible(old, inner(field("b", text, False)))
    rows = spark.createDataFrame([([(1,), (2,)],), ([],), (None,)], "x array<struct<a int>>")
    assert [[tuple(e) for e in r.x] if r.x is not None else None for r in q.upgrade(rows, new).collect()] == [[(1, "z"), (2, "z")], [], None]


def test_row_differences(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b")], "k int, v string")
    right = spark.createDataFrame([(1, None), (2, "a"), (3, "c"), (3, "c")], "k int, v string")
    assert sorted(map(repr, map(tuple, q.row_differences(left, right).collect()))) == [
        "(1, None, 1, 0)", "(3, 'b', 1, 0)", "(3, 'c', 0, 2)"]
    assert q.row_differences(left, left).isEmpty()

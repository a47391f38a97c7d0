import json

import pytest

from tests.conftest import at, ms_of
from tidemark.operators import parse
from tidemark.sources.seed import active_symbols, read_symbol_seed, resolve_canonical, ticker_map

INGEST = 1700000000250


@pytest.fixture
def frames(spark):
    def build(*bodies):
        rows = [(b if isinstance(b, str) else json.dumps(b), at(INGEST)) for b in bodies]
        return spark.createDataFrame(rows, "value string, ingest_time timestamp")

    return build


@pytest.fixture(scope="module")
def seed(spark):
    return read_symbol_seed(spark)


BINANCE_TRADE = {"stream": "solusdt@trade", "data": {
    "e": "trade", "E": 1712345678905, "s": "SOLUSDT", "t": 9_007_001, "p": "173.4375", "q": "12.5",
    "T": 1712345678901, "m": False}}


def binance(**changes):
    """The sample with fields changed, or left out where the change is None."""
    return {"stream": "x", "data": {k: v for k, v in {**BINANCE_TRADE["data"], **changes}.items() if v is not None}}


def trades_of(frames, seed, reader, *bodies):
    return {r.trade_id: r for r in parse.known_trades(parse.resolve(reader(frames(*bodies)), seed)).collect()}


def test_binance_trade(frames, seed):
    rows = trades_of(
        frames, seed, parse.binance_trades,
        BINANCE_TRADE, binance(m=True, t=9_007_002), {"id": 77, "result": None}, "{broken", binance(t=9_007_003, m=None),
    )
    assert {"9007001", "9007002"} <= set(rows) <= {"9007001", "9007002", "9007003"}
    row = rows["9007001"]
    assert (row.exchange, row.symbol, row.side, row.price, row.quantity) == ("binance", "SOL-USD", "BUY", 173.4375, 12.5)
    assert (ms_of(row.event_time), ms_of(row.ingest_time)) == (1712345678901, INGEST)
    assert rows["9007002"].side == "SELL"


def test_unknown_symbols_are_counted(frames, seed):
    df = frames(BINANCE_TRADE, *[binance(s="ADAEUR", t=n) for n in range(3)])
    resolved = parse.resolve(parse.binance_trades(df), seed)
    assert [r.trade_id for r in parse.known_trades(resolved).collect()] == ["9007001"]
    assert [tuple(r) for r in parse.dropped_counts(resolved).select("exchange", "reason", "dropped").collect()] == [
        ("binance", "unknown_symbol", 3)]


def test_binance_depth(frames, seed):
    full = {"data": {"e": "depthUpdate", "E": 1712345679333, "s": "XRPUSDT", "U": 7021, "u": 7038,
                     "b": [["0.6125", "4000"], ["0.6000", "0"]], "a": [["0.6250", "150.5"]]}}
    without_levels = {"data": {"e": "depthUpdate", "E": 5, "s": "BTCUSDT", "U": 31, "u": 31}}
    df = frames(without_levels, BINANCE_TRADE, full)
    rows = {r.symbol: r for r in parse.known_deltas(parse.resolve(parse.binance_depth(df), seed)).collect()}
    assert set(rows) == {"XRP-USD", "BTC-USD"}
    row = rows["XRP-USD"]
    assert (row.first_update_id, row.final_update_id, ms_of(row.event_time)) == (7021, 7038, 1712345679333)
    assert [tuple(x) for x in row.bids] == [(0.6125, 4000.0), (0.6, 0.0)] and [tuple(x) for x in row.asks] == [(0.625, 150.5)]
    assert rows["BTC-USD"].bids == [] and rows["BTC-USD"].asks == []


def test_coinbase_trades(frames, seed):
    def trade(number, **changes):
        whole = {"trade_id": number, "product_id": "DOGE-USD", "price": "0.1875", "size": "640", "side": "SELL",
                 "time": "2024-04-05T19:34:38.765432Z", **changes}
        return {k: v for k, v in whole.items() if v is not None}

    body = {"channel": "market_trades", "events": [
        {"type": "update", "trades": [trade(31), trade(32, side="sideways"), trade(33, side=None)]},
        {"type": "snapshot", "trades": [trade(34)]},
    ]}
    rows = trades_of(frames, seed, parse.coinbase_trades, {"channel": "heartbeats", "events": []}, {"channel": "market_trades"}, body)
    assert set(rows) == {"31", "32", "33"}  # a snapshot repeats what is known
    row = rows["31"]
    assert (row.symbol, row.price, row.quantity, row.side) == ("DOGE-USD", 0.1875, 640.0, "SELL")
    assert [rows[n].side for n in ("32", "33")] == ["UNKNOWN", "UNKNOWN"]
    assert ms_of(row.event_time) == 1712345678765


def test_coinbase_l2(frames, seed):
    def event(product, kind="update"):
        updates = [{"side": s, "price_level": p, "new_quantity": q} for s, p, q in
                   (("offer", "66012.5", "0.25"), ("bid", "66010", "0"), ("bid", "66009.5", "1.125"))]
        return {"type": kind, "product_id": product, "updates": updates}

    df = frames(
        {"channel": "l2_data", "sequence_num": 812, "timestamp": "2024-04-05T19:34:39Z",
         "events": [event("BTC-USD", "snapshot"), event("BTC-USD")]},
        {"channel": "l2_data", "events": [event("ETH-USD")]},
    )
    found = parse.known_deltas(parse.resolve(parse.coinbase_l2(df), seed)).collect()
    rows = {r.symbol: r for r in found}
    assert len(found) == 2
    row = rows["BTC-USD"]
    assert (row.first_update_id, row.final_update_id, len(row.bids), len(row.asks)) == (812, 812, 2, 1)
    assert ms_of(row.event_time) == 1712345679000
    assert (rows["ETH-USD"].final_update_id, ms_of(rows["ETH-USD"].event_time)) == (0, INGEST)


def test_iso_to_ms(spark):
    df = spark.createDataFrame([("2024-04-05T19:34:38.7659Z",), ("yesterday",), (None,)], "t string")
    assert [r[0] for r in df.select(parse.iso_to_ms("t")).collect()] == [1712345678765, None, None]


def test_seed(spark, seed, tmp_path):
    assert active_symbols(seed).count() == 5 == seed.count()
    for row in ticker_map(seed).collect():
        event = spark.createDataFrame([(row.exchange, row.ticker)], "exchange string, ticker string")
        assert resolve_canonical(event, seed).first().symbol == row.canonical
    path = tmp_path / "symbols.csv"
    path.write_text("canonical,base,quote,binance_symbol,coinbase_symbol,active\nA-B,A,B,AB,A-B, TRUE \nC-B,C,B,CB,C-B,no\n")
    assert [r.canonical for r in active_symbols(read_symbol_seed(spark, str(path))).collect()] == ["A-B"]


def test_seed_lookup_broadcasts_the_seed(frames, seed):
    plan = parse.resolve(parse.binance_trades(frames(BINANCE_TRADE)), seed)._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and plan.count("from_json") == 1

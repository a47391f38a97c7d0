import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def at(ms):
    """Epoch milliseconds as an instant."""
    return EPOCH + timedelta(milliseconds=ms)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TRADE_COLUMNS = (
    "trade_id string, exchange string, symbol string, price double, quantity double, side string, "
    "event_time timestamp, ingest_time timestamp, kafka_offset bigint"
)


@pytest.fixture
def make_trades(spark):
    def build(rows):
        """rows: (event ms, price, quantity[, symbol[, ingest delay ms[, exchange]]])"""
        data = []
        for n, row in enumerate(rows):
            ms, price, quantity, *rest = row
            symbol = rest[0] if rest else "BTC-USD"
            delay = rest[1] if len(rest) > 1 else 0
            exchange = rest[2] if len(rest) > 2 else "binance"
            data.append((str(n + 1), exchange, symbol, float(price), float(quantity), "BUY", at(ms), at(ms + delay), n))
        return spark.createDataFrame(data, TRADE_COLUMNS)

    return build


def ms_of(value):
    """Instant of a collected timestamp as epoch milliseconds."""
    return round(value.timestamp() * 1000)

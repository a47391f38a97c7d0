"""Symbol seed: the traded universe and its ticker on each exchange."""

from __future__ import annotations

from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas


def read_symbol_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed with a boolean ``active``. Without ``path`` the packaged seed is used.

    The packaged file travels as a local relation: executors need no access to the driver's disk
    and Catalyst knows its exact size when it picks a join.
    """
    if path is None:
        text = files("tidemark").joinpath("seeds/symbols.csv").read_text(encoding="utf-8")
        lines = [line for line in text.splitlines()[1:] if line.strip()]
        ddl = ", ".join(f"{f.name} string" for f in schemas.SYMBOL.fields)
        rows = (
            spark.createDataFrame(pa.table({"line": lines}))
            .select(F.from_csv("line", ddl).alias("row"))
            .select("row.*")
        )
    else:
        rows = spark.read.schema(schemas.SYMBOL).csv(path, header=True)
    return rows.withColumn("active", F.lower(F.trim("active")) == "true")


def active_symbols(seed: DataFrame) -> DataFrame:
    return seed.filter("active")


def ticker_map(seed: DataFrame) -> DataFrame:
    """(exchange, ticker, canonical): one row per exchange a symbol trades on."""
    return seed.select(
        F.expr("stack(2, 'binance', binance_symbol, 'coinbase', coinbase_symbol) AS (exchange, ticker)"),
        "canonical",
    ).filter("ticker IS NOT NULL")


def resolve_canonical(events: DataFrame, seed: DataFrame) -> DataFrame:
    """Add ``symbol`` from (exchange, ticker); null where the ticker is not in the seed.

    No broadcast hint: the seed's size is known to Catalyst, which broadcasts it while it is
    under the session's threshold and shuffles otherwise.
    """
    tickers = ticker_map(seed).withColumnRenamed("canonical", "symbol")
    return events.join(tickers, ["exchange", "ticker"], "left")

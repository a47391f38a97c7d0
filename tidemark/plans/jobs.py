"""The hourly job: copy the lake, build the marts, run every data test and check on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.operators import lake, marts, quality as q
from tidemark.sources.seed import read_symbol_seed


@dataclass
class Report:
    copied: dict[str, int] = field(default_factory=dict)
    passed: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    #: The stage whose tests failed; the stages after it were not run.
    stopped: str | None = None


MARTS = ("dim_symbol", "fct_trade", "fct_candle", "fct_symbol_daily")


def build_marts(spark: SparkSession, trades: DataFrame, candles: DataFrame, target: str) -> dict[str, DataFrame]:
    """Write the marts as tables and return them as read back. Later marts read the earlier ones."""
    def table(name: str, rows: DataFrame) -> DataFrame:
        path = f"{target.rstrip('/')}/{name}"
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    built = {
        "dim_symbol": table("dim_symbol", marts.dim_symbol(read_symbol_seed(spark))),
        "fct_trade": table("fct_trade", marts.fct_trade(trades)),
        "fct_candle": table("fct_candle", marts.fct_candle(candles)),
    }
    built["fct_symbol_daily"] = table("fct_symbol_daily", marts.fct_symbol_daily(built["fct_candle"]))
    return built


def _missing(*columns: str) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNull() for c in columns}


def _outside(column: str, values: Sequence) -> dict[str, Column]:
    return {f"{column} accepted": F.col(column).isNotNull() & ~F.col(column).isin(*values)}


def _row_tests() -> dict[str, dict[str, Column]]:
    """Tests of single rows: table, name, and what holds for a row that fails."""
    both = [True, False]
    return {
        "symbols": _missing("canonical", "base", "quote", "active") | _outside("active", both),
        "stg_trades": _missing("trade_id", "exchange", "symbol", "price", "event_time")
        | _outside("exchange", schemas.EXCHANGES) | _outside("side", schemas.SIDES),
        "stg_candles": _missing("symbol", "interval", "window_start")
        | _outside("interval", tuple(schemas.INTERVALS)) | _outside("is_final", [True]),
        "dim_symbol": _missing("symbol", "base_asset", "quote_asset") | _outside("is_active", both),
        "fct_trade": _missing("trade_id", "exchange", "symbol", "price", "quantity", "notional", "event_time", "ingest_time")
        | _outside("exchange", schemas.EXCHANGES) | _outside("side", schemas.SIDES)
        | {"positive values": (F.col("price") <= 0) | (F.col("quantity") <= 0)},
        "fct_candle": _missing("symbol", "interval", "window_start", "trade_count")
        | _outside("interval", tuple(schemas.INTERVALS)) | _outside("direction", schemas.DIRECTIONS)
        | {"ohlc": q.breaks_ohlc()},
        "fct_symbol_daily": _missing("symbol", "trade_date", "volume") | {"ohlc": q.breaks_ohlc()},
    }


_KEYS = {
    "symbols": ("canonical",), "dim_symbol": ("symbol",), "fct_trade": schemas.TRADES_TABLE.keys,
    "fct_candle": schemas.CANDLES_TABLE.keys, "fct_symbol_daily": ("symbol", "trade_date"),
}
_OF_SYMBOL = ("fct_trade", "fct_candle", "fct_symbol_daily")


_CHECKS = {
    "trade": ("row_count", "missing_trade_id", "duplicate_trade_id", "min_price", "min_quantity", "min_notional",
              "invalid_exchange", "missing_event_time"),
    "candle": ("row_count", "missing_symbol", "missing_interval", "invalid_interval", "min_trade_count",
               "ohlc_inconsistent", "minute_gaps"),
}


def test_names() -> list[str]:
    """Names of all tests, in plain text: building the conditions needs a session."""
    rows = {
        "symbols": ("canonical not null", "base not null", "quote not null", "active not null", "active accepted"),
        "stg_trades": ("trade_id not null", "exchange not null", "symbol not null", "price not null", "event_time not null",
                       "exchange accepted", "side accepted"),
        "stg_candles": ("symbol not null", "interval not null", "window_start not null", "interval accepted", "is_final accepted"),
        "dim_symbol": ("symbol not null", "base_asset not null", "quote_asset not null", "is_active accepted"),
        "fct_trade": ("trade_id not null", "exchange not null", "symbol not null", "price not null", "quantity not null",
                      "notional not null", "event_time not null", "ingest_time not null", "exchange accepted", "side accepted",
                      "positive values"),
        "fct_candle": ("symbol not null", "interval not null", "window_start not null", "trade_count not null",
                       "interval accepted", "direction accepted", "ohlc"),
        "fct_symbol_daily": ("symbol not null", "trade_date not null", "volume not null", "ohlc"),
    }
    names = [f"{table} {name}" for table, own in rows.items() for name in own]
    names += [f"{table} key unique" for table in _KEYS] + [f"{table} symbol known" for table in _OF_SYMBOL]
    return names + [f"{kind} check {name}" for kind, own in _CHECKS.items() for name in own]


def check_results(tables: dict[str, DataFrame]) -> DataFrame:
    """(test, failures, passed) of every data test and check of the chain.

    ``tables`` has the marts, the seed as ``symbols``, and the staged ``stg_trades`` and ``stg_candles``, or some of
    these: tests of the others are left out. All row tests of a table are counted in one pass; keys and references take one each.
    """
    def one(name: str, failing: DataFrame) -> DataFrame:
        return failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")

    parts = []
    for table, tests in _row_tests().items():
        if table not in tables:
            continue
        totals = tables[table].agg(*[F.count_if(failing).alias(name) for name, failing in tests.items()])
        rows = F.array(*[F.struct(F.lit(f"{table} {n}").alias("test"), F.col(f"`{n}`").alias("failures")) for n in tests])
        parts.append(totals.select(F.inline(rows)))
    for table in (t for t in _KEYS if t in tables):
        parts.append(one(f"{table} key unique", q.unique_combination(tables[table], _KEYS[table])))
    for table in (t for t in _OF_SYMBOL if t in tables):
        parts.append(one(f"{table} symbol known", q.relationships(tables[table], "symbol", tables["dim_symbol"], "symbol")))
    for name, table, check in (("trade", "fct_trade", q.trade_checks), ("candle", "fct_candle", q.candle_checks)):
        if table not in tables:
            continue
        parts.append(check(tables[table]).select(
            F.concat(F.lit(f"{name} check "), "check_name").alias("test"),
            F.when(F.col("passed"), 0).when(F.col("check_name") == "minute_gaps", F.col("value")).otherwise(1).cast("bigint").alias("failures"),
        ))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def hourly_checks(spark: SparkSession, root: str, target: str) -> Report:
    """Run the chain on the lake at ``root``; copies and marts go to ``target``. Every test is run and reported."""
    report = Report()
    report.copied = lake.refresh_copy(spark, root, f"{target.rstrip('/')}/copy")
    trades, candles = (
        spark.read.schema(table.schema).parquet(f"{target.rstrip('/')}/copy/{table.name.replace('.', '/')}")
        for table in (schemas.TRADES_TABLE, schemas.CANDLES_TABLE)
    )
    tables = build_marts(spark, trades, candles, target) | {
        "symbols": read_symbol_seed(spark), "stg_trades": marts.staged_trades(trades), "stg_candles": marts.staged_candles(candles),
    }
    for row in check_results(tables).collect():  # one row for each test
        (report.passed if row["passed"] else report.failed).append(row["test"])
    return report


# --- by touched days ------------------------------------------------------------------------------

#: Marts of facts and the column of their days.
DAY_OF_MART = {"fct_trade": "event_date", "fct_candle": "window_date", "fct_symbol_daily": "trade_date"}


def mart_path(target: str, name: str) -> str:
    return f"{target.rstrip('/')}/{name}"


def read_mart(spark: SparkSession, target: str, name: str) -> DataFrame:
    return spark.read.parquet(mart_path(target, name))


def build_days(spark: SparkSession, copy: str, target: str, days: dict[str, DataFrame]) -> None:
    """Build the marts of the days in ``days`` (lake table to its touched days) anew; other days are not read.

    Every fact of a mart follows from rows of its own day, so a day built anew is whole.
    """
    marts.dim_symbol(read_symbol_seed(spark)).coalesce(1).write.mode("overwrite").parquet(mart_path(target, "dim_symbol"))

    def touched(table: schemas.LakeTable) -> DataFrame:
        return lake.read_copy(spark, copy, table).join(days[table.name], table.day_column, "left_semi").drop(table.day_column)

    if (table := schemas.TRADES_TABLE).name in days:
        lake.overwrite_days(marts.fct_trade(touched(table)), mart_path(target, "fct_trade"), DAY_OF_MART["fct_trade"])
    if (table := schemas.CANDLES_TABLE).name in days:
        day = DAY_OF_MART["fct_candle"]
        lake.overwrite_days(marts.fct_candle(touched(table)), mart_path(target, "fct_candle"), day)
        changed = days[table.name].withColumnRenamed(table.day_column, day)
        fct = read_mart(spark, target, "fct_candle").join(changed, day, "left_semi")
        lake.overwrite_days(marts.fct_symbol_daily(fct), mart_path(target, "fct_symbol_daily"), DAY_OF_MART["fct_symbol_daily"])


def _test(report: Report, stage: str, tables: dict[str, DataFrame]) -> bool:
    for row in check_results(tables).collect():  # one row for each test
        (report.passed if row["passed"] else report.failed).append(row["test"])
    report.stopped = stage if report.failed else None
    return not report.failed


def hourly_run(spark: SparkSession, root: str, target: str) -> Report:
    """Copy, test what is staged, build the marts, test and check them; a stage with a failed test is the last one.

    Copies and marts under ``target`` are kept from run to run, and a run rewrites the days that were touched since.
    Where the staged tables fail, the marts stay as the last good run left them; days that they lack then are
    built by the next good run, as the marts note for themselves how far they have come.
    """
    report, copy, built = Report(), f"{target.rstrip('/')}/copy", f"{target.rstrip('/')}/marts"
    report.copied = {name: c.rows for name, c in lake.refresh_days(spark, root, copy).items()}
    trades, candles = (lake.read_copy(spark, copy, t).drop(t.day_column) for t in schemas.LAKE_TABLES)
    staged = {
        "symbols": read_symbol_seed(spark), "stg_trades": marts.staged_trades(trades), "stg_candles": marts.staged_candles(candles),
    }
    if not _test(report, "staging", staged):
        return report
    days, through = {}, {}
    for table in schemas.LAKE_TABLES:
        since, last = (lake.noted(spark, path, table) for path in (built, copy))
        if last > since:
            days[table.name], through[table.name] = lake.touched_days(spark, root, table, since, last), last
    build_days(spark, copy, built, days)
    lake.note(spark, built, through)
    _test(report, "marts", {name: read_mart(spark, built, name) for name in MARTS})
    return report

"""Data tests and contract checks. Each test returns the failing rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import schemas
from tidemark.operators.segments import calendar_segment, running_max


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose ``column`` has no match in ``parent``."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return df.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def _consistent(open_: str, high: str, low: str, close: str) -> Column:
    o, h, l, c = (F.col(name) for name in (open_, high, low, close))
    return (l <= o) & (l <= c) & (h >= o) & (h >= c) & (h >= l)


OHLC_MART = ("open_price", "high_price", "low_price", "close_price")
OHLC_LAKE = ("open", "high", "low", "close")


def breaks_ohlc(columns: Sequence[str] = OHLC_MART) -> Column:
    return ~_consistent(*columns)


def ohlc_violations(df: DataFrame, columns: Sequence[str] = OHLC_MART) -> DataFrame:
    """Candles or daily rows that break low <= open, close <= high."""
    return df.filter(breaks_ohlc(columns))


def non_positive(df: DataFrame) -> DataFrame:
    return df.filter((F.col("price") <= 0) | (F.col("quantity") <= 0))


def minute_gaps(fct_candle: DataFrame) -> DataFrame:
    """Neighbouring M1 candles of a symbol more than a minute apart.

    The previous start is the running maximum of earlier starts, taken per month with a carry.
    """
    m1 = fct_candle.filter(F.col("interval") == "M1").select("symbol", "window_start")
    previous = running_max(
        m1, ["symbol"], "window_start", F.col("window_start"), calendar_segment("window_start"), "prev_window_start"
    )
    gap = F.floor(F.unix_seconds("window_start") / 60) - F.floor(F.unix_seconds("prev_window_start") / 60)
    return previous.withColumn("gap_minutes", gap).filter("gap_minutes > 1")


def _check_rows(totals: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One-row totals as (check_name, value, passed) rows."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(column).cast("double").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for name, column, passed in checks
    ])
    return totals.select(F.inline(rows))


def _none(column: str) -> Column:
    return F.col(column) == 0


def trade_checks(fct_trade: DataFrame) -> DataFrame:
    """Volume, completeness, uniqueness and range of the trade mart.

    All figures but one come from a pass without a shuffle; the count of repeated ids shuffles
    ids and counts only.
    """
    repeated = unique(fct_trade, "trade_id").agg(F.count(F.lit(1)).alias("n"))
    totals = fct_trade.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("trade_id").isNull()).alias("missing_trade_id"),
        F.min("price").alias("min_price"),
        F.min("quantity").alias("min_quantity"),
        F.min("notional").alias("min_notional"),
        F.count_if(F.col("exchange").isNotNull() & ~F.col("exchange").isin(*schemas.EXCHANGES)).alias("invalid_exchange"),
        F.count_if(F.col("event_time").isNull()).alias("missing_event_time"),
    ).withColumn("duplicate_trade_id", repeated.scalar())
    return _check_rows(totals, [
        ("row_count", "row_count", F.col("row_count") >= 1),
        ("missing_trade_id", "missing_trade_id", _none("missing_trade_id")),
        ("duplicate_trade_id", "duplicate_trade_id", _none("duplicate_trade_id")),
        ("min_price", "min_price", F.col("min_price") > 0),
        ("min_quantity", "min_quantity", F.col("min_quantity") > 0),
        ("min_notional", "min_notional", F.col("min_notional") > 0),
        ("invalid_exchange", "invalid_exchange", _none("invalid_exchange")),
        ("missing_event_time", "missing_event_time", _none("missing_event_time")),
    ])


def candle_checks(fct_candle: DataFrame) -> DataFrame:
    """Volume, completeness, ranges, OHLC order and minute gaps of the candle mart."""
    totals = fct_candle.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("symbol").isNull()).alias("missing_symbol"),
        F.count_if(F.col("interval").isNull()).alias("missing_interval"),
        F.count_if(F.col("interval").isNotNull() & ~F.col("interval").isin(*schemas.INTERVALS)).alias("invalid_interval"),
        F.min("trade_count").alias("min_trade_count"),
        F.count_if(~_consistent(*OHLC_MART)).alias("ohlc_inconsistent"),
    )
    gaps = minute_gaps(fct_candle).agg(F.count(F.lit(1)).alias("minute_gaps"))
    return _check_rows(totals.withColumn("minute_gaps", gaps.scalar()), [
        ("row_count", "row_count", F.col("row_count") >= 1),
        ("missing_symbol", "missing_symbol", _none("missing_symbol")),
        ("missing_interval", "missing_interval", _none("missing_interval")),
        ("invalid_interval", "invalid_interval", _none("invalid_interval")),
        ("min_trade_count", "min_trade_count", F.col("min_trade_count") >= 1),
        ("ohlc_inconsistent", "ohlc_inconsistent", _none("ohlc_inconsistent")),
        ("minute_gaps", "minute_gaps", _none("minute_gaps")),
    ])


# --- contracts --------------------------------------------------------------------------------

_ENUMS = {
    "trade": {"side": schemas.SIDES, "exchange": schemas.EXCHANGES},
    "candle": {"interval": tuple(schemas.INTERVALS)},
    "orderbook_delta": {"exchange": schemas.EXCHANGES},
    "anomaly": {"anomaly_type": schemas.ANOMALY_TYPES},
}


def _invariants(contract: str) -> dict[str, Column]:
    """Conditions that must hold, by the reason given when one does not."""
    if contract == "trade":
        return {"price not positive": F.col("price") > 0, "quantity not positive": F.col("quantity") > 0}
    if contract == "candle":
        return {"ohlc inconsistent": _consistent(*OHLC_LAKE)}
    if contract == "orderbook_delta":
        return {"final id before first": F.col("final_update_id") >= F.col("first_update_id")}
    return {}


def with_reject_reasons(rows: DataFrame, contract: str) -> DataFrame:
    """Cast to the contract's types and add ``reasons``: empty for rows that conform.

    A value that cannot be cast counts as such, a missing one as missing unless the contract
    gives a default.
    """
    schema = schemas.contract_schema(contract)
    reasons: list[Column] = []
    casts: dict[str, Column] = {}
    for field in schema.fields:
        raw = F.col(field.name) if field.name in rows.columns else F.lit(None)
        value, broken = _tried(raw, field.dataType)
        reasons.append(F.when(raw.isNotNull() & broken, f"{field.name} not {field.dataType.simpleString()}"))
        if "default" in field.metadata:
            value = F.when(raw.isNull(), F.lit(field.metadata["default"])).otherwise(value)
        elif not field.nullable:
            reasons.append(F.when(raw.isNull(), f"{field.name} missing"))
        casts[field.name] = value
    # The reasons read the raw columns, so they are taken before the casts replace these.
    typed = rows.withColumn("_cast_reasons", F.array_compact(F.array(*reasons))).withColumns(casts)
    later = [
        F.when(F.col(name).isNotNull() & ~F.col(name).isin(*values), f"{name} not accepted")
        for name, values in _ENUMS[contract].items()
    ]
    later += [F.when(~condition, reason) for reason, condition in _invariants(contract).items()]
    found = F.concat("_cast_reasons", F.array_compact(F.array(*later)))
    # Through a generator the reasons are worked out once and a filter on them stays above it.
    return typed.select(
        *[c for c in typed.columns if c != "_cast_reasons"], F.explode(F.array(found)).alias("reasons")
    )


def _tried(raw: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """The value in the type, and whether something in it could not be cast; lists are tried by their elements."""
    if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
        value = raw.try_cast(dtype)
        return value, value.isNull()
    fields = dtype.elementType.fields
    # The element keeps its nulls until they are known: a level of null or half a level is a reason.
    loose = F.transform(raw, lambda x: F.struct(*[x[f.name].try_cast(f.dataType).alias(f.name) for f in fields]))
    broken = F.exists(loose, lambda x: reduce(Column.__or__, [x[f.name].isNull() for f in fields if not f.nullable]))
    whole = F.transform(loose, lambda x: F.struct(*[
        x[f.name].alias(f.name) if f.nullable else F.coalesce(x[f.name], F.lit(0).cast(f.dataType)).alias(f.name) for f in fields
    ]))
    return F.when(~broken, whole), broken


def contract_check(rows: DataFrame, contract: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows in contract columns, rejected rows with ``reasons``)."""
    checked = with_reject_reasons(rows, contract)
    names = schemas.contract_schema(contract).fieldNames()
    valid = checked.filter(F.size("reasons") == 0).select(*names)
    return valid, checked.filter(F.size("reasons") > 0)


# Type changes a reader may apply to older data.
_PROMOTIONS = {
    ("int", "bigint"), ("int", "float"), ("int", "double"), ("bigint", "float"), ("bigint", "double"),
    ("float", "double"), ("string", "binary"), ("binary", "string"),
}


def incompatibilities(old: T.StructType | None, new: T.StructType) -> list[str]:
    """Why ``new`` cannot read data written with ``old``; empty if it can, or if ``old`` is None."""
    return [] if old is None else _struct_problems(old, new, "")


def _struct_problems(old: T.StructType, new: T.StructType, prefix: str) -> list[str]:
    before = {f.name: f for f in old.fields}
    problems = []
    for field in new.fields:
        name = prefix + field.name
        if field.name not in before:
            # What may be null has null as its default, here and in the Avro form.
            if "default" not in field.metadata and not field.nullable:
                problems.append(f"{name}: added without a default")
            continue
        problems += _type_problems(before[field.name].dataType, field.dataType, name)
        problems += _symbol_problems(before[field.name], field, name)
        if before[field.name].nullable and not field.nullable:
            problems.append(f"{name}: made required")
    return problems


def _symbol_problems(old: T.StructField, new: T.StructField, name: str) -> list[str]:
    """Enums (fields with ``symbols``) must know every symbol that was written, and do not mix with plain strings."""
    before, after = (f.metadata.get("symbols") for f in (old, new))
    if (before is None) != (after is None):
        return [f"{name}: an enum and a string cannot be read as each other"] if old.dataType == new.dataType else []
    return [f"{name}: symbol {s} removed" for s in before or () if s not in after]


def _type_problems(old: T.DataType, new: T.DataType, name: str) -> list[str]:
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return _type_problems(old.elementType, new.elementType, f"{name}[]")
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _struct_problems(old, new, f"{name}.")
    pair = (old.simpleString(), new.simpleString())
    if pair[0] != pair[1] and pair not in _PROMOTIONS:
        return [f"{name}: {pair[0]} cannot be read as {pair[1]}"]
    return []


def backward_compatible(old: T.StructType | None, new: T.StructType) -> bool:
    return not incompatibilities(old, new)


def upgrade(rows: DataFrame, new: T.StructType) -> DataFrame:
    """Older rows in the columns of ``new``, by name at every depth: promoted types, defaults for added fields."""
    return rows.select(*_read_fields(lambda name: F.col(f"`{name}`"), rows.schema, new))


def _read_fields(of, old: T.StructType, new: T.StructType) -> list[Column]:
    names = old.fieldNames()
    return [
        (_read_as(of(f.name), old[f.name].dataType, f.dataType) if f.name in names
         else F.lit(f.metadata.get("default")).cast(f.dataType)).alias(f.name)
        for f in new.fields
    ]


def _read_as(value: Column, old: T.DataType, new: T.DataType) -> Column:
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: _read_as(x, old.elementType, new.elementType))
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_read_fields(lambda name: value[name], old, new)))
    return value.cast(new)


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(rows of either table, ``only_left``, ``only_right``): how much more often a row stands in one than in the other.

    One aggregation over both; rows that stand in both equally often are left out. Nulls equal each other.
    """
    columns = left.columns
    both = left.withColumn("_in", F.lit(1)).unionByName(right.withColumn("_in", F.lit(-1)))
    more = both.groupBy(*columns).agg(F.sum("_in").alias("_more")).filter("_more != 0")
    return more.select(
        *columns, F.greatest("_more", F.lit(0)).alias("only_left"), F.greatest(-F.col("_more"), F.lit(0)).alias("only_right")
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows, as often, such as two copies of a seed."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


# --- sustained conditions ---------------------------------------------------------------------

#: A condition is known to hold only while its series is there: silence longer than this ends a stretch.
MAX_GAP_SECONDS = 300


def sustained_breaches(
    samples: DataFrame, keys: Sequence[str], threshold: float | Column, min_seconds: int = 300, unit: str = "month",
    max_gap_seconds: int = MAX_GAP_SECONDS,
) -> DataFrame:
    """Stretches of consecutive samples above ``threshold`` that last at least ``min_seconds``.

    ``samples`` has the keys, ``ts`` and ``value``. A sample that is no breach ends a stretch, and so
    does silence of more than ``max_gap_seconds``: nothing is known of that time. The breaches of one
    stretch share the instant that the last end before them leaves, which is a running maximum.
    """
    breach = F.coalesce(F.col("value") > threshold, F.lit(False))
    segment = calendar_segment("ts", unit)
    marked = running_max(samples.withColumn("_breach", breach), keys, "ts", F.col("ts"), segment, "_previous")
    silent = F.unix_millis("ts") - F.unix_millis("_previous") > 1000 * max_gap_seconds
    ends = F.when(~F.col("_breach"), F.col("ts")).when(silent, F.col("_previous"))
    named = running_max(marked, keys, "ts", ends, segment, "_last_end", inclusive=True)
    return (
        named.filter("_breach")
        .groupBy(*keys, "_last_end")
        .agg(
            F.min("ts").alias("breach_start"),
            F.max("ts").alias("breach_end"),
            F.count(F.lit(1)).alias("samples"),
            F.max("value").alias("peak"),
        )
        .drop("_last_end")
        .filter(F.unix_millis("breach_end") - F.unix_millis("breach_start") >= 1000 * min_seconds)
    )


def absences(
    samples: DataFrame, keys: Sequence[str], now: Column | None = None, max_seconds: int = 600, unit: str = "month"
) -> DataFrame:
    """Pauses of more than ``max_seconds`` between neighbouring samples of a key.

    With ``now``, a key that has been silent for longer until then has a row too, whose ``absent_until``
    is null and whose ``seconds`` run to ``now``. No such pause fits into a bucket of that length, so
    samples shrink to the first and last of each bucket before any ordering.
    """
    bucket = F.floor(F.unix_millis("ts") / (1000 * max_seconds))
    ends = samples.groupBy(*keys, bucket.alias("_bucket")).agg(
        F.min("ts").alias("absent_until"), F.max("ts").alias("_last")
    )
    previous = running_max(
        ends, keys, "_bucket", F.col("_last"), calendar_segment("absent_until", unit), "absent_from"
    )
    silence = F.unix_millis("absent_until") - F.unix_millis("absent_from")
    over = previous.filter(silence > 1000 * max_seconds).select(
        *keys, "absent_from", "absent_until", (silence / 1000.0).alias("seconds")
    )
    if now is None:
        return over
    newest = ends.groupBy(*keys).agg(F.max("_last").alias("absent_from")).withColumn("_now", now)
    silence = F.unix_millis("_now") - F.unix_millis("absent_from")
    going_on = newest.filter(silence > 1000 * max_seconds).select(
        *keys, "absent_from", F.lit(None).cast("timestamp").alias("absent_until"), (silence / 1000.0).alias("seconds")
    )
    return over.unionByName(going_on)

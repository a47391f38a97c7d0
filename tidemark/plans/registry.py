"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _zoneless(fn(spark, sf_dir))

        REGISTRY[name] = Query(run, sql)
        return fn

    return register


def _zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time, so that a reader's own time zone plays no part."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def settle(value: Column, digits: int = 6) -> Column:
    """Round a float whose last bit depends on summation order.

    The shift of a thousandth of a step keeps exact halves, common in averages of two-decimal
    prices, away from the rounding edge.
    """
    return F.round(value + F.lit(10.0 ** -(digits + 3)), digits)


def settle_sql(value: str, digits: int = 6) -> str:
    return f"round(({value}) + 1e-{digits + 3}, {digits})"

"""Ordered-window operators over long histories of few keys.

A window partitioned by symbol alone puts a whole history into one task. Here the history of a
key is cut into segments (a calendar month, a range of offsets); windows run per (key, segment)
and the little that crosses a segment border is carried in from a per-segment summary.
The results are those of the unsegmented window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SEGMENT = "_segment"
CARRIED = "_carried"
SEQUENCE_WIDTH = 1_000_000


def sequence_segment(column: str, width: int = SEQUENCE_WIDTH) -> Column:
    """Segments of ``width`` consecutive values of an integer column."""
    return F.expr(f"`{column}` DIV {int(width)}")


def calendar_segment(column: str, unit: str = "month") -> Column:
    return F.date_trunc(unit, F.col(column))


def _before(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)


def _with_summary(data: DataFrame, keys: Sequence[str], total: Column, running, name: str) -> DataFrame:
    """Join to each (key, segment) the ``running`` aggregate of ``total`` over earlier segments."""
    summary = data.groupBy(*keys, SEGMENT).agg(total.alias(name))
    by = [*keys, SEGMENT]
    summary = summary.select(*[F.col(k).alias(f"_of_{k}") for k in by], running(F.col(name)).over(_before(keys)).alias(name))
    match = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]  # a null key has its carry too
    return data.join(summary, match, "left").drop(*[f"_of_{k}" for k in by])


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Column | str,
    value: Column,
    segment: Column,
    name: str,
    inclusive: bool = False,
) -> DataFrame:
    """Largest ``value`` among the earlier rows of the key (with the row itself if ``inclusive``)."""
    data = df.withColumn(SEGMENT, segment).withColumn("_value", value)
    data = _with_summary(data, keys, F.max("_value"), F.max, "_carry")
    window = (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return data.withColumn(name, F.greatest("_carry", F.max("_value").over(window))).drop(
        SEGMENT, "_value", "_carry"
    )


def row_number_by_segment(
    df: DataFrame, keys: Sequence[str], order: Column | str, segment: Column, name: str
) -> DataFrame:
    """``row_number`` over the key, numbered in parallel per segment."""
    data = df.withColumn(SEGMENT, segment)
    data = _with_summary(data, keys, F.count(F.lit(1)), F.sum, "_carry")
    window = Window.partitionBy(*keys, SEGMENT).orderBy(order)
    number = F.coalesce("_carry", F.lit(0)) + F.row_number().over(window)
    return data.withColumn(name, number).drop(SEGMENT, "_carry")


def with_history(
    df: DataFrame, keys: Sequence[str], order: str, segment: Column, rows: int
) -> DataFrame:
    """Add to each segment the key's last ``rows`` rows before it, marked ``_carried``.

    A frame of at most ``rows`` preceding rows, partitioned by (keys, ``_segment``), is then
    complete for every row that is not carried.
    """
    data = df.withColumn(SEGMENT, segment)
    columns = data.columns
    newest = Window.partitionBy(*keys, SEGMENT).orderBy(F.col(order).desc())
    tails = data.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= rows)
    trailing = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - rows, 0)
    ends = tails.select(
        *keys,
        SEGMENT,
        "_rank",
        F.collect_list(F.struct(*[c for c in columns if c not in (*keys, SEGMENT)])).over(trailing).alias("_tail"),
    ).filter(F.col("_rank") == 1)
    following = F.lead(SEGMENT).over(Window.partitionBy(*keys).orderBy(SEGMENT))
    carried = (
        ends.select(*keys, following.alias(SEGMENT), "_tail")
        .filter(F.col(SEGMENT).isNotNull())
        .select(*keys, SEGMENT, F.inline("_tail"))
    )
    return data.withColumn(CARRIED, F.lit(False)).unionByName(carried.withColumn(CARRIED, F.lit(True)))


def without_history(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(CARRIED)).drop(CARRIED, SEGMENT)

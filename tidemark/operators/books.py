"""Sequence gaps in order-book deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.segments import SEQUENCE_WIDTH, running_max, sequence_segment

GAP_EXCHANGES = ("binance",)


def sequence_gaps(
    deltas: DataFrame,
    order: str = "kafka_offset",
    session: str | None = None,
    segment_width: int = SEQUENCE_WIDTH,
) -> DataFrame:
    """Check each delta against the highest final id seen before it in its stream.

    Only exchanges with one sequence per symbol are checked. ``session`` names a column that
    changes when a stream was reset; every session starts a new sequence. ``final >= first``
    makes the detector's state a running maximum, computed per offset range with a carry.
    """
    keys: Sequence[str] = ["exchange", "symbol", *([session] if session else [])]
    checked = running_max(
        deltas.filter(F.col("exchange").isin(*GAP_EXCHANGES)),
        keys,
        order,
        F.col("final_update_id"),
        sequence_segment(order, segment_width),
        "previous_final_id",
    )
    missing = F.col("first_update_id") - F.col("previous_final_id") - 1
    return checked.withColumns({
        "first_seen": F.col("previous_final_id").isNull(),
        "is_gap": F.coalesce(missing > 0, F.lit(False)),
        "missing": F.greatest(F.coalesce(missing, F.lit(0)), F.lit(0)),
    })


def gap_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("exchange", "symbol").agg(
        F.count(F.lit(1)).alias("deltas"),
        F.count_if("is_gap").alias("gaps"),
        F.sum("missing").alias("missing_ids"),
    )

"""Throughput, skew, freshness, lag and service-level figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import schemas
from tidemark.operators.candles import skew_ms
from tidemark.operators.quality import sustained_breaches
from tidemark.operators.segments import running_max

# Upper bounds of the histograms of skew and of commit time; a last bucket is open.
SKEW_BOUNDS_MS = (5, 10, 25, 50, 100, 250, 500, 1000, 5000, 30000)

COMMIT_BOUNDS_SECONDS = (0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30)

# Thresholds of the service levels.
SLO_THRESHOLDS = (
    ("freshness", "bronze.trades", 60.0),
    ("consumer_lag", "sink", 10000.0),
    ("serve_latency_p99", "api", 2.0),
    ("e2e_latency", "silver.candles", 5.0),
)
FRESHNESS_SECONDS = 60
ALERT_SECONDS = 300


def throughput(events: DataFrame) -> DataFrame:
    return events.groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("events"))


def cumulative_histogram(
    rows: DataFrame, keys: Sequence[str], value: Column, bounds: Sequence[float], sum_name: str
) -> DataFrame:
    """Cumulative buckets per key: (keys, le, count, total, sum). The open bucket has ``le`` Infinity.

    One pass with one aggregate per bound.
    """
    valued = rows.select(*keys, value.alias("_value"))
    wide = valued.groupBy(*keys).agg(
        F.count("_value").alias("total"),
        F.sum("_value").alias(sum_name),
        *[F.count_if(F.col("_value") <= b).alias(f"_le{n}") for n, b in enumerate(bounds)],
    )
    buckets = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_le{n}").alias("count")) for n, b in enumerate(bounds)]
    buckets.append(F.struct(F.lit(float("inf")).alias("le"), F.col("total").alias("count")))
    return wide.select(*keys, F.inline(F.array(*buckets)), "total", sum_name)


def skew_histogram(
    events: DataFrame, keys: Sequence[str] = ("exchange",), bounds: Sequence[int] = SKEW_BOUNDS_MS
) -> DataFrame:
    """Buckets of arrival skew per key."""
    return cumulative_histogram(events, keys, skew_ms(), bounds, "sum_ms")


def commit_histogram(commits: DataFrame, bounds: Sequence[float] = COMMIT_BOUNDS_SECONDS) -> DataFrame:
    """Buckets of the time a batch took, per table of a commit log."""
    appends = commits.filter(F.col("operation") == "append")
    return cumulative_histogram(appends, ["table_name"], F.col("seconds"), bounds, "sum_seconds")


def skew_quantile(events: DataFrame, q: float = 0.99) -> DataFrame:
    """Exact skew quantile per exchange, from which the lateness allowance is set.

    Skew is whole milliseconds, so rows are first counted per value; the quantile then runs over
    the distinct values only.
    """
    counted = (
        events.select("exchange", skew_ms().alias("skew")).groupBy("exchange", "skew").agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("exchange").agg(F.percentile("skew", q, F.col("n")).alias("skew_ms"))


# --- quantiles that merge -------------------------------------------------------------------------

#: Size of a sketch: about 3 KB, whatever it has seen.
SKETCH_K = 200
#: Fixed value: with that size the rank of an answer is within this share of the asked one (99 times of 100).
SKETCH_RANK_ERROR = 0.0133


def skew_sketches(events: DataFrame, keys: Sequence[str] = ("exchange",), size: str = "5 minutes") -> DataFrame:
    """(keys, ts, n, sketch): a quantile sketch of arrival skew per key and stretch of event time.

    Sketches are made map-side and merge, so they can be kept and any span be asked later without its events.
    """
    return events.groupBy(*keys, F.window("event_time", size)["start"].alias("ts")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(skew_ms(), F.lit(SKETCH_K)).alias("sketch")
    )


def merged_quantile(sketches: DataFrame, keys: Sequence[str | Column], q: float = 0.99) -> DataFrame:
    """(keys, n, value) of sketches merged over all that share the keys; ``value`` is off by SKETCH_RANK_ERROR in rank."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_K)).alias("_merged")).withColumn(
        "value", F.kll_sketch_get_quantile_bigint("_merged", F.lit(q))
    ).drop("_merged")


def histogram_quantile(histogram: DataFrame, q: float = 0.99, keys: Sequence[str] = ("exchange",)) -> DataFrame:
    """Quantile interpolated in cumulative buckets (keys, le, count), as monitoring systems do.

    In the open bucket the largest finite bound is returned.
    """
    ordered = Window.partitionBy(*keys).orderBy("le")
    spans = histogram.select(
        *keys,
        "le",
        "count",
        F.coalesce(F.lag("le").over(ordered), F.lit(0.0)).alias("lower"),
        F.coalesce(F.lag("count").over(ordered), F.lit(0)).alias("below"),
        (q * F.max("count").over(Window.partitionBy(*keys))).alias("rank"),
    )
    interpolated = F.col("lower") + (F.col("le") - F.col("lower")) * F.try_divide(
        F.col("rank") - F.col("below"), F.col("count") - F.col("below")
    )
    value = F.when(F.col("le") == float("inf"), F.col("lower")).otherwise(F.coalesce(interpolated, F.col("lower")))
    first = spans.filter((F.col("count") >= F.col("rank")) & (F.col("rank") > 0))
    return first.groupBy(*keys).agg(F.min_by(value, "le").alias("value"))


def freshness(table: DataFrame, time: str, now: Column, slo_seconds: float = FRESHNESS_SECONDS) -> DataFrame:
    """Seconds between ``now`` and the newest ``time``; an empty table raises."""
    newest = F.max(time)
    seconds = (F.unix_millis(now) - F.unix_millis("newest")) / 1000.0
    return (
        table.agg(newest.alias("newest"))
        .withColumn(
            "newest",
            F.when(F.col("newest").isNull(), F.raise_error(F.lit("freshness of an empty table")).cast("timestamp"))
            .otherwise(F.col("newest")),
        )
        .select("newest", seconds.alias("freshness_seconds"), (seconds <= slo_seconds).alias("slo_ok"))
    )


def seal_instants(trades: DataFrame, interval: str = "M1", segment_seconds: int = 3600) -> DataFrame:
    """(window_end, sealed_at): when each window with trades was sealed, null if it is open yet.

    A window is sealed by the first arrival at which the newest event time, of all symbols, has reached its end plus
    grace, so by the earliest arrival among the trades from that time on. Arrivals first shrink to one for each second of
    event time, as ends and graces are whole seconds; the earliest from a second on is then a running minimum back
    from the newest second, per segment with a carry.
    """
    i = schemas.INTERVALS[schemas.check_interval(interval)]
    second = F.floor(F.unix_millis("event_time") / 1000)
    arrivals = trades.groupBy(second.alias("at")).agg(F.min(F.unix_millis("ingest_time")).alias("arrived"))
    end = F.window("event_time", i.size)["end"]
    ends = trades.select(end.alias("window_end")).distinct().select(
        (F.unix_seconds("window_end") + i.grace_seconds).alias("at"), "window_end"
    )
    both = arrivals.withColumn("window_end", F.lit(None).cast("timestamp")).unionByName(ends, allowMissingColumns=True)
    back = F.struct(-F.col("at"), F.col("window_end").isNotNull())  # newest first; at one second arrivals before ends
    segment = -F.floor(F.col("at") / segment_seconds)
    earliest = running_max(both, [], back, -F.col("arrived"), segment, "_earliest", inclusive=True)
    return earliest.filter("window_end IS NOT NULL").select("window_end", F.timestamp_millis(-F.col("_earliest")).alias("sealed_at"))


def seal_latency(seals: DataFrame, q: float = 0.99) -> DataFrame:
    """One row, ``seconds``: the exact quantile of the time from a window's end to its seal, over windows that are sealed."""
    late = seals.filter("sealed_at IS NOT NULL").groupBy(
        (F.unix_millis("sealed_at") - F.unix_millis("window_end")).alias("ms")
    ).agg(F.count(F.lit(1)).alias("n"))
    return late.agg((F.percentile("ms", q, F.col("n")) / 1000.0).alias("seconds"))


def consumer_lag(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Unread records per (topic, partition): high-water mark minus next offset, at least 0."""
    return ends.join(positions, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        F.greatest(F.col("high_watermark") - F.coalesce("next_offset", F.lit(0)), F.lit(0)).alias("lag"),
    )


def caught_up(positions: DataFrame, ends: DataFrame) -> DataFrame:
    """One row: whether every non-empty partition has been read up to its high-water mark."""
    done = (F.col("high_watermark") <= 0) | (F.coalesce("next_offset", F.lit(0)) >= F.col("high_watermark"))
    return ends.join(positions, ["topic", "partition"], "left").agg(
        F.coalesce(F.bool_and(done), F.lit(True)).alias("caught_up")
    )


def sink_counters(commits: DataFrame) -> DataFrame:
    """Inserted rows, skipped duplicates, batches and failed batches per table of a commit log."""
    return commits.groupBy("table_name").agg(
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("duplicates"),
        F.count_if(F.col("operation") == "append").alias("batches"),
        F.count_if(F.col("operation") == "error").alias("errors"),
    )


def explanation_accounting(explanations: DataFrame) -> DataFrame:
    """Explained and pending rows and token sums per (symbol, anomaly type)."""
    explained = F.col("explained_at").isNotNull()
    return explanations.groupBy("symbol", "anomaly_type").agg(
        F.count_if(explained).alias("explained"),
        F.count_if(~explained).alias("pending"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
    )


def explanation_errors(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("error_kind").isNotNull()).groupBy("error_kind").agg(
        F.count(F.lit(1)).alias("errors")
    )


def evaluate_slos(measures: DataFrame, thresholds: Sequence[tuple[str, str, float]] = SLO_THRESHOLDS) -> DataFrame:
    """Compare measured values (metric, value) with their thresholds."""
    return with_thresholds(measures, thresholds).select(
        "metric", "subject", "value", "threshold", (F.col("value") <= F.col("threshold")).alias("ok")
    )


def slo_alerts(
    samples: DataFrame,
    thresholds: Sequence[tuple[str, str, float]] = SLO_THRESHOLDS,
    for_seconds: int = ALERT_SECONDS,
) -> DataFrame:
    """Stretches of samples (metric, ts, value) beyond their threshold for ``for_seconds`` or more."""
    judged = with_thresholds(samples, thresholds)
    return sustained_breaches(judged, ["metric", "subject"], F.col("threshold"), for_seconds)


def with_thresholds(measures: DataFrame, thresholds: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Add subject and threshold to the metrics that have one; a projection, not a join."""
    table = F.create_map(*[
        x for metric, subject, limit in thresholds
        for x in (F.lit(metric), F.struct(F.lit(subject).alias("subject"), F.lit(limit).alias("threshold")))
    ])
    limit = F.try_element_at(table, F.col("metric"))
    return measures.withColumns({"subject": limit["subject"], "threshold": limit["threshold"]}).filter(
        F.col("threshold").isNotNull()
    )

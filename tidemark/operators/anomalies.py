"""Spikes of price, volume and range against a rolling baseline of prior candles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.segments import SEGMENT, calendar_segment, with_history, without_history


@dataclass(frozen=True)
class AnomalyRules:
    """Baseline length, warm-up and thresholds."""

    window_size: int = 20
    min_samples: int = 5
    price_pct: float = 2.0
    volume_zscore: float = 3.0
    volatility_zscore: float = 3.0


BASELINE_KEYS = ("symbol", "interval")
BASELINE_INPUT = ("symbol", "interval", "window_start", "high", "low", "close", "volume")


def z_score(value: Column, mean: Column, deviation: Column, constant: Column) -> Column:
    """Sample z-score; 0 where the baseline has no deviation.

    ``constant`` (smallest equals largest) decides that case, because the mean of equal floats
    may be off by one bit.
    """
    score = F.try_divide(value - mean, deviation)
    return F.when(constant | deviation.isNull() | (deviation <= 0), F.lit(0.0)).otherwise(score)


def with_baseline(
    candles: DataFrame, rules: AnomalyRules = AnomalyRules(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Each candle with mean, deviation and count over the candles before it, and the last close.

    ``keep`` names further columns to carry along.
    The window runs per (symbol, interval, month) with the last candles of earlier months
    carried in, so a long history is spread over tasks.
    """
    # Only what the baseline reads: both passes of ``with_history`` then share one shuffle.
    data = candles.select(
        *BASELINE_KEYS, "window_start", "close", "volume", (F.col("high") - F.col("low")).alias("range"), *keep
    )
    data = with_history(
        data, BASELINE_KEYS, "window_start", calendar_segment("window_start"), rules.window_size
    )
    ordered = Window.partitionBy(*BASELINE_KEYS, SEGMENT).orderBy("window_start")
    prior = ordered.rowsBetween(-rules.window_size, -1)
    columns = {
        "prior_count": F.count(F.lit(1)).over(prior),
        "prev_close": F.lag("close").over(ordered),
    }
    for name in ("volume", "range"):
        columns[f"{name}_mean"] = F.avg(name).over(prior)
        columns[f"{name}_deviation"] = F.stddev_samp(name).over(prior)
        columns[f"{name}_constant"] = F.min(name).over(prior) == F.max(name).over(prior)
    return without_history(data.withColumns(columns))


def anomaly_id(*parts: Column) -> Column:
    """Id from the business key, so that a replay finds the same ids."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def score_candles(baseline: DataFrame, rules: AnomalyRules = AnomalyRules()) -> DataFrame:
    """0 to 3 anomaly rows per candle that has a baseline, in the order price, volume, range."""
    pct = F.abs(F.col("close") - F.col("prev_close")) / F.nullif("prev_close", F.lit(0.0)) * 100

    def spike(kind: str, hit: Column, severity: Column, current: str, base: str) -> Column:
        return F.when(
            hit,
            F.struct(
                F.lit(kind).alias("anomaly_type"),
                severity.alias("severity"),
                F.col(current).alias("current_value"),
                F.col(base).alias("baseline_value"),
            ),
        )

    def z_spike(kind: str, name: str, threshold: float) -> Column:
        score = z_score(
            F.col(name), F.col(f"{name}_mean"), F.col(f"{name}_deviation"), F.col(f"{name}_constant")
        )
        return spike(kind, score >= threshold, F.bround(score, 4), name, f"{name}_mean")

    spikes = F.array(
        spike(
            "PRICE_SPIKE",
            (F.col("prev_close") > 0) & (pct >= rules.price_pct),
            F.bround(pct / 100, 6),
            "close",
            "prev_close",
        ),
        z_spike("VOLUME_SPIKE", "volume", rules.volume_zscore),
        z_spike("VOLATILITY_SPIKE", "range", rules.volatility_zscore),
    )
    return (
        baseline.filter(F.col("prior_count") >= rules.min_samples)
        .select("symbol", "interval", "window_start", F.explode(F.array_compact(spikes)).alias("spike"))
        .select(
            anomaly_id(
                F.col("symbol"),
                F.col("interval"),
                F.unix_millis("window_start").cast("string"),
                F.col("spike.anomaly_type"),
            ).alias("anomaly_id"),
            "symbol",
            "spike.*",
            F.col("window_start").alias("candle_window_start"),
            F.col("interval").alias("candle_interval"),
        )
    )


def detect_anomalies(
    candles: DataFrame, rules: AnomalyRules = AnomalyRules(), detected_at: Column | None = None
) -> DataFrame:
    """Anomaly events of ``candles`` (symbol, interval, window_start, high, low, close, volume)."""
    found = score_candles(with_baseline(candles, rules), rules)
    return found.withColumn("detected_at", F.current_timestamp() if detected_at is None else detected_at)


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("symbol", "anomaly_type").agg(F.count(F.lit(1)).alias("anomalies"))


def candles_processed(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(F.count(F.lit(1)).alias("candles_processed"))

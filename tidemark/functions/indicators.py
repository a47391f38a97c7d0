"""Scalar indicators served next to prices: tiers, labels, positions and ages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Severity tiers from the highest bound down, labels of anomaly types, ages in seconds.
SEVERITY_TIERS = ((10, "critical"), (5, "high"), (3, "moderate"))
ANOMALY_LABELS = {
    "VOLUME_SPIKE": "Pico de volume",
    "PRICE_SPIKE": "Salto de preço",
    "PRICE_DROP": "Queda de preço",
    "VOLATILITY_SPIKE": "Pico de volatilidade",
    "SPREAD_WIDENING": "Alargamento de spread",
}
FRESH_SECONDS = 90
AGING_SECONDS = 300


def severity_tier(severity: Column) -> Column:
    tier = F.lit("info")
    for bound, name in reversed(SEVERITY_TIERS):
        tier = F.when(severity >= bound, name).otherwise(tier)
    return tier


def anomaly_type_label(kind: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in ANOMALY_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, kind), F.lower(F.replace(kind, F.lit("_"), F.lit(" "))))


def multiple_of_baseline(current: Column, baseline: Column) -> Column:
    return F.try_divide(current, baseline)


def _clamped_position(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(value - low, high - low)))


def range_position(price: Column, low: Column, high: Column) -> Column:
    """Where the price lies in [low, high], 0 to 1; null for an empty range."""
    return F.when(price.isNotNull() & (high > low), _clamped_position(price, low, high))


def vwap_premium_pct(price: Column, vwap: Column) -> Column:
    return F.try_divide(price - vwap, vwap) * 100


def window_progress(now: Column, start: Column, end: Column) -> Column:
    position = _clamped_position(
        F.unix_millis(now).cast("double"),
        F.unix_millis(start).cast("double"),
        F.unix_millis(end).cast("double"),
    )
    return F.when(end > start, position).otherwise(F.lit(0.0))


def age_seconds(at: Column, now: Column) -> Column:
    age = (F.unix_millis(now) - F.unix_millis(at)) / F.lit(1000.0)
    return F.when(at.isNotNull(), F.greatest(F.lit(0.0), age))


def freshness_light(at: Column, now: Column) -> Column:
    age = age_seconds(at, now)
    return (
        F.when(age.isNull(), "no data")
        .when(age < FRESH_SECONDS, "green")
        .when(age < AGING_SECONDS, "amber")
        .otherwise("red")
    )


def sparkline(values: Column) -> Column:
    """Values scaled to 0..1 with the direction of the series; null below two values."""
    low, high = F.array_min(values), F.array_max(values)
    span = F.when(high > low, high - low).otherwise(F.lit(1.0))
    points = F.transform(values, lambda v: (v - low) / span)
    rising = F.element_at(values, -1) >= F.element_at(values, 1)
    return F.when(
        F.size(values) >= 2,
        F.struct(points.alias("points"), F.when(rising, "up").otherwise("down").alias("direction")),
    )


def base_asset(symbol: Column) -> Column:
    return F.upper(F.split_part(symbol, F.lit("-"), F.lit(1)))

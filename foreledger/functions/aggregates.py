"""Lists of aggregate columns. All of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foreledger.config import CATEGORIES
from foreledger.functions.scalars import share


def distinct_hours(hour: Column) -> Column:
    """Distinct hours of a day as a bit set: one long per group instead of a distinct shuffle."""
    return F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), hour)))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def count_cols(hour: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_periods"),
        F.coalesce(distinct_hours(hour), F.lit(0)).alias("hours_with_data"),
    ]


def exact_mean(value: Column, digits: int = 2) -> Column:
    """Mean of values with `digits` decimals, summed as whole numbers.

    A sum of doubles depends on the order of its parts, and so on the number of tasks.
    """
    scaled = F.round(value * F.lit(10**digits)).cast("bigint")
    return F.try_divide(F.sum(scaled), F.count(scaled) * F.lit(10**digits))


def stat_cols(value: Column, suffix: str, spread: bool = False) -> list[Column]:
    cols = [
        F.min(value).alias(f"min_{suffix}"),
        F.max(value).alias(f"max_{suffix}"),
        F.avg(value).alias(f"avg_{suffix}"),
    ]
    if spread:
        cols.append(F.stddev_samp(value).alias(f"stddev_{suffix}"))
    return cols


def error_cols(error: Column, pct: Column, accurate: Column) -> list[Column]:
    return [
        F.avg(F.abs(error)).alias("avg_absolute_error"),
        exact_mean(pct).alias("avg_forecast_error_percent"),
        count_if(accurate).alias("accurate_forecasts_count"),
    ]


def category_minutes_cols(category: Column, minutes: Column) -> list[Column]:
    cols = []
    for level in CATEGORIES:
        inside = category == level
        cols.append(count_if(inside).alias(f"forecast_{level}_count"))
        cols.append(F.sum(F.when(inside, minutes)).alias(f"forecast_{level}_minutes"))
    return cols


def category_mean_cols(category: Column, value: Column) -> list[Column]:
    cols = []
    for level in CATEGORIES:
        inside = category == level
        cols.append(count_if(inside).alias(f"periods_{level}"))
        cols.append(F.round(F.avg(F.when(inside, value)), 2).alias(f"avg_intensity_{level}"))
    return cols


def peak_cols(value: Column, peak: Column, anomaly: Column) -> list[Column]:
    return [
        F.avg(F.when(peak, value)).alias("avg_peak_intensity"),
        count_if(peak).alias("peak_periods_count"),
        count_if(anomaly).alias("anomaly_count"),
    ]


def day_ratio_cols() -> dict[str, Column]:
    """Ratios of a day row that already holds the counts."""
    c = F.col
    return {
        "forecast_accuracy_percent": share(
            c("accurate_forecasts_count"), c("periods_with_actual"), 2
        ),
        "data_completeness_percent": share(c("hours_with_data"), F.lit(24), 2),
        "forecast_volatility_percent": share(
            c("stddev_forecast_intensity"), c("avg_forecast_intensity"), 2
        ),
    }

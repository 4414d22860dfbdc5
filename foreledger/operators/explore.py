"""Summaries of the mart as small tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.config import DAY_NAMES, DAY_PARTS, Settings
from foreledger.functions.aggregates import count_if, exact_mean
from foreledger.functions.scalars import ntz
from foreledger.operators.joins import cross_scalar
from foreledger.operators.windows import grouped, percentiles

VALUE = "forecast_co2_gco2_kwh"


def stats(df: DataFrame, ts: str) -> DataFrame:
    """Rows of a table and its latest time."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.max(ts).alias("latest_record_time")
    )


def recent(df: DataFrame, ts: str, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    """Rows of a table, and those of its last hours."""
    first = ntz(as_of - dt.timedelta(hours=hours))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        count_if(F.col(ts) >= first).alias("recent_records"),
    )


def avg_last_hours(df: DataFrame, as_of: dt.datetime, hours: int) -> DataFrame:
    first = ntz(as_of - dt.timedelta(hours=hours))
    return df.filter(F.col("data_from_dttm") >= first).agg(
        F.avg("forecast_intensity").alias("avg_forecast"),
        F.avg("actual_intensity").alias("avg_actual"),
    )


def describe(df: DataFrame, col: str, cfg: Settings) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles as (statistic, value) rows."""
    quartiles = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    moments = df.agg(
        F.count(col).cast("double").alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).cast("double").alias("min"),
        F.max(col).cast("double").alias("max"),
    )
    row = cross_scalar(moments, percentiles(df, [], col, quartiles, cfg))
    names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    pairs = [
        F.struct(F.lit(n).alias("statistic"), F.col(f"`{n}`").alias("value")) for n in names
    ]
    return row.select(F.inline(F.array(*pairs)))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts of each value of several low-cardinality columns, in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    cfg: Settings,
    medians: Mapping[str, str] | None = None,
) -> DataFrame:
    return grouped(df, keys, aggs, medians or {}, cfg)


def time_of_day_stats(df: DataFrame) -> DataFrame:
    """Mean and deviation per part of the day in fixed order, with best and worst part."""
    parts = df.groupBy("time_of_day").agg(
        F.avg(VALUE).alias("mean"), F.stddev_samp(VALUE).alias("std")
    )
    ends = parts.agg(
        F.min_by("time_of_day", "mean").alias("best_time"),
        F.max_by("time_of_day", "mean").alias("worst_time"),
    )
    place = F.array_position(F.array(*[F.lit(p) for p in DAY_PARTS]), F.col("time_of_day"))
    return cross_scalar(parts, ends).withColumn("place", place)


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values: Sequence[str]) -> DataFrame:
    """Mean of `value` by row and column; the column list is given, so no extra pass."""
    cells = df.groupBy(row).agg(
        *[F.avg(F.when(F.col(col) == v, F.col(value))).alias(v.lower()) for v in values]
    )
    return cells


def hour_dow_heatmap(df: DataFrame) -> DataFrame:
    return pivot_mean(df, "data_hour", "data_day_of_week", VALUE, DAY_NAMES)


def pair_bounds(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pairs with both values, and the range that holds them."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).alias("pairs"),
        F.least(F.min(x), F.min(y)).alias("low"),
        F.greatest(F.max(x), F.max(y)).alias("high"),
    )


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum, the last bin closed."""
    rows = df.filter(F.col(col).isNotNull())
    ends = rows.agg(
        F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")
    )
    # a single value gets a bin one wide around it
    ends = ends.select(
        F.when(F.col("lo") < F.col("hi"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(F.col("lo") < F.col("hi"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    )
    placed = cross_scalar(rows.select(F.col(col).cast("double").alias("__x")), ends)
    spot = F.floor((F.col("__x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    counted = (
        placed.withColumn("bin", F.least(spot, F.lit(bins - 1)))
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
        )
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select(
        "bin",
        "n",
        (F.col("lo") + width * F.col("bin")).alias("bin_start"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_end"),
    )


def accuracy(df: DataFrame) -> DataFrame:
    """MAE, mean absolute percentage error and share of accurate forecasts, one row."""
    done = df.filter(F.col("actual_co2_gco2_kwh").isNotNull())
    return done.agg(
        F.count(F.lit(1)).alias("rows_with_actual"),
        F.avg(F.abs("forecast_error")).alias("mae"),
        exact_mean(F.abs("forecast_error_percent")).alias("mape"),
        F.try_divide(count_if(F.col("is_forecast_accurate")) * 100.0, F.count(F.lit(1))).alias(
            "accuracy_rate"
        ),
    )


def anomaly_summary(df: DataFrame) -> DataFrame:
    """Anomalies by type, with their number and share over all rows."""
    by_type = df.groupBy("intensity_anomaly_type").agg(
        F.count(F.lit(1)).alias("rows"), count_if(F.col("is_statistical_anomaly")).alias("n")
    )
    total = by_type.agg(F.sum("n").alias("anomalies"), F.sum("rows").alias("all_rows"))
    return (
        cross_scalar(by_type, total)
        .filter(F.col("n") > 0)
        .select(
            "intensity_anomaly_type",
            "n",
            "anomalies",
            F.round(F.col("anomalies") * 100.0 / F.col("all_rows"), 1).alias("anomaly_share_pct"),
        )
    )


def anomaly_examples(df: DataFrame, ties: Sequence[Column], n: int = 10) -> DataFrame:
    return df.filter("is_statistical_anomaly").orderBy(*ties).limit(n)


def shift_saving(df: DataFrame) -> DataFrame:
    """What moving use from the average to the best hour saves, absolute and in percent."""
    hourly = df.groupBy("data_hour").agg(
        F.sum(VALUE).alias("s"), F.count(VALUE).alias("n"), F.avg(VALUE).alias("m")
    )
    both = hourly.agg(
        (F.sum("s") / F.sum("n")).alias("overall_mean"), F.min("m").alias("best_hour_mean")
    )
    gain = F.col("overall_mean") - F.col("best_hour_mean")
    return both.select(
        "overall_mean",
        "best_hour_mean",
        gain.alias("saving"),
        F.when(F.col("overall_mean") != 0, gain * 100.0 / F.col("overall_mean")).alias(
            "saving_pct"
        ),
    )


def insights(df: DataFrame) -> DataFrame:
    """Nine headline numbers as (metric, value) rows."""
    c = F.col
    rows = F.count(F.lit(1))
    one = df.agg(
        rows.cast("double").alias("total_rows"),
        F.datediff(F.max("data_date"), F.min("data_date")).cast("double").alias("days_span"),
        F.avg(VALUE).alias("mean_value"),
        F.min(VALUE).cast("double").alias("min_value"),
        F.max(VALUE).cast("double").alias("max_value"),
        F.stddev_samp(VALUE).alias("std_value"),
        F.try_divide(count_if(c("is_peak_carbon_period")) * 100.0, rows).alias("peak_share_pct"),
        F.try_divide(
            count_if(c("energy_cleanliness_level") == "green_energy") * 100.0, rows
        ).alias("green_share_pct"),
        count_if(c("is_statistical_anomaly")).cast("double").alias("anomalies"),
    )
    return one.unpivot([], one.columns, "metric", "value")

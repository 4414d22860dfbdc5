"""Warehouse: the version fact with its analytics, and forecast accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.config import FORECAST_QUALITY, TREND_WORDS, Settings
from foreledger.functions.scalars import (
    bands,
    direction,
    error_metrics,
    horizon_band,
    horizon_category,
    is_outlier,
    ntz,
    share,
    surrogate_key,
    trend,
    truncate,
    volatility,
)
from foreledger.operators.versioning import KEYS
from foreledger.operators.windows import ordered, settle, with_group_stats, with_ranks

MOVING = {"forecast_ma3": 3, "forecast_ma12": 12, "forecast_ma48": 48}
HORIZON_FRAME = 100
DAY_ROWS = 48


# total orders of the row frames, ties broken (K2)
SERIES_ORDER = ("data_from_dttm", "forecast_made_at", "source_id")
MADE_ORDER = ("forecast_made_at", "data_from_dttm", "source_id")
ACCURACY_ORDER = ("data_from_dttm", "forecast_made_at", "fact_key")


def ascending(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc() for n in names]


def fact_base(history: DataFrame) -> DataFrame:
    c = F.col
    return history.select(
        c("id").alias("source_id"),
        surrogate_key(*[c(k) for k in KEYS]).alias("period_key"),
        surrogate_key(c("id"), c("forecast_made_at")).alias("fact_key"),
        *KEYS,
        "forecast_made_at",
        "forecast_valid_until",
        "forecast_horizon_hours",
        "forecast_intensity",
        "actual_intensity",
        "index_forecast",
        "index_actual",
        "is_current_version",
        "is_historical_version",
        "version_number",
        "total_versions",
        "prev_forecast_intensity",
        "forecast_change_from_prev",
        "src_processed_dttm",
        "processed_dttm",
    )


def with_series_windows(df: DataFrame, cfg: Settings) -> DataFrame:
    """Moving averages and change from the period before, per current / historical."""
    value = F.col("forecast_intensity")

    def mean(rows: int):
        return lambda w: F.avg("forecast_intensity").over(w.rowsBetween(1 - rows, 0))

    frames = {name: mean(rows) for name, rows in MOVING.items()}
    frames["__prev"] = lambda w: F.lag("forecast_intensity").over(w)
    order, back = ascending(SERIES_ORDER), max(MOVING.values()) - 1
    out = ordered(df, ["is_current_version"], order, frames, cfg.few_keys(), before=back)
    step = value - F.col("__prev")
    return out.withColumns(
        {
            "forecast_change_from_prev_period": step,
            "forecast_pct_change_from_prev_period": share(step, F.col("__prev"), 2),
        }
    ).drop("__prev")


def _per_kind(unit: Column) -> Column:
    """Days or weeks of current and of historical versions as one key.

    As two keys, the optimizer moves their windows below the one keyed by the
    version kind alone and computes them in its two tasks.
    """
    return F.struct(unit.alias("unit"), "is_current_version")


def with_daily_ranks(df: DataFrame, cfg: Settings) -> DataFrame:
    """Rank and percentile of the forecast within its day."""
    dated = df.withColumn("__day", _per_kind(F.to_date("data_from_dttm")))
    ranked = with_ranks(
        dated,
        ["__day"],
        "forecast_intensity",
        {
            "daily_intensity_rank": ("rank", True),
            "daily_intensity_percentile": ("percent_rank", False),
        },
        cfg.few_keys(),
    )
    return ranked.withColumn(
        "daily_intensity_percentile", F.col("daily_intensity_percentile") * 100
    ).drop("__day")


def with_horizon_error(df: DataFrame, cfg: Settings) -> DataFrame:
    """Mean absolute error of the last versions made at a like horizon."""
    banded = df.withColumns(
        {
            "__band": horizon_band(F.col("forecast_horizon_hours")),
            "__gap": F.abs(F.col("forecast_intensity") - F.col("actual_intensity")),
        }
    )
    frames = {
        "avg_error_for_horizon": lambda w: F.avg("__gap").over(w.rowsBetween(-HORIZON_FRAME, 0))
    }
    order = ascending(MADE_ORDER)
    out = ordered(banded, ["__band"], order, frames, cfg.few_keys(), before=HORIZON_FRAME)
    return out.drop("__band", "__gap")


def with_weekly_range(
    df: DataFrame, cfg: Settings, source: DataFrame | None = None
) -> DataFrame:
    week = _per_kind(truncate(F.col("data_from_dttm"), "week"))
    return with_group_stats(
        df.withColumn("__week", week),
        ["__week"],
        {
            "weekly_min_intensity": F.min("forecast_intensity"),
            "weekly_max_intensity": F.max("forecast_intensity"),
        },
        cfg.few_keys(),
        None if source is None else source.withColumn("__week", week),
    ).drop("__week")


def derived_fact_cols() -> dict[str, Column]:
    c = F.col
    return {
        "short_term_trend": trend(c("forecast_ma3"), c("forecast_ma12"), TREND_WORDS),
        "weekly_volatility_pct": volatility(c("weekly_min_intensity"), c("weekly_max_intensity")),
        "is_outlier": is_outlier(c("daily_intensity_percentile")),
        "forecast_horizon_category": horizon_category(c("forecast_horizon_hours")),
    }


def fact(history: DataFrame, cfg: Settings) -> DataFrame:
    """Every version with trend, rank, horizon error and weekly context.

    Histogram ranks and group aggregates come first, both read off the settled
    base rows; then one ordered pass per order.
    """
    base = settle(fact_base(history), cfg.few_keys(), "fact-base")
    ranged = with_weekly_range(with_daily_ranks(base, cfg), cfg, source=base)
    windowed = with_horizon_error(with_series_windows(ranged, cfg), cfg)
    return windowed.withColumns(derived_fact_cols()).withColumn("updated_at", ntz(cfg.as_of))


def accuracy_rows(facts: DataFrame, cfg: Settings) -> DataFrame:
    """Versions of completed periods with their error metrics."""
    c = F.col
    forecast, actual = c("forecast_intensity"), c("actual_intensity")
    metrics = error_metrics(forecast, actual)
    return facts.filter(actual.isNotNull()).select(
        surrogate_key(c("period_key"), c("forecast_made_at")).alias("accuracy_key"),
        "fact_key",
        "period_key",
        *KEYS,
        "forecast_made_at",
        F.to_date("data_from_dttm").alias("data_date"),
        F.hour("data_from_dttm").alias("data_hour"),
        "forecast_horizon_hours",
        "forecast_horizon_category",
        forecast,
        actual,
        *[col.alias(name) for name, col in metrics.items()],
        bands(metrics["absolute_error"], "<=", FORECAST_QUALITY).alias("forecast_quality"),
        direction(forecast, actual).alias("error_direction"),
        "version_number",
        "is_current_version",
        ntz(cfg.as_of).alias("updated_at"),
    )


def with_error_windows(df: DataFrame, cfg: Settings) -> DataFrame:
    """Rolling day of MAE, RMSE and hit rate per horizon, and the step from the row before."""
    hit = F.when(F.col("absolute_percentage_error") <= cfg.accurate_within_pct, 1.0).otherwise(0.0)
    last = lambda w: w.rowsBetween(1 - DAY_ROWS, 0)
    frames = {
        "rolling_24h_mae": lambda w: F.avg("absolute_error").over(last(w)),
        "rolling_24h_rmse": lambda w: F.sqrt(F.avg("squared_error").over(last(w))),
        "rolling_24h_accuracy_rate": lambda w: F.avg(hit).over(last(w)) * 100,
        "__prev": lambda w: F.lag("absolute_error").over(w),
    }
    order = ascending(ACCURACY_ORDER)
    kinds = ["forecast_horizon_category"]
    out = ordered(df, kinds, order, frames, cfg.few_keys(), before=DAY_ROWS - 1)
    better = F.coalesce(F.col("absolute_error") < F.col("__prev"), F.lit(False))
    return out.withColumn("is_improving", better).drop("__prev")


def with_weekly_error(df: DataFrame, cfg: Settings) -> DataFrame:
    weekly = df.withColumn("__week", truncate(F.col("data_from_dttm"), "week"))
    return with_group_stats(
        weekly,
        ["__week", "forecast_horizon_category"],
        {"weekly_avg_error": F.avg("absolute_error")},
        cfg.few_keys(),
    ).drop("__week")


def forecast_accuracy(facts: DataFrame, cfg: Settings) -> DataFrame:
    rows = settle(accuracy_rows(facts, cfg), cfg.few_keys(), "accuracy")
    return with_error_windows(with_weekly_error(rows, cfg), cfg)

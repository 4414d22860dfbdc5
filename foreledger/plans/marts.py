"""Data marts: period analytics and the daily report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foreledger.config import (
    CATEGORIES,
    DAILY_ADVICE,
    DAILY_ADVICE_REST,
    DAILY_QUALITY,
    DAILY_TREND_WORDS,
    HOUR_MARK,
    NO_RECOMMENDATION,
    RECOMMENDATIONS,
    UNIT_TEXT,
    Settings,
)
from foreledger.functions.aggregates import (
    category_mean_cols,
    count_cols,
    exact_mean,
    peak_cols,
    stat_cols,
)
from foreledger.functions.scalars import (
    anomaly_cols,
    bands,
    cleanliness,
    date_text,
    is_peak,
    map_labels,
    ntz,
    saving,
    share,
    trend,
    week_of_month,
    z_score,
)
from foreledger.operators.joins import cross_scalar, left_join_versions
from foreledger.operators.windows import (
    grouped,
    settle,
    top_k,
    with_group_stats,
    with_ranks,
)

SAME_HOUR = ("data_hour", "day_type")
REPORT_KEYS = (
    "data_date",
    "data_year",
    "data_month",
    "data_day",
    "data_day_of_week",
    "day_type",
)
ODS_COLUMNS = (
    "period_key",
    "data_from_dttm",
    "data_to_dttm",
    "data_date",
    "data_year",
    "data_month",
    "data_day",
    "data_hour",
    "data_day_of_week",
    "data_day_of_week_num",
    "time_of_day",
    "day_type",
    "forecast_intensity",
    "actual_intensity",
    "forecast_intensity_category",
    "actual_intensity_category",
    "forecast_error_gco2_kwh",
    "forecast_error_percent",
    "is_forecast_accurate",
    "data_status",
)
ACCURACY_COLUMNS = (
    "period_key",
    "absolute_error",
    "absolute_percentage_error",
    "forecast_quality",
    "error_direction",
    "rolling_24h_mae",
    "rolling_24h_rmse",
    "rolling_24h_accuracy_rate",
)


def last_days(df: DataFrame, column: str, as_of: dt.datetime, days: int) -> DataFrame:
    return df.filter(F.col(column) >= F.date_sub(F.lit(as_of.date()), days))


def analytics_join(ods: DataFrame, accuracy: DataFrame, cfg: Settings) -> DataFrame:
    """Recent periods with the accuracy of each of their versions (K3: one row per version)."""
    periods = last_days(ods, "data_date", cfg.as_of, cfg.mart_days).select(*ODS_COLUMNS)
    scored = last_days(accuracy, "data_date", cfg.as_of, cfg.mart_days)
    if cfg.latest_version_only:
        scored = scored.filter("is_current_version")
    scored = scored.select(*ACCURACY_COLUMNS, "accuracy_key")
    return left_join_versions(periods, scored, "period_key", "accuracy_key", cfg).drop(
        "accuracy_key"
    )


def with_business_flags(df: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    value = c("forecast_intensity")
    return df.withColumns(
        {
            "energy_cleanliness": cleanliness(value, cfg),
            "is_peak_carbon_period": is_peak(value, c("time_of_day"), c("day_type"), cfg),
            "consumption_recommendation": map_labels(
                c("forecast_intensity_category"), RECOMMENDATIONS, NO_RECOMMENDATION
            ),
        }
    )


def with_same_hour_stats(
    df: DataFrame, cfg: Settings, source: DataFrame | None = None
) -> DataFrame:
    value = F.col("forecast_intensity")
    out = with_group_stats(
        df,
        SAME_HOUR,
        {
            "avg_intensity_same_hour": F.avg("forecast_intensity"),
            "stddev_intensity_same_hour": F.stddev_samp("forecast_intensity"),
        },
        cfg,
        source,
    )
    return out.withColumn(
        "intensity_z_score",
        z_score(value, F.col("avg_intensity_same_hour"), F.col("stddev_intensity_same_hour")),
    )


def with_same_hour_ranks(df: DataFrame, cfg: Settings) -> DataFrame:
    out = with_ranks(
        df,
        SAME_HOUR,
        "forecast_intensity",
        {
            "intensity_rank_same_hour": ("dense_rank", True),
            "intensity_percentile_same_hour": ("percent_rank", False),
        },
        cfg,
    )
    return out.withColumn(
        "intensity_percentile_same_hour", F.col("intensity_percentile_same_hour") * 100
    )


def min_hourly_avg(df: DataFrame) -> DataFrame:
    """One row: the lowest of the hourly means."""
    hourly = df.groupBy("data_hour").agg(F.avg("forecast_intensity").alias("__mean"))
    return hourly.agg(F.min("__mean").alias("min_hourly_avg_intensity"))


def analytics(ods: DataFrame, accuracy: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    combined = settle(
        with_business_flags(analytics_join(ods, accuracy, cfg), cfg), cfg, "analytics"
    )
    studied = with_same_hour_stats(with_same_hour_ranks(combined, cfg), cfg, source=combined)
    flags = anomaly_cols(c("intensity_z_score"), c("intensity_percentile_same_hour"))
    best = min_hourly_avg(combined)
    return cross_scalar(studied, best).select(
        "period_key",
        c("data_from_dttm").alias("period_start"),
        c("data_to_dttm").alias("period_end"),
        "data_date",
        "data_year",
        "data_month",
        "data_day",
        "data_hour",
        "data_day_of_week",
        "time_of_day",
        "day_type",
        c("forecast_intensity").alias("forecast_co2_gco2_kwh"),
        c("actual_intensity").alias("actual_co2_gco2_kwh"),
        c("forecast_intensity_category").alias("forecast_category"),
        c("actual_intensity_category").alias("actual_category"),
        c("forecast_error_gco2_kwh").alias("forecast_error"),
        "forecast_error_percent",
        "is_forecast_accurate",
        "forecast_quality",
        "error_direction",
        c("rolling_24h_mae").alias("rolling_mean_absolute_error"),
        c("rolling_24h_rmse").alias("rolling_root_mean_squared_error"),
        c("rolling_24h_accuracy_rate").alias("rolling_accuracy_rate_pct"),
        c("energy_cleanliness").alias("energy_cleanliness_level"),
        "is_peak_carbon_period",
        "consumption_recommendation",
        c("avg_intensity_same_hour").alias("historical_avg_for_hour"),
        "intensity_z_score",
        "intensity_percentile_same_hour",
        *[col.alias(name) for name, col in flags.items()],
        saving(
            c("forecast_intensity"),
            c("min_hourly_avg_intensity"),
            c("avg_intensity_same_hour"),
            cfg.consumption_kwh,
        ).alias("potential_co2_saving_per_kwh"),
        "data_status",
        ntz(cfg.as_of).alias("mart_updated_at"),
    )


# ---- daily report ----------------------------------------------------------


def report_base(mart: DataFrame, cfg: Settings, more: Sequence[Column] = ()) -> DataFrame:
    """Day rows of the mart; `more` aggregates ride along in the same pass."""
    c = F.col
    forecast, actual = "forecast_co2_gco2_kwh", "actual_co2_gco2_kwh"
    aggs = [
        *count_cols(c("data_hour")),
        *stat_cols(c(forecast), "forecast", spread=True),
        *stat_cols(c(actual), "actual"),
        F.avg(F.abs("forecast_error")).alias("avg_absolute_error"),
        exact_mean(c("forecast_error_percent")).alias("avg_error_percent"),
        exact_mean(c("rolling_accuracy_rate_pct"), 6).alias("avg_accuracy_rate"),
        *category_mean_cols(c("forecast_category"), c(forecast)),
        *more,
    ]
    medians = {"median_forecast": forecast, "median_actual": actual}
    return grouped(
        last_days(mart, "data_date", cfg.as_of, cfg.mart_days), REPORT_KEYS, aggs, medians, cfg
    )


def hour_text(hour: Column, value: Column) -> Column:
    return F.concat(
        hour.cast("string"),
        F.lit(f"{HOUR_MARK} ("),
        value.cast("string"),
        F.lit(f" {UNIT_TEXT})"),
    )


def top_text(mart: DataFrame, k: int = 3) -> DataFrame:
    """Texts of the k highest and k lowest rows of each day.

    Ties are broken by period; rows repeated per version are alike in every
    column used here.
    """
    slim = mart.select("data_date", "data_hour", "period_start", "forecast_co2_gco2_kwh")
    picked = top_k(
        slim, ["data_date"], "forecast_co2_gco2_kwh", [F.col("period_start").asc()], k
    )
    text = hour_text(F.col("data_hour"), F.col("forecast_co2_gco2_kwh"))

    def joined(side: str) -> Column:
        rows = F.collect_list(F.when(F.col("side") == side, F.struct("rnk", text.alias("t"))))
        texts = F.transform(F.sort_array(rows), lambda r: r["t"])
        return F.when(F.size(texts) > 0, F.array_join(texts, ", "))

    return picked.groupBy("data_date").agg(
        joined("high").alias("top_3_peak_hours"), joined("low").alias("top_3_best_hours")
    )


def day_peak_cols() -> list[Column]:
    c = F.col
    return peak_cols(
        c("forecast_co2_gco2_kwh"), c("is_peak_carbon_period"), c("is_statistical_anomaly")
    )


def peak_stats(mart: DataFrame) -> DataFrame:
    return mart.groupBy("data_date").agg(*day_peak_cols())


def with_day_comparison(daily: DataFrame, by_date: bool = False) -> DataFrame:
    """Lags and moving means added to day rows: one row per day, so one small window.

    The lags are one and seven rows back, whatever the dates (K10); `by_date`
    takes the days of these dates instead, NULL where one is missing.
    """
    by_day = Window.orderBy("data_date")
    day = F.col("avg_forecast")

    def back(days: int) -> Column:
        if not by_date:
            return F.lag("avg_forecast", days).over(by_day)
        exact = Window.orderBy(F.unix_date("data_date")).rangeBetween(-days, -days)
        return F.max("avg_forecast").over(exact)

    lagged = daily.withColumns(
        {
            "prev_day_avg": back(1),
            "prev_week_same_day_avg": back(7),
            "ma7_forecast": F.avg("avg_forecast").over(by_day.rowsBetween(-6, 0)),
            "ma30_forecast": F.avg("avg_forecast").over(by_day.rowsBetween(-29, 0)),
        }
    )
    return lagged.withColumns(
        {
            "day_over_day_change": day - F.col("prev_day_avg"),
            "week_over_week_change": day - F.col("prev_week_same_day_avg"),
        }
    )


def day_words() -> dict[str, Column]:
    """Words of a compared day row: forecast quality, trend, advice."""
    c = F.col
    day = c("avg_forecast")
    return {
        "daily_forecast_quality": bands(c("avg_absolute_error"), "<=", DAILY_QUALITY),
        "short_term_trend": trend(day, c("ma7_forecast"), DAILY_TREND_WORDS),
        "daily_recommendation": bands(day, "<", DAILY_ADVICE, DAILY_ADVICE_REST),
    }


def date_words() -> dict[str, Column]:
    """Texts of the date. The second is a week of the month under its customary name (K9)."""
    day = F.col("data_date")
    return {"date_formatted": date_text(day), "week_of_year": week_of_month(day)}


def daily_report(mart: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    dates, words = date_words(), day_words()
    recent = last_days(mart, "data_date", cfg.as_of, cfg.mart_days)
    days = with_day_comparison(report_base(mart, cfg, day_peak_cols()))
    joined = days.join(top_text(recent), "data_date", "left")
    two = lambda name: F.round(c(name), 2)
    levels = []
    for level in CATEGORIES:
        levels.append(c(f"periods_{level}"))
        levels.append(share(c(f"periods_{level}"), c("total_periods"), 1).alias(f"pct_{level}"))
    return joined.select(
        *REPORT_KEYS,
        *[col.alias(name) for name, col in dates.items()],
        "total_periods",
        "hours_with_data",
        share(c("hours_with_data"), F.lit(24), 1).alias("data_completeness_pct"),
        two("avg_forecast").alias("avg_daily_intensity"),
        two("median_forecast").alias("median_daily_intensity"),
        two("min_forecast").alias("min_daily_intensity"),
        two("max_forecast").alias("max_daily_intensity"),
        two("stddev_forecast").alias("intensity_volatility"),
        *levels,
        two("avg_absolute_error").alias("avg_forecast_error"),
        two("avg_error_percent").alias("avg_forecast_error_pct"),
        F.round("avg_accuracy_rate", 1).alias("forecast_accuracy_rate"),
        words["daily_forecast_quality"].alias("daily_forecast_quality"),
        "top_3_peak_hours",
        "top_3_best_hours",
        two("avg_peak_intensity").alias("avg_peak_intensity"),
        "peak_periods_count",
        "anomaly_count",
        two("prev_day_avg").alias("prev_day_avg"),
        two("day_over_day_change").alias("day_over_day_change"),
        two("prev_week_same_day_avg").alias("prev_week_avg"),
        two("week_over_week_change").alias("week_over_week_change"),
        two("ma7_forecast").alias("ma7_intensity"),
        two("ma30_forecast").alias("ma30_intensity"),
        words["short_term_trend"].alias("short_term_trend"),
        words["daily_recommendation"].alias("daily_recommendation"),
        ntz(cfg.as_of).alias("report_generated_at"),
    )

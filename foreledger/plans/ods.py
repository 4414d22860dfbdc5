"""Operational store: enriched periods and their daily summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.functions.aggregates import (
    category_minutes_cols,
    count_cols,
    day_ratio_cols,
    error_cols,
    stat_cols,
)
from foreledger.functions.scalars import (
    calendar,
    day_type,
    intensity_category,
    is_accurate,
    ntz,
    surrogate_key,
    time_of_day,
)
from foreledger.operators.versioning import KEYS
from foreledger.operators.windows import grouped

DAY_KEYS = (
    "data_date",
    "data_year",
    "data_month",
    "data_day",
    "data_day_of_week",
    "data_day_of_week_num",
    "day_type",
)


def ods_enrich(stg: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    start, forecast, actual = c("data_from_dttm"), c("forecast_intensity"), c("actual_intensity")
    fields = calendar(start, cfg.padded_day_names)
    actual_category = F.when(actual.isNotNull(), intensity_category(actual, cfg))
    return stg.select(
        c("id").alias("source_id"),
        surrogate_key(*[c(k) for k in KEYS]).alias("period_key"),
        *KEYS,
        *[col.alias(name) for name, col in fields.items()],
        time_of_day(start).alias("time_of_day"),
        day_type(start).alias("day_type"),
        "period_duration_minutes",
        forecast,
        actual,
        "forecast_error_gco2_kwh",
        "forecast_error_percent",
        intensity_category(forecast, cfg).alias("forecast_intensity_category"),
        actual_category.alias("actual_intensity_category"),
        "index_forecast",
        "index_forecast_numeric",
        "index_actual",
        "index_actual_numeric",
        "data_status",
        is_accurate(actual, c("forecast_error_percent"), cfg.accurate_within_pct).alias(
            "is_forecast_accurate"
        ),
        "valid_from_dttm",
        c("processed_dttm").alias("source_processed_dttm"),
        "updated_at",
    )


def daily_summary(ods: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    aggs = [
        *count_cols(c("data_hour")),
        *stat_cols(c("forecast_intensity"), "forecast_intensity", spread=True),
        F.count("actual_intensity").alias("periods_with_actual"),
        *stat_cols(c("actual_intensity"), "actual_intensity"),
        *error_cols(
            c("forecast_error_gco2_kwh"), c("forecast_error_percent"), c("is_forecast_accurate")
        ),
        *category_minutes_cols(c("forecast_intensity_category"), c("period_duration_minutes")),
    ]
    medians = {
        "median_forecast_intensity": "forecast_intensity",
        "median_actual_intensity": "actual_intensity",
    }
    return (
        grouped(ods, DAY_KEYS, aggs, medians, cfg)
        .withColumns(day_ratio_cols())
        .withColumn("updated_at", ntz(cfg.as_of))
    )

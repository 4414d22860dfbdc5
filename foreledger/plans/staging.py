"""Staged versions: the open ones cleaned, and the whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.config import INDEX_NUMBERS, Settings
from foreledger.functions.scalars import (
    data_status,
    err,
    err_pct,
    hours_between,
    is_current,
    map_labels,
    minutes_between,
    norm,
    ntz,
)
from foreledger.operators.versioning import KEYS
from foreledger.operators.windows import settle, with_versions

MAX_MINUTES = 60


def sane_rows(df: DataFrame) -> DataFrame:
    """Periods of at most an hour, a forecast, no negative values."""
    actual = F.col("actual_intensity")
    minutes = F.col("period_duration_minutes")
    return df.filter(
        (minutes > 0)
        & (minutes <= MAX_MINUTES)
        & (F.col("forecast_intensity") >= 0)
        & (actual.isNull() | (actual >= 0))
    )


def stg_current(raw: DataFrame, cfg: Settings) -> DataFrame:
    c = F.col
    forecast, actual = c("forecast_intensity"), c("actual_intensity")
    words = {name: norm(c(name)) for name in ("index_forecast", "index_actual")}
    staged = raw.filter(is_current(c("valid_to_dttm"))).select(
        "id",
        *KEYS,
        minutes_between(c("data_from_dttm"), c("data_to_dttm")).alias("period_duration_minutes"),
        forecast,
        actual,
        err(forecast, actual).alias("forecast_error_gco2_kwh"),
        err_pct(forecast, actual).alias("forecast_error_percent"),
        words["index_forecast"].alias("index_forecast"),
        map_labels(words["index_forecast"], INDEX_NUMBERS).alias("index_forecast_numeric"),
        words["index_actual"].alias("index_actual"),
        map_labels(words["index_actual"], INDEX_NUMBERS).alias("index_actual_numeric"),
        data_status(actual, c("data_from_dttm"), cfg.as_of).alias("data_status"),
        "valid_from_dttm",
        "valid_to_dttm",
        "src_processed_dttm",
        "processed_dttm",
        ntz(cfg.as_of).alias("updated_at"),
    )
    return sane_rows(staged)


def history_rows(raw: DataFrame, cfg: Settings) -> DataFrame:
    """All versions under their forecast names, before the version windows."""
    c = F.col
    current = is_current(c("valid_to_dttm"))
    return raw.select(
        "id",
        *KEYS,
        "forecast_intensity",
        "actual_intensity",
        norm(c("index_forecast")).alias("index_forecast"),
        norm(c("index_actual")).alias("index_actual"),
        c("valid_from_dttm").alias("forecast_made_at"),
        c("valid_to_dttm").alias("forecast_valid_until"),
        hours_between(c("valid_from_dttm"), c("data_from_dttm")).alias("forecast_horizon_hours"),
        current.alias("is_current_version"),
        (~current).alias("is_historical_version"),
        "src_processed_dttm",
        "processed_dttm",
        ntz(cfg.as_of).alias("updated_at"),
    )


def stg_history(raw: DataFrame, cfg: Settings) -> DataFrame:
    rows = settle(history_rows(raw, cfg), cfg, "history")
    order = [F.col("forecast_made_at").asc(), F.col("id").asc()]
    return with_versions(rows, KEYS, order, "forecast_intensity", cfg)

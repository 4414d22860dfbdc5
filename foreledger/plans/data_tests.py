"""The declared data tests of each layer, as checks over its table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.config import CATEGORIES, DAILY_QUALITY, DAILY_TREND_WORDS, INDEX_NUMBERS
from foreledger.operators.quality import (
    FrameCheck,
    RowCheck,
    null_check,
    orphans,
    range_check,
    run_checks,
    unique,
    values_check,
)

# fixed values: the value lists and ranges the layers are tested against
INDEX = tuple(INDEX_NUMBERS)
NUMBERS = tuple(INDEX_NUMBERS.values())
STATUS = ("completed", "in_progress", "future")
DAY_TYPE = ("weekday", "weekend")
DAY_PART = ("morning", "afternoon", "evening", "night")
BOOLS = (True, False)
HORIZON = ("immediate", "short_term", "medium_term", "long_term", "very_long_term")
TREND = ("rising", "falling", "stable")
QUALITY = ("excellent", "good", "acceptable", "poor")
DIRECTION = ("overestimated", "underestimated", "exact")
CLEANLINESS = ("green_energy", "moderate_impact", "standard", "high_carbon")
ANOMALY = ("unusually_high", "unusually_low", "normal")


def _nulls(names: str) -> list[RowCheck]:
    return [null_check(n) for n in names.split()]


def _values(**lists: Sequence) -> list[RowCheck]:
    return [values_check(n, v) for n, v in lists.items()]


def _ranges(**bounds: tuple) -> list[RowCheck]:
    return [range_check(n, lo, hi) for n, (lo, hi) in bounds.items()]


def _unique(df: DataFrame, *names: str) -> list[FrameCheck]:
    return [FrameCheck("unique", n, unique(df, n)) for n in names]


def raw_rows() -> list[RowCheck]:
    rows = _nulls("id data_from_dttm data_to_dttm valid_from_dttm valid_to_dttm")
    rows += _values(index_forecast=INDEX)
    return rows


def raw_tests(raw: DataFrame) -> DataFrame:
    return run_checks(raw, raw_rows(), _unique(raw, "id"))


def current_rows() -> list[RowCheck]:
    rows = _nulls(
        """id data_from_dttm data_to_dttm period_duration_minutes forecast_intensity
           index_forecast index_forecast_numeric data_status valid_from_dttm updated_at"""
    )
    rows += _values(
        period_duration_minutes=(30.0,),
        index_forecast=INDEX,
        index_forecast_numeric=NUMBERS,
        index_actual=INDEX,
        data_status=STATUS,
    )
    rows += _ranges(
        period_duration_minutes=(25, 35),
        forecast_intensity=(0, 1000),
        actual_intensity=(0, 1000),
        forecast_error_percent=(-100, 100),
    )
    return rows


def current_tests(stg: DataFrame) -> DataFrame:
    return run_checks(stg, current_rows(), _unique(stg, "id"))


def history_rows() -> list[RowCheck]:
    rows = _nulls(
        """id data_from_dttm forecast_made_at forecast_horizon_hours version_number
           total_versions is_current_version"""
    )
    rows += _values(is_current_version=BOOLS)
    rows += _ranges(version_number=(1, 1000), total_versions=(1, 1000))
    return rows


def history_tests(history: DataFrame) -> DataFrame:
    return run_checks(history, history_rows(), _unique(history, "id"))


def ods_rows() -> list[RowCheck]:
    rows = _nulls(
        """source_id period_key data_from_dttm data_date data_year data_day_of_week time_of_day
           day_type forecast_intensity forecast_intensity_category data_status
           is_forecast_accurate updated_at"""
    )
    rows += _values(
        time_of_day=DAY_PART,
        day_type=DAY_TYPE,
        forecast_intensity_category=CATEGORIES,
        data_status=STATUS,
    )
    done = F.col("data_status") == "completed"
    rows.append(null_check("actual_intensity", done))
    rows += _ranges(data_year=(2020, 2030), forecast_intensity=(0, 1000))
    return rows


def ods_tests(ods: DataFrame) -> DataFrame:
    return run_checks(ods, ods_rows(), _unique(ods, "source_id", "period_key"))


def daily_rows() -> list[RowCheck]:
    rows = _nulls(
        """data_date total_periods avg_forecast_intensity data_completeness_percent
           hours_with_data"""
    )
    rows += _ranges(
        total_periods=(1, 100),
        avg_forecast_intensity=(0, 1000),
        forecast_accuracy_percent=(0, 100),
        data_completeness_percent=(0, 100),
        forecast_volatility_percent=(0, 1000),
    )
    return rows


def daily_tests(daily: DataFrame) -> DataFrame:
    return run_checks(daily, daily_rows(), _unique(daily, "data_date"))


def fact_rows() -> list[RowCheck]:
    rows = _nulls(
        """fact_key period_key data_from_dttm forecast_made_at forecast_horizon_hours
           forecast_horizon_category forecast_intensity forecast_ma3 forecast_ma12
           daily_intensity_rank daily_intensity_percentile short_term_trend is_outlier
           is_current_version version_number"""
    )
    rows += _values(
        forecast_horizon_category=HORIZON, short_term_trend=TREND, is_outlier=BOOLS
    )
    rows += _ranges(
        forecast_intensity=(0, 1000),
        forecast_pct_change_from_prev_period=(-100, 100),
        daily_intensity_percentile=(0, 100),
        version_number=(1, 1000),
    )
    return rows


def fact_tests(fact: DataFrame, ods: DataFrame) -> DataFrame:
    lost = orphans(fact, ods, "period_key", "period_key", F.col("is_current_version"))
    frames = _unique(fact, "fact_key") + [FrameCheck("relationships", "period_key", lost)]
    return run_checks(fact, fact_rows(), frames)


def accuracy_rows() -> list[RowCheck]:
    rows = _nulls(
        """accuracy_key fact_key period_key data_from_dttm data_date forecast_made_at
           actual_intensity absolute_error squared_error forecast_quality error_direction
           is_improving rolling_24h_mae"""
    )
    rows += _values(forecast_quality=QUALITY, error_direction=DIRECTION, is_improving=BOOLS)
    rows += _ranges(
        absolute_error=(0, 500),
        absolute_percentage_error=(0, 1000),
        accuracy_percentage=(0, 100),
        rolling_24h_accuracy_rate=(0, 100),
    )
    return rows


def accuracy_tests(accuracy: DataFrame, fact: DataFrame) -> DataFrame:
    lost = orphans(accuracy, fact, "fact_key", "fact_key")
    frames = _unique(accuracy, "accuracy_key") + [FrameCheck("relationships", "fact_key", lost)]
    return run_checks(accuracy, accuracy_rows(), frames)


def analytics_rows() -> list[RowCheck]:
    rows = _nulls(
        """period_key period_start data_date time_of_day day_type forecast_co2_gco2_kwh
           forecast_category energy_cleanliness_level is_peak_carbon_period
           consumption_recommendation intensity_z_score intensity_percentile_same_hour
           is_statistical_anomaly intensity_anomaly_type data_status"""
    )
    rows += _values(
        time_of_day=DAY_PART,
        day_type=DAY_TYPE,
        forecast_category=CATEGORIES,
        actual_category=CATEGORIES,
        energy_cleanliness_level=CLEANLINESS,
        is_peak_carbon_period=BOOLS,
        intensity_anomaly_type=ANOMALY,
        data_status=STATUS,
    )
    rows += _ranges(
        forecast_co2_gco2_kwh=(0, 1000),
        actual_co2_gco2_kwh=(0, 1000),
        intensity_percentile_same_hour=(0, 100),
    )
    return rows


def analytics_tests(mart: DataFrame) -> DataFrame:
    return run_checks(mart, analytics_rows())


def report_rows() -> list[RowCheck]:
    rows = _nulls(
        """data_date data_day_of_week day_type total_periods data_completeness_pct
           avg_daily_intensity min_daily_intensity max_daily_intensity top_3_peak_hours
           top_3_best_hours short_term_trend daily_recommendation"""
    )
    rows += _values(
        day_type=DAY_TYPE,
        daily_forecast_quality=tuple(word for _, word in DAILY_QUALITY),
        short_term_trend=DAILY_TREND_WORDS,
    )
    rows += _ranges(
        total_periods=(1, 100),
        data_completeness_pct=(0, 100),
        avg_daily_intensity=(0, 1000),
        forecast_accuracy_rate=(0, 100),
    )
    return rows


def report_tests(report: DataFrame) -> DataFrame:
    return run_checks(report, report_rows(), _unique(report, "data_date"))

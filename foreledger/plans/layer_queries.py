"""Queries over the layers themselves and over single steps of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from foreledger.functions.scalars import feed_ts
from foreledger.operators.explore import avg_last_hours
from foreledger.operators.versioning import current_rows, forecast_changes
from foreledger.operators.windows import top_bottom, top_k
from foreledger.plans.catalog import query
from foreledger.plans.dwh import (
    accuracy_rows,
    derived_fact_cols,
    with_daily_ranks,
    with_error_windows,
    with_horizon_error,
    with_series_windows,
    with_weekly_error,
    with_weekly_range,
)
from foreledger.plans.marts import (
    analytics_join,
    date_words,
    day_words,
    last_days,
    min_hourly_avg,
    peak_stats,
    report_base,
    top_text,
    with_business_flags,
    with_day_comparison,
    with_same_hour_ranks,
    with_same_hour_stats,
)
from foreledger.plans.staging import history_rows, stg_current

PERIOD = "data_from_dttm data_to_dttm"

# ---- raw and staging -------------------------------------------------------

RAW = f"""i:id {PERIOD} i:forecast_intensity i:actual_intensity index_forecast index_actual
          valid_from_dttm t:valid_to_dttm src_processed_dttm processed_dttm"""


@query("scd2_from_log", RAW)
def _(run):
    return run.raw


@query("raw_current_view", RAW.replace("i:id", ""))
def _(run):
    return current_rows(run.raw)


@query(
    "forecast_changes_view",
    f"""{PERIOD} i:forecast_intensity i:actual_intensity forecast_made_at
        t:forecast_valid_until f:forecast_horizon_hours is_current""",
)
def _(run):
    return forecast_changes(run.raw)


@query(
    "stg_current",
    f"""i:id {PERIOD} f:period_duration_minutes i:forecast_intensity i:actual_intensity
        i:forecast_error_gco2_kwh f:forecast_error_percent index_forecast
        i:index_forecast_numeric index_actual i:index_actual_numeric data_status
        valid_from_dttm t:valid_to_dttm src_processed_dttm processed_dttm""",
)
def _(run):
    return run.stg


@query("stg_sane_rows", "i:id f:period_duration_minutes i:forecast_intensity i:actual_intensity")
def _(run):
    """The row rules on values lowered by 60 and periods as many minutes long, so that
    each rule meets rows it must drop."""
    lowered = F.col("forecast_intensity") - 60
    bent = run.raw.withColumns(
        {
            "data_to_dttm": F.col("data_from_dttm") + F.make_dt_interval(mins=lowered),
            "forecast_intensity": lowered,
            "actual_intensity": F.col("actual_intensity") - 60,
        }
    )
    return stg_current(bent, run.cfg)


@query(
    "stg_history",
    f"""i:id {PERIOD} i:forecast_intensity i:actual_intensity index_forecast index_actual
        forecast_made_at t:forecast_valid_until f:forecast_horizon_hours is_current_version
        is_historical_version src_processed_dttm processed_dttm i:version_number
        i:total_versions i:prev_forecast_intensity i:forecast_change_from_prev""",
)
def _(run):
    return run.history


@query("text_normalise", "i:id index_forecast index_actual")
def _(run):
    return history_rows(run.raw, run.cfg)


@query("period_minutes", "i:id f:period_duration_minutes")
def _(run):
    return run.stg


@query("horizon_hours", "i:id f:forecast_horizon_hours")
def _(run):
    return history_rows(run.raw, run.cfg)


@query("index_to_number", "i:id index_forecast i:index_forecast_numeric i:index_actual_numeric")
def _(run):
    return run.stg


@query("forecast_error", "i:id i:forecast_error_gco2_kwh")
def _(run):
    return run.stg


@query("forecast_error_pct", "i:id f:forecast_error_percent")
def _(run):
    return run.stg


@query("data_status", "data_status i:n")
def _(run):
    return run.stg.groupBy("data_status").agg(F.count(F.lit(1)).alias("n"))


@query("version_flags", "i:id is_current_version is_historical_version")
def _(run):
    return history_rows(run.raw, run.cfg)


@query("version_number", "i:id i:version_number")
def _(run):
    return run.history


@query("total_versions", f"{PERIOD} i:total_versions")
def _(run):
    return run.history.select("data_from_dttm", "data_to_dttm", "total_versions")


@query("version_delta", "i:id i:prev_forecast_intensity i:forecast_change_from_prev")
def _(run):
    return run.history


@query("feed_timestamp", "i:response_id from_dttm to_dttm i:bad_rows")
def _(run):
    """Feed texts back to times, with texts the pattern must refuse."""
    spelled = F.date_format("data_from_dttm", "yyyy-MM-dd'T'HH:mm'Z'")
    texts = run.log.select(
        F.col("id").alias("response_id"),
        spelled.alias("good"),
        F.when(F.col("id") % 4 == 0, F.concat(spelled, F.lit("?"))).otherwise(spelled).alias("t"),
    )
    return texts.select(
        "response_id",
        feed_ts(F.col("good")).alias("from_dttm"),
        feed_ts(F.col("t")).alias("to_dttm"),
        F.when(feed_ts(F.col("t")).isNull(), 1).otherwise(0).alias("bad_rows"),
    )


# ---- ods -------------------------------------------------------------------

ODS = f"""i:source_id period_key {PERIOD} data_date i:data_year i:data_month i:data_day i:data_hour
          data_day_of_week i:data_day_of_week_num time_of_day day_type f:period_duration_minutes
          i:forecast_intensity i:actual_intensity i:forecast_error_gco2_kwh
          f:forecast_error_percent forecast_intensity_category actual_intensity_category
          index_forecast i:index_forecast_numeric index_actual i:index_actual_numeric data_status
          is_forecast_accurate valid_from_dttm source_processed_dttm"""


@query("ods_enrich", ODS)
def _(run):
    return run.ods


@query("surrogate_key", "i:source_id period_key fact_key")
def _(run):
    return run.fact_rows


@query(
    "calendar_fields",
    """i:source_id data_date i:data_year i:data_month i:data_day i:data_hour data_day_of_week
       i:data_day_of_week_num""",
)
def _(run):
    return run.ods


@query("time_of_day", "time_of_day i:data_hour i:n")
def _(run):
    return run.ods.groupBy("time_of_day", "data_hour").agg(F.count(F.lit(1)).alias("n"))


@query("day_type", "day_type data_day_of_week i:n")
def _(run):
    return run.ods.groupBy("day_type", "data_day_of_week").agg(F.count(F.lit(1)).alias("n"))


@query(
    "intensity_category",
    "i:source_id forecast_intensity_category actual_intensity_category",
)
def _(run):
    return run.ods


@query("is_forecast_accurate", "i:source_id is_forecast_accurate")
def _(run):
    return run.ods


@query(
    "last_n_days",
    "data_date i:last_90 i:last_30 i:last_7",
)
def _(run):
    as_of = run.cfg.as_of
    counts = last_days(run.ods, "data_date", as_of, 90)
    first = lambda n: F.date_sub(F.lit(as_of.date()), n)
    return counts.groupBy("data_date").agg(
        F.count(F.lit(1)).alias("last_90"),
        F.count(F.when(F.col("data_date") >= first(30), 1)).alias("last_30"),
        F.count(F.when(F.col("data_date") >= first(7), 1)).alias("last_7"),
    )


@query("last_hours_avg", "f:avg_forecast f:avg_actual")
def _(run):
    return avg_last_hours(run.raw, run.cfg.as_of, 24)


LEVELS = ("very_low", "low", "moderate", "high", "very_high")
CATEGORY_MINUTES = " ".join(
    f"i:forecast_{level}_count f:forecast_{level}_minutes" for level in LEVELS
)


@query(
    "daily_summary",
    f"""data_date i:data_year i:data_month i:data_day data_day_of_week i:data_day_of_week_num
        day_type i:total_periods i:hours_with_data i:min_forecast_intensity
        i:max_forecast_intensity f:avg_forecast_intensity f:median_forecast_intensity
        f:stddev_forecast_intensity i:periods_with_actual i:min_actual_intensity
        i:max_actual_intensity f:avg_actual_intensity f:median_actual_intensity
        f:avg_absolute_error f:avg_forecast_error_percent i:accurate_forecasts_count
        {CATEGORY_MINUTES} f:forecast_accuracy_percent f:data_completeness_percent
        f:forecast_volatility_percent""",
)
def _(run):
    return run.daily


@query("day_counts", "data_date i:total_periods i:hours_with_data i:periods_with_actual")
def _(run):
    return run.daily


@query(
    "day_min_max_avg",
    """data_date i:min_forecast_intensity i:max_forecast_intensity f:avg_forecast_intensity
       i:min_actual_intensity i:max_actual_intensity f:avg_actual_intensity""",
)
def _(run):
    return run.daily


@query("day_median", "data_date f:median_forecast_intensity f:median_actual_intensity")
def _(run):
    return run.daily


@query("day_stddev", "data_date f:stddev_forecast_intensity")
def _(run):
    return run.daily


@query("category_distribution", f"data_date {CATEGORY_MINUTES}")
def _(run):
    return run.daily


@query(
    "day_errors",
    "data_date f:avg_absolute_error f:avg_forecast_error_percent i:accurate_forecasts_count",
)
def _(run):
    return run.daily


@query(
    "day_ratios",
    """data_date f:forecast_accuracy_percent f:data_completeness_percent
       f:forecast_volatility_percent""",
)
def _(run):
    return run.daily


# ---- fact ------------------------------------------------------------------


@query(
    "fact",
    f"""i:source_id period_key fact_key {PERIOD} forecast_made_at t:forecast_valid_until
        f:forecast_horizon_hours i:forecast_intensity i:actual_intensity index_forecast
        index_actual is_current_version is_historical_version i:version_number i:total_versions
        i:prev_forecast_intensity i:forecast_change_from_prev src_processed_dttm processed_dttm
        f:forecast_ma3 f:forecast_ma12 f:forecast_ma48 i:forecast_change_from_prev_period
        f:forecast_pct_change_from_prev_period i:daily_intensity_rank
        f:daily_intensity_percentile f:avg_error_for_horizon i:weekly_min_intensity
        i:weekly_max_intensity short_term_trend f:weekly_volatility_pct is_outlier
        forecast_horizon_category""",
)
def _(run):
    return run.fact


@query("moving_averages", "i:source_id f:forecast_ma3 f:forecast_ma12 f:forecast_ma48")
def _(run):
    return with_series_windows(run.fact_rows, run.cfg)


@query(
    "period_change",
    """i:source_id i:forecast_change_from_prev_period
       f:forecast_pct_change_from_prev_period""",
)
def _(run):
    return with_series_windows(run.fact_rows, run.cfg)


@query("short_term_trend", "i:source_id short_term_trend")
def _(run):
    out = with_series_windows(run.fact_rows, run.cfg)
    return out.withColumn("short_term_trend", derived_fact_cols()["short_term_trend"])


@query("daily_rank", "i:source_id i:daily_intensity_rank")
def _(run):
    return with_daily_ranks(run.fact_rows, run.cfg)


@query("daily_percentile", "i:source_id f:daily_intensity_percentile")
def _(run):
    return with_daily_ranks(run.fact_rows, run.cfg)


@query("is_outlier", "i:source_id is_outlier")
def _(run):
    out = with_daily_ranks(run.fact_rows, run.cfg)
    return out.withColumn("is_outlier", derived_fact_cols()["is_outlier"])


@query("horizon_error", "i:source_id f:avg_error_for_horizon")
def _(run):
    return with_horizon_error(run.fact_rows, run.cfg)


@query("weekly_range", "i:source_id i:weekly_min_intensity i:weekly_max_intensity")
def _(run):
    return with_weekly_range(run.fact_rows, run.cfg)


@query("weekly_volatility", "i:source_id f:weekly_volatility_pct")
def _(run):
    out = with_weekly_range(run.fact_rows, run.cfg)
    return out.withColumn("weekly_volatility_pct", derived_fact_cols()["weekly_volatility_pct"])


def _categorised(run):
    """Fact rows with their horizon category, all the accuracy steps need of the fact."""
    return run.fact_rows.withColumn(
        "forecast_horizon_category", derived_fact_cols()["forecast_horizon_category"]
    )


@query("horizon_category", "i:source_id forecast_horizon_category")
def _(run):
    return _categorised(run)


# ---- accuracy --------------------------------------------------------------


def _accuracy_rows(run):
    return accuracy_rows(_categorised(run), run.cfg)


def _error_windows(run):
    return with_error_windows(_accuracy_rows(run), run.cfg)


@query(
    "forecast_accuracy",
    f"""accuracy_key fact_key period_key {PERIOD} forecast_made_at data_date i:data_hour
        f:forecast_horizon_hours forecast_horizon_category i:forecast_intensity
        i:actual_intensity i:error i:absolute_error f:squared_error f:absolute_percentage_error
        f:accuracy_percentage forecast_quality error_direction i:version_number
        is_current_version f:rolling_24h_mae f:rolling_24h_rmse f:rolling_24h_accuracy_rate
        f:weekly_avg_error is_improving""",
)
def _(run):
    return run.accuracy


@query(
    "error_metrics",
    """fact_key i:error i:absolute_error f:squared_error f:absolute_percentage_error
       f:accuracy_percentage""",
)
def _(run):
    return _accuracy_rows(run)


@query("forecast_quality", "fact_key forecast_quality")
def _(run):
    return _accuracy_rows(run)


@query("error_direction", "fact_key error_direction")
def _(run):
    return _accuracy_rows(run)


@query("rolling_mae", "fact_key f:rolling_24h_mae")
def _(run):
    return _error_windows(run)


@query("rolling_rmse", "fact_key f:rolling_24h_rmse")
def _(run):
    return _error_windows(run)


@query("rolling_accuracy", "fact_key f:rolling_24h_accuracy_rate")
def _(run):
    return _error_windows(run)


@query("is_improving", "fact_key is_improving")
def _(run):
    return _error_windows(run)


@query("weekly_error", "fact_key f:weekly_avg_error")
def _(run):
    return with_weekly_error(_accuracy_rows(run), run.cfg)


# ---- analytics mart --------------------------------------------------------

MART = """period_key period_start period_end data_date i:data_year i:data_month i:data_day
          i:data_hour data_day_of_week time_of_day day_type i:forecast_co2_gco2_kwh
          i:actual_co2_gco2_kwh forecast_category actual_category i:forecast_error
          f:forecast_error_percent is_forecast_accurate forecast_quality error_direction
          f:rolling_mean_absolute_error f:rolling_root_mean_squared_error
          f:rolling_accuracy_rate_pct energy_cleanliness_level is_peak_carbon_period
          consumption_recommendation f:historical_avg_for_hour f:intensity_z_score
          f:intensity_percentile_same_hour is_statistical_anomaly intensity_anomaly_type
          f:potential_co2_saving_per_kwh data_status"""


@query("analytics_mart", MART)
def _(run):
    return run.mart


@query(
    "analytics_join",
    """period_key data_from_dttm i:forecast_intensity i:absolute_error
       f:absolute_percentage_error forecast_quality error_direction f:rolling_24h_mae
       f:rolling_24h_rmse f:rolling_24h_accuracy_rate""",
)
def _(run):
    return analytics_join(run.ods, run.accuracy, run.cfg)


@query("potential_saving", "period_start i:forecast_co2_gco2_kwh f:potential_co2_saving_per_kwh")
def _(run):
    return run.mart


@query("min_hourly_avg", "f:min_hourly_avg_intensity")
def _(run):
    return min_hourly_avg(run.ods)


@query(
    "energy_cleanliness",
    "i:source_id energy_cleanliness",
)
def _(run):
    return with_business_flags(run.ods, run.cfg)


@query("peak_flag", "i:source_id is_peak_carbon_period")
def _(run):
    return with_business_flags(run.ods, run.cfg)


@query("recommendation", "i:source_id consumption_recommendation")
def _(run):
    return with_business_flags(run.ods, run.cfg)


@query(
    "same_hour_stats",
    "i:source_id f:avg_intensity_same_hour f:stddev_intensity_same_hour",
)
def _(run):
    return with_same_hour_stats(run.ods, run.cfg)


@query("z_score", "i:source_id f:intensity_z_score")
def _(run):
    return with_same_hour_stats(run.ods, run.cfg)


@query("same_hour_rank", "i:source_id i:intensity_rank_same_hour")
def _(run):
    return with_same_hour_ranks(run.ods, run.cfg)


@query("same_hour_percentile", "i:source_id f:intensity_percentile_same_hour")
def _(run):
    return with_same_hour_ranks(run.ods, run.cfg)


@query(
    "anomaly_flags",
    "period_key period_start is_statistical_anomaly intensity_anomaly_type",
)
def _(run):
    return run.mart


# ---- daily report ----------------------------------------------------------

PER_LEVEL = " ".join(f"i:periods_{level} f:avg_intensity_{level}" for level in LEVELS)
SHARES = " ".join(f"i:periods_{level} f:pct_{level}" for level in LEVELS)


@query(
    "daily_report",
    f"""data_date i:data_year i:data_month i:data_day data_day_of_week day_type date_formatted
        week_of_year i:total_periods i:hours_with_data f:data_completeness_pct
        f:avg_daily_intensity f:median_daily_intensity f:min_daily_intensity
        f:max_daily_intensity f:intensity_volatility {SHARES} f:avg_forecast_error
        f:avg_forecast_error_pct f:forecast_accuracy_rate daily_forecast_quality
        top_3_peak_hours top_3_best_hours f:avg_peak_intensity i:peak_periods_count
        i:anomaly_count f:prev_day_avg f:day_over_day_change f:prev_week_avg
        f:week_over_week_change f:ma7_intensity f:ma30_intensity short_term_trend
        daily_recommendation""",
)
def _(run):
    return run.report


@query(
    "report_daily_base",
    f"""data_date i:data_year i:data_month i:data_day data_day_of_week day_type i:total_periods
        i:hours_with_data i:min_forecast i:max_forecast f:avg_forecast f:median_forecast
        f:stddev_forecast i:min_actual i:max_actual f:avg_actual f:median_actual
        f:avg_absolute_error f:avg_error_percent f:avg_accuracy_rate {PER_LEVEL}""",
)
def _(run):
    return report_base(run.mart, run.cfg)


@query("category_avg", "data_date " + " ".join(f"f:avg_intensity_{level}" for level in LEVELS))
def _(run):
    return report_base(run.mart, run.cfg)


@query("peak_hours_text", "data_date top_3_peak_hours top_3_best_hours")
def _(run):
    return top_text(last_days(run.mart, "data_date", run.cfg.as_of, run.cfg.mart_days))


@query("peak_stats", "data_date f:avg_peak_intensity i:peak_periods_count i:anomaly_count")
def _(run):
    return peak_stats(last_days(run.mart, "data_date", run.cfg.as_of, run.cfg.mart_days))


@query("day_top_bottom", "data_date data_from_dttm i:forecast_intensity i:rnk i:rnk_low")
def _(run):
    ties = [F.col("data_from_dttm").asc()]
    return top_bottom(run.ods, ["data_date"], "forecast_intensity", ties, run.cfg)


@query("top3_per_day", "data_date side i:rnk data_from_dttm i:forecast_intensity")
def _(run):
    ties = [F.col("data_from_dttm").asc()]
    return top_k(run.ods, ["data_date"], "forecast_intensity", ties, k=3)


def _days(run):
    """Daily means of the periods under the names of the comparison step."""
    return with_day_comparison(
        run.daily.select("data_date", F.col("avg_forecast_intensity").alias("avg_forecast"))
    )


@query(
    "day_lags",
    """data_date f:prev_day_avg f:day_over_day_change f:prev_week_same_day_avg
       f:week_over_week_change""",
)
def _(run):
    return _days(run)


@query("day_moving_avg", "data_date f:ma7_forecast f:ma30_forecast")
def _(run):
    return _days(run)


@query("date_text", "data_date date_formatted week_of_year")
def _(run):
    return run.daily.select("data_date").withColumns(date_words())


def _compared_days(run):
    return with_day_comparison(report_base(run.mart, run.cfg)).withColumns(day_words())


@query("daily_quality", "data_date daily_forecast_quality")
def _(run):
    return _compared_days(run)


@query("daily_trend", "data_date short_term_trend")
def _(run):
    return _compared_days(run)


@query("daily_advice", "data_date daily_recommendation")
def _(run):
    return _compared_days(run)

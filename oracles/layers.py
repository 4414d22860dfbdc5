"""Oracle bodies of the layer queries: name -> (shared tables read, SQL)."""

from __future__ import annotations


from oracles.sql import AS_OF, AS_OF_DAY, OPEN_END, hours

BODIES: dict[str, tuple[str, str]] = {}


def whole(names: str, source: str) -> None:
    """Queries that are column choices of one shared table."""
    for name in names.split():
        BODIES[name] = (source, f"SELECT * FROM {source}")


whole("scd2_from_log scd2_any_order", "raw")
whole("stg_current period_minutes index_to_number forecast_error forecast_error_pct", "stg")
whole("stg_history text_normalise horizon_hours version_flags version_number", "hist")
whole("total_versions version_delta", "hist")
whole("ods_enrich calendar_fields intensity_category is_forecast_accurate", "ods")
whole("daily_summary day_counts day_min_max_avg day_median day_stddev day_errors", "daily")
whole("category_distribution day_ratios", "daily")
whole("fact moving_averages period_change short_term_trend daily_rank daily_percentile", "fact")
whole("is_outlier horizon_error weekly_range weekly_volatility horizon_category", "fact")
whole("surrogate_key", "fact")
whole("forecast_accuracy error_metrics forecast_quality error_direction rolling_mae", "acc")
whole("rolling_rmse rolling_accuracy is_improving weekly_error accuracy_load", "acc")
whole("analytics_mart potential_saving anomaly_flags", "mart")
whole("analytics_join", "combined")
whole("daily_report date_text daily_quality daily_trend daily_advice", "report")
whole("report_daily_base category_avg", "report0")
whole("peak_hours_text", "toptext")
whole("peak_stats", "peaks")

BODIES |= {
    "raw_current_view": ("raw", f"SELECT * FROM raw WHERE valid_to_dttm = {OPEN_END}"),
    "forecast_changes_view": (
        "raw",
        f"""SELECT *, valid_from_dttm AS forecast_made_at, valid_to_dttm AS forecast_valid_until,
                   {hours("valid_from_dttm", "data_from_dttm")} AS forecast_horizon_hours,
                   valid_to_dttm = {OPEN_END} AS is_current FROM raw""",
    ),
    "stg_sane_rows": (
        "raw",
        f"""SELECT * FROM (
              SELECT id, forecast_intensity - 60 AS forecast_intensity,
                     actual_intensity - 60 AS actual_intensity,
                     forecast_intensity - 60 AS period_duration_minutes
              FROM raw WHERE valid_to_dttm = {OPEN_END})
            WHERE period_duration_minutes BETWEEN 1 AND 60 AND forecast_intensity >= 0
              AND (actual_intensity IS NULL OR actual_intensity >= 0)""",
    ),
    "data_status": ("stg", "SELECT data_status, count(*) AS n FROM stg GROUP BY 1"),
    "feed_timestamp": (
        "obs",
        """SELECT id AS response_id, data_from_dttm AS from_dttm,
                  if(id % 4 = 0, NULL, data_from_dttm) AS to_dttm,
                  if(id % 4 = 0, 1, 0) AS bad_rows FROM obs""",
    ),
    "time_of_day": ("ods", "SELECT time_of_day, data_hour, count(*) AS n FROM ods GROUP BY 1, 2"),
    "day_type": (
        "ods",
        "SELECT day_type, data_day_of_week, count(*) AS n FROM ods GROUP BY 1, 2",
    ),
    "last_n_days": (
        "ods",
        f"""SELECT data_date, count(*) AS last_90,
                   count(*) FILTER (data_date >= {AS_OF_DAY} - 30) AS last_30,
                   count(*) FILTER (data_date >= {AS_OF_DAY} - 7) AS last_7
            FROM ods WHERE data_date >= {AS_OF_DAY} - 90 GROUP BY 1""",
    ),
    "last_hours_avg": (
        "raw",
        f"""SELECT avg(forecast_intensity) AS avg_forecast, avg(actual_intensity) AS avg_actual
            FROM raw WHERE data_from_dttm >= {AS_OF} - INTERVAL 24 HOURS""",
    ),
    "min_hourly_avg": (
        "ods",
        """SELECT min(m) AS min_hourly_avg_intensity
           FROM (SELECT avg(forecast_intensity) AS m FROM ods GROUP BY data_hour)""",
    ),
    "energy_cleanliness": (
        "ods",
        """SELECT source_id, CASE WHEN forecast_intensity < 100 THEN 'green_energy'
                  WHEN forecast_intensity <= 200 THEN 'moderate_impact'
                  WHEN forecast_intensity <= 300 THEN 'standard' ELSE 'high_carbon' END
                  AS energy_cleanliness FROM ods""",
    ),
    "peak_flag": (
        "ods",
        """SELECT source_id, forecast_intensity > 200 AND data_hour BETWEEN 6 AND 17
                  AND data_day_of_week_num <= 5 AS is_peak_carbon_period FROM ods""",
    ),
    "recommendation": (
        "ods combined",
        """SELECT DISTINCT source_id, consumption_recommendation
           FROM ods JOIN combined USING (period_key)""",
    ),
    "same_hour_stats": (
        "ods",
        """SELECT source_id, avg(forecast_intensity) OVER g AS avg_intensity_same_hour,
                  stddev_samp(forecast_intensity) OVER g AS stddev_intensity_same_hour
           FROM ods WINDOW g AS (PARTITION BY data_hour, day_type)""",
    ),
    "z_score": (
        "ods",
        """SELECT source_id, if(s > 0, (forecast_intensity - m) / s, 0) AS intensity_z_score
           FROM ods JOIN (SELECT data_hour, day_type, avg(forecast_intensity) AS m,
                                 stddev_samp(forecast_intensity) AS s
                          FROM ods GROUP BY 1, 2) USING (data_hour, day_type)""",
    ),
    "same_hour_rank": (
        "ods",
        """SELECT source_id, dense_rank() OVER (PARTITION BY data_hour, day_type
                  ORDER BY forecast_intensity DESC) AS intensity_rank_same_hour FROM ods""",
    ),
    "same_hour_percentile": (
        "ods",
        """SELECT source_id, 100 * percent_rank() OVER (PARTITION BY data_hour, day_type
                  ORDER BY forecast_intensity) AS intensity_percentile_same_hour FROM ods""",
    ),
    "day_top_bottom": (
        "ods",
        """SELECT *, row_number() OVER (PARTITION BY data_date
                     ORDER BY forecast_intensity DESC, data_from_dttm) AS rnk,
                  row_number() OVER (PARTITION BY data_date
                     ORDER BY forecast_intensity, data_from_dttm) AS rnk_low FROM ods""",
    ),
    "top3_per_day": (
        "ods",
        """SELECT *, 'high' AS side, row_number() OVER (PARTITION BY data_date
                     ORDER BY forecast_intensity DESC, data_from_dttm) AS rnk
           FROM ods QUALIFY rnk <= 3
           UNION ALL
           SELECT *, 'low', row_number() OVER (PARTITION BY data_date
                     ORDER BY forecast_intensity, data_from_dttm) AS rnk
           FROM ods QUALIFY rnk <= 3""",
    ),
}
_DAYS = """
    SELECT *, m - prev_day_avg AS day_over_day_change,
           m - prev_week_same_day_avg AS week_over_week_change
    FROM (SELECT data_date, avg_forecast_intensity AS m, lag(m) OVER d AS prev_day_avg,
                 lag(m, 7) OVER d AS prev_week_same_day_avg,
                 avg(m) OVER (d ROWS 6 PRECEDING) AS ma7_forecast,
                 avg(m) OVER (d ROWS 29 PRECEDING) AS ma30_forecast
          FROM daily WINDOW d AS (ORDER BY data_date))"""
BODIES["day_lags"] = BODIES["day_moving_avg"] = ("daily", _DAYS)

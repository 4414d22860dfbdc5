"""Oracle bodies of the mart explorations."""

from __future__ import annotations

from oracles.sql import exact_mean

from foreledger.config import DAY_NAMES, DAY_PARTS

V = "forecast_co2_gco2_kwh"
_PLACES = ", ".join(f"'{p}'" for p in DAY_PARTS)
_COUNTED = (
    "forecast_category",
    "energy_cleanliness_level",
    "intensity_anomaly_type",
    "is_peak_carbon_period",
)
_STATS = (
    ("count", f"count({V})"),
    ("mean", f"avg({V})"),
    ("std", f"stddev_samp({V})"),
    ("min", f"min({V})"),
    ("25%", f"quantile_cont({V}, 0.25)"),
    ("50%", f"quantile_cont({V}, 0.5)"),
    ("75%", f"quantile_cont({V}, 0.75)"),
    ("max", f"max({V})"),
)
_INSIGHTS = (
    ("total_rows", "count(*)"),
    ("days_span", "max(data_date) - min(data_date)"),
    ("mean_value", f"avg({V})"),
    ("min_value", f"min({V})"),
    ("max_value", f"max({V})"),
    ("std_value", f"stddev_samp({V})"),
    ("peak_share_pct", "100.0 * count(*) FILTER (is_peak_carbon_period) / count(*)"),
    (
        "green_share_pct",
        "100.0 * count(*) FILTER (energy_cleanliness_level = 'green_energy') / count(*)",
    ),
    ("anomalies", "count(*) FILTER (is_statistical_anomaly)"),
)


def _rows(label: str, entries) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, ({sql})::DOUBLE AS value FROM month" for name, sql in entries
    )


BODIES: dict[str, tuple[str, str]] = {
    "mart_read": ("month", "SELECT * FROM month"),
    "anomaly_examples": (
        "month",
        f"""SELECT * FROM month WHERE is_statistical_anomaly
            ORDER BY period_start, {V}, intensity_anomaly_type LIMIT 10""",
    ),
    "anomaly_rows": (
        "month",
        "SELECT *, intensity_z_score AS z FROM month WHERE is_statistical_anomaly",
    ),
    "n_largest": ("month", f"SELECT * FROM month ORDER BY {V} DESC, period_start DESC LIMIT 5"),
    "best_worst_hours": (
        "month",
        f"""SELECT *, row_number() OVER (ORDER BY mean_value, data_hour) AS best_rank,
                   row_number() OVER (ORDER BY mean_value DESC, data_hour DESC) AS worst_rank
            FROM (SELECT data_hour, avg({V}) AS mean_value FROM month GROUP BY 1)
            QUALIFY best_rank <= 3 OR worst_rank <= 3""",
    ),
    "rolling_mean_48": (
        "month",
        f"""SELECT period_start, avg({V}) OVER (ORDER BY period_start ROWS 47 PRECEDING)
                   AS mean_24h FROM month""",
    ),
    "describe": ("month", _rows("statistic", _STATS)),
    "value_counts": (
        "month",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS n FROM month "
            f"WHERE {c} IS NOT NULL GROUP BY 2"
            for c in _COUNTED
        ),
    ),
    "daily_band": (
        "month",
        f"""SELECT data_date, avg({V}) AS mean, min({V}) AS low, max({V}) AS high
            FROM month GROUP BY 1""",
    ),
    "time_of_day_stats": (
        "month",
        f"""SELECT *, list_position([{_PLACES}], time_of_day) AS place,
                   first(time_of_day) OVER (ORDER BY mean) AS best_time,
                   first(time_of_day) OVER (ORDER BY mean DESC) AS worst_time
            FROM (SELECT time_of_day, avg({V}) AS mean, stddev_samp({V}) AS std
                  FROM month GROUP BY 1)""",
    ),
    "day_type_stats": (
        "month",
        f"SELECT day_type, avg({V}) AS mean, median({V}) AS median FROM month GROUP BY 1",
    ),
    "hour_dow_heatmap": (
        "month",
        "SELECT data_hour, "
        + ", ".join(
            f"avg({V}) FILTER (data_day_of_week = '{d}') AS {d.lower()}" for d in DAY_NAMES
        )
        + " FROM month GROUP BY 1",
    ),
    "scatter_bounds": (
        "month",
        f"""SELECT count(*) AS pairs, least(min({V}), min(actual_co2_gco2_kwh)) AS low,
                   greatest(max({V}), max(actual_co2_gco2_kwh)) AS high
            FROM month WHERE actual_co2_gco2_kwh IS NOT NULL""",
    ),
    "error_histogram": (
        "month",
        """SELECT bin, n, lo + bin * (hi - lo) / 30 AS bin_start,
                  lo + (bin + 1) * (hi - lo) / 30 AS bin_end
           FROM (SELECT least(floor((forecast_error - lo) * 30 / (hi - lo)), 29) AS bin,
                        any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS n
                 FROM month, (SELECT min(forecast_error)::DOUBLE AS lo,
                                     max(forecast_error)::DOUBLE AS hi FROM month)
                 WHERE forecast_error IS NOT NULL GROUP BY 1)""",
    ),
    "accuracy_summary": (
        "month",
        f"""SELECT count(*) AS rows_with_actual, avg(abs(forecast_error)) AS mae,
                  {exact_mean("abs(forecast_error_percent)")} AS mape,
                  100.0 * count(*) FILTER (is_forecast_accurate) / count(*) AS accuracy_rate
           FROM month WHERE actual_co2_gco2_kwh IS NOT NULL""",
    ),
    "anomaly_summary": (
        "month",
        """SELECT intensity_anomaly_type, count(*) AS n, any_value(a) AS anomalies,
                  any_value(round(a * 100.0 / r, 1)) AS anomaly_share_pct
           FROM month, (SELECT count(*) FILTER (is_statistical_anomaly) AS a, count(*) AS r
                        FROM month)
           WHERE is_statistical_anomaly GROUP BY 1""",
    ),
    "shift_saving": (
        "month",
        f"""SELECT o AS overall_mean, b AS best_hour_mean, o - b AS saving,
                   (o - b) * 100 / o AS saving_pct
            FROM (SELECT avg({V}) AS o FROM month),
                 (SELECT min(m) AS b FROM (SELECT avg({V}) AS m FROM month GROUP BY data_hour))""",
    ),
    "insights": ("month", _rows("metric", _INSIGHTS)),
}

"""Oracle bodies of the data tests, monitors and gaps."""

from __future__ import annotations

from foreledger.config import CATEGORIES, DAILY_QUALITY, DAILY_TREND_WORDS, INDEX_NUMBERS
from oracles.sql import AS_OF, hours, key

BODIES: dict[str, tuple[str, str]] = {}


def judged(days: str, keys: str, metric: str) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""
        SELECT *, coalesce(history_size >= 7 AND history_stddev > 0
                    AND abs({metric} - history_mean) > 3 * history_stddev, FALSE) AS is_anomaly
        FROM (SELECT *, count({metric}) OVER h AS history_size, avg({metric}) OVER h
                          AS history_mean, stddev_samp({metric}) OVER h AS history_stddev
              FROM ({days})
              WINDOW h AS ({part}ORDER BY bucket ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))"""


def column_metrics(source: str, ts: str, columns: dict[str, str]) -> str:
    """One branch per column and metric; `columns` maps a name to number | text | other."""
    nulls = "count(*) FILTER ({c} IS NULL)"
    both = {"null_count": nulls, "null_pct": f"100.0 * {nulls} / count(*)"}
    number = {"min": "min({c})", "max": "max({c})", "avg": "avg({c})", "stddev": "stddev_samp({c})"}
    text = {f"{f}_length": f"{f}(length({{c}}))" for f in ("min", "avg", "max")}
    extra = {"number": number, "text": text, "other": {}}
    branches = []
    for name, kind in columns.items():
        for metric, sql in (both | extra[kind]).items():
            branches.append(
                f"SELECT '{name}' AS column_name, '{metric}' AS metric, {ts}::DATE AS bucket, "
                f"({sql.format(c=name)})::DOUBLE AS metric_value FROM {source} GROUP BY bucket"
            )
    return judged(" UNION ALL ".join(branches), "column_name, metric", "metric_value")


_STG_COLUMNS = {
    "id": "number",
    "data_to_dttm": "other",
    "period_duration_minutes": "number",
    "forecast_intensity": "number",
    "actual_intensity": "number",
    "forecast_error_gco2_kwh": "number",
    "forecast_error_percent": "number",
    "index_forecast": "text",
    "index_forecast_numeric": "number",
    "index_actual": "text",
    "index_actual_numeric": "number",
    "data_status": "text",
    "valid_from_dttm": "other",
    "valid_to_dttm": "other",
    "src_processed_dttm": "other",
    "processed_dttm": "other",
}
_ODS_COLUMNS = """source_id period_key data_from_dttm data_to_dttm data_date data_year data_month
    data_day data_hour data_day_of_week data_day_of_week_num time_of_day day_type
    period_duration_minutes forecast_intensity actual_intensity forecast_error_gco2_kwh
    forecast_error_percent forecast_intensity_category actual_intensity_category index_forecast
    index_forecast_numeric index_actual index_actual_numeric data_status is_forecast_accurate
    valid_from_dttm source_processed_dttm""".split()
_GAPS = f"""
    SELECT user_id, ts, event_id, lag(ts) OVER u AS prev_period,
           {hours("lag(ts) OVER u", "ts", "60000000.0")} AS gap_minutes
    FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)"""
_WORDS = ", ".join(f"'{w}'" for w in INDEX_NUMBERS)
_LEVELS = ", ".join(f"'{c}'" for c in CATEGORIES)


def _tests(table: str, entries: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{test}' AS test, '{col}' AS column_name, 'warn' AS severity, "
        f"(SELECT count(*) FROM {table} WHERE {fails}) AS failures"
        for test, col, fails in entries
    )


_NOT_NULL = """source_id period_key data_from_dttm data_date data_year data_day_of_week time_of_day
    day_type forecast_intensity forecast_intensity_category data_status is_forecast_accurate""".split()
_SUMMARY = [("not_null", c, f"{c} IS NULL") for c in _NOT_NULL]
_SUMMARY += [
    ("not_null", "updated_at", "FALSE"),
    ("accepted_values", "time_of_day",
     "time_of_day NOT IN ('morning', 'afternoon', 'evening', 'night')"),
    ("accepted_values", "day_type", "day_type NOT IN ('weekday', 'weekend')"),
    ("accepted_values", "forecast_intensity_category",
     f"forecast_intensity_category NOT IN ({_LEVELS})"),
    ("accepted_values", "data_status",
     "data_status NOT IN ('completed', 'in_progress', 'future')"),
    ("not_null", "actual_intensity", "data_status = 'completed' AND actual_intensity IS NULL"),
    ("accepted_range", "data_year", "data_year NOT BETWEEN 2020 AND 2030"),
    ("accepted_range", "forecast_intensity", "forecast_intensity NOT BETWEEN 0 AND 1000"),
    ("unique", "source_id", "source_id IN (SELECT source_id FROM ods GROUP BY 1 HAVING count(*) > 1)"),
    ("unique", "period_key",
     "period_key IN (SELECT period_key FROM ods GROUP BY 1 HAVING count(*) > 1)"),
]

BODIES |= {
    "relationships_check": (
        "fact0 ods_old",
        """SELECT 'lineitem -> orders' AS link, l_orderkey AS child_key, count(*) AS n
           FROM lineitem WHERE l_returnflag = 'N' AND NOT EXISTS
             (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
           GROUP BY l_orderkey
           UNION ALL
           SELECT 'fact -> periods', source_id, count(*) FROM fact0
           WHERE is_current_version AND NOT EXISTS
             (SELECT 1 FROM ods_old o WHERE o.period_key = fact0.period_key)
           GROUP BY source_id""",
    ),
    "dq_unique": (
        "",
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    ),
    "dq_not_null": (
        "ods",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM ods"
            for c in _ODS_COLUMNS
        )
        + ") WHERE failures > 0",
    ),
    "dq_accepted_values": (
        "raw",
        f"""SELECT index_forecast, count(*) AS n FROM raw
            WHERE index_forecast NOT IN ({_WORDS}) GROUP BY 1""",
    ),
    "dq_accepted_range": (
        "fact",
        """SELECT * FROM fact
           WHERE forecast_pct_change_from_prev_period NOT BETWEEN -100 AND 100""",
    ),
    "dq_time_range": (
        "raw",
        """SELECT * FROM (SELECT id, data_from_dttm,
             CASE WHEN data_from_dttm < TIMESTAMP '2024-01-02' THEN 'Before min_date'
                  WHEN data_from_dttm > TIMESTAMP '2024-01-31' THEN 'After max_date'
                  WHEN data_from_dttm IS NULL THEN 'NULL value' END AS validation_error
             FROM raw) WHERE validation_error IS NOT NULL""",
    ),
    "dq_forecast_logic": (
        "raw",
        f"""SELECT {key("data_from_dttm", "data_to_dttm")} AS period_key, data_from_dttm,
                   f AS forecast_intensity, a AS actual_intensity, abs(f - a) AS absolute_error,
                   p AS error_percent,
                   CASE WHEN p > 100 THEN 'Forecast error too high (> 100%)'
                        WHEN f <= 0 THEN 'Invalid forecast value'
                        ELSE 'Invalid actual value' END AS failure_reason
            FROM (SELECT *, CASE WHEN a > 0 THEN abs(f - a) * 100.0::DOUBLE / a END AS p
                  FROM (SELECT data_from_dttm, data_to_dttm, forecast_intensity - 50 AS f,
                               (actual_intensity - 50) // 2 AS a
                        FROM raw WHERE valid_to_dttm = TIMESTAMP '5999-01-01')
                  WHERE f >= 0 AND a >= 0)
            WHERE p > 100 OR f <= 0 OR a <= 0""",
    ),
    "dq_source_freshness": (
        "raw",
        f"""SELECT latest, h AS hours_old, CASE WHEN h > 4 THEN 'error' WHEN h > 2 THEN 'warn'
                   ELSE 'pass' END AS status, h > 2 AS is_stale
            FROM (SELECT max(processed_dttm) AS latest, {hours("max(processed_dttm)", AS_OF)} AS h
                  FROM raw)""",
    ),
    "dq_expression": ("ods", "SELECT * FROM ods WHERE abs(forecast_error_gco2_kwh) > 20"),
    "dq_sequential": (
        "",
        """SELECT * FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER
             (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous FROM lineitem)
           WHERE l_linenumber <> previous + 1""",
    ),
    "dq_summary": ("ods", _tests("ods", _SUMMARY)),
    "dq_volume_anomaly": (
        "",
        judged("SELECT ts::DATE AS bucket, count(*) AS row_count FROM events GROUP BY 1", "",
               "row_count"),
    ),
    "dq_freshness_anomaly": (
        "",
        judged(
            f"""SELECT ts::DATE AS bucket, max(g) AS max_gap_minutes
                FROM (SELECT ts, {hours("lag(ts) OVER (ORDER BY ts, event_id)", "ts",
                                        "60000000.0")} AS g FROM events) GROUP BY 1""",
            "",
            "max_gap_minutes",
        ),
    ),
    "dq_event_freshness": (
        "raw",
        judged(
            f"""SELECT data_from_dttm::DATE AS bucket,
                       max({hours("data_from_dttm", "processed_dttm")}) AS max_delay_hours
                FROM raw GROUP BY 1""",
            "",
            "max_delay_hours",
        ),
    ),
    "dq_dimension_anomaly": (
        "fact",
        judged(
            """SELECT forecast_horizon_category, forecast_made_at::DATE AS bucket,
                      count(*) AS row_count FROM fact GROUP BY 1, 2""",
            "forecast_horizon_category",
            "row_count",
        ),
    ),
    "dq_column_anomaly": (
        "stg",
        column_metrics("stg", "data_from_dttm", {"forecast_intensity": "number"}),
    ),
    "dq_all_columns_anomaly": ("stg", column_metrics("stg", "data_from_dttm", _STG_COLUMNS)),
    "gap_check": (
        "",
        f"SELECT *, gap_minutes * 60 AS gap_seconds FROM ({_GAPS}) WHERE gap_minutes > 120",
    ),
    "gap_islands": (
        "",
        f"""SELECT user_id, island, min(ts) AS island_start, max(ts) AS island_end,
                   count(*) AS rows
            FROM (SELECT user_id, ts,
                         sum(CASE WHEN gap_minutes <= 120 THEN 0 ELSE 1 END) OVER
                           (PARTITION BY user_id ORDER BY ts, event_id
                            ROWS UNBOUNDED PRECEDING) AS island FROM ({_GAPS}))
            GROUP BY 1, 2""",
    ),
    "tumbling_half_hour": (
        "",
        """SELECT time_bucket(INTERVAL 30 MINUTES, ts) AS window_start,
                  window_start + INTERVAL 30 MINUTES AS window_end, count(*) AS n,
                  avg(value) AS mean_value FROM events GROUP BY 1""",
    ),
}


def _words(*values: str) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _layer(table, nulls, values=(), ranges=(), keys=(), parents=(), clock=()) -> tuple[str, str]:
    """The declared tests of one layer; `clock` columns hold the load time and are never NULL."""
    entries = [("not_null", c, "FALSE" if c in clock else f"{c} IS NULL") for c in nulls.split()]
    entries += [("accepted_values", c, f"{c} NOT IN ({listed})") for c, listed in values]
    entries += [("accepted_range", c, f"{c} NOT BETWEEN {lo} AND {hi}") for c, lo, hi in ranges]
    body = _tests(table, entries)
    for c in keys:
        body += f""" UNION ALL SELECT 'unique', '{c}', 'warn', (SELECT count(*) FROM
            (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"""
    for c, parent, where in parents:
        body += f""" UNION ALL SELECT 'relationships', '{c}', 'warn', (SELECT count(*) FROM {table} c
            WHERE {c} IS NOT NULL AND {where}
              AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{c} = c.{c}))"""
    return " ".join([table, *[p for _, p, _ in parents]]), body


_STATUS = _words("completed", "in_progress", "future")
_DAYS = _words("weekday", "weekend")
_PARTS = _words("morning", "afternoon", "evening", "night")
_BOTH = "TRUE, FALSE"
_TO_1000 = [("forecast_intensity", 0, 1000)]
BODIES["dq_raw"] = _layer(
    "raw", "id data_from_dttm data_to_dttm valid_from_dttm valid_to_dttm",
    [("index_forecast", _WORDS)], keys=["id"],
)
BODIES["dq_current"] = _layer(
    "stg",
    """id data_from_dttm data_to_dttm period_duration_minutes forecast_intensity index_forecast
       index_forecast_numeric data_status valid_from_dttm updated_at""",
    [("period_duration_minutes", "30.0"), ("index_forecast", _WORDS),
     ("index_forecast_numeric", ", ".join(str(n) for n in INDEX_NUMBERS.values())),
     ("index_actual", _WORDS), ("data_status", _STATUS)],
    [("period_duration_minutes", 25, 35), *_TO_1000, ("actual_intensity", 0, 1000),
     ("forecast_error_percent", -100, 100)],
    ["id"], clock=["updated_at"],
)
BODIES["dq_history"] = _layer(
    "hist",
    """id data_from_dttm forecast_made_at forecast_horizon_hours version_number total_versions
       is_current_version""",
    [("is_current_version", _BOTH)], [("version_number", 1, 1000), ("total_versions", 1, 1000)], ["id"],
)
BODIES["dq_daily"] = _layer(
    "daily",
    "data_date total_periods avg_forecast_intensity data_completeness_percent hours_with_data", [],
    [("total_periods", 1, 100), ("avg_forecast_intensity", 0, 1000),
     ("forecast_accuracy_percent", 0, 100), ("data_completeness_percent", 0, 100),
     ("forecast_volatility_percent", 0, 1000)],
    ["data_date"],
)
BODIES["dq_fact"] = _layer(
    "fact",
    """fact_key period_key data_from_dttm forecast_made_at forecast_horizon_hours
       forecast_horizon_category forecast_intensity forecast_ma3 forecast_ma12 daily_intensity_rank
       daily_intensity_percentile short_term_trend is_outlier is_current_version version_number""",
    [("forecast_horizon_category",
      _words("immediate", "short_term", "medium_term", "long_term", "very_long_term")),
     ("short_term_trend", _words("rising", "falling", "stable")), ("is_outlier", _BOTH)],
    [*_TO_1000, ("forecast_pct_change_from_prev_period", -100, 100),
     ("daily_intensity_percentile", 0, 100), ("version_number", 1, 1000)],
    ["fact_key"], [("period_key", "ods", "is_current_version")],
)
BODIES["dq_accuracy"] = _layer(
    "acc",
    """accuracy_key fact_key period_key data_from_dttm data_date forecast_made_at actual_intensity
       absolute_error squared_error forecast_quality error_direction is_improving rolling_24h_mae""",
    [("forecast_quality", _words("excellent", "good", "acceptable", "poor")),
     ("error_direction", _words("overestimated", "underestimated", "exact")), ("is_improving", _BOTH)],
    [("absolute_error", 0, 500), ("absolute_percentage_error", 0, 1000),
     ("accuracy_percentage", 0, 100), ("rolling_24h_accuracy_rate", 0, 100)],
    ["accuracy_key"], [("fact_key", "fact", "TRUE")],
)
BODIES["dq_analytics"] = _layer(
    "mart",
    """period_key period_start data_date time_of_day day_type forecast_co2_gco2_kwh forecast_category
       energy_cleanliness_level is_peak_carbon_period consumption_recommendation intensity_z_score
       intensity_percentile_same_hour is_statistical_anomaly intensity_anomaly_type data_status""",
    [("time_of_day", _PARTS), ("day_type", _DAYS), ("forecast_category", _LEVELS),
     ("actual_category", _LEVELS),
     ("energy_cleanliness_level",
      _words("green_energy", "moderate_impact", "standard", "high_carbon")),
     ("is_peak_carbon_period", _BOTH),
     ("intensity_anomaly_type", _words("unusually_high", "unusually_low", "normal")),
     ("data_status", _STATUS)],
    [("forecast_co2_gco2_kwh", 0, 1000), ("actual_co2_gco2_kwh", 0, 1000),
     ("intensity_percentile_same_hour", 0, 100)],
)
BODIES["dq_report"] = _layer(
    "report",
    """data_date data_day_of_week day_type total_periods data_completeness_pct avg_daily_intensity
       min_daily_intensity max_daily_intensity top_3_peak_hours top_3_best_hours short_term_trend
       daily_recommendation""",
    [("day_type", _DAYS), ("daily_forecast_quality", _words(*[w for _, w in DAILY_QUALITY])),
     ("short_term_trend", _words(*DAILY_TREND_WORDS))],
    [("total_periods", 1, 100), ("data_completeness_pct", 0, 100), ("avg_daily_intensity", 0, 1000),
     ("forecast_accuracy_rate", 0, 100)],
    ["data_date"],
)

# the monitors on stored metrics judge what those over the rows do
BODIES["metrics_columns"] = BODIES["dq_all_columns_anomaly"]
BODIES["metrics_volume"] = BODIES["dq_volume_anomaly"]
BODIES["metrics_freshness"] = BODIES["dq_freshness_anomaly"]
BODIES["metrics_dimension"] = (
    "",
    judged(
        "SELECT event_type, ts::DATE AS bucket, count(*) AS row_count FROM events GROUP BY 1, 2",
        "event_type",
        "row_count",
    ),
)
_WAIT = hours("lag(ts) OVER (PARTITION BY event_type, week ORDER BY ts, event_id)", "ts", "60000000.0")
BODIES["metrics_weeks"] = (
    "",
    f"""SELECT week, event_type, count(*) AS rows, avg(value) AS mean_value,
               stddev_samp(value) AS stddev_value, min(value) AS min_value,
               max(value) AS max_value, max(wait) AS longest_wait
        FROM (SELECT *, {_WAIT} AS wait
              FROM (SELECT *, date_trunc('week', ts)::DATE AS week FROM events))
        GROUP BY 1, 2""",
)
_ROW_TESTS = {
    "ods_periods": ("ods", _tests("ods", [t for t in _SUMMARY if t[0] != "unique"])),
    "ods_daily_summary": ("daily", _layer(
        "daily",
        "data_date total_periods avg_forecast_intensity data_completeness_percent hours_with_data", [],
        [("total_periods", 1, 100), ("avg_forecast_intensity", 0, 1000),
         ("forecast_accuracy_percent", 0, 100), ("data_completeness_percent", 0, 100),
         ("forecast_volatility_percent", 0, 1000)],
    )[1]),
}
BODIES["dq_in_writes"] = (
    "ods daily",
    " UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, *, (SELECT count(*) FROM {table}) AS tested
            FROM ({body})"""
        for layer, (table, body) in _ROW_TESTS.items()
    ),
)
BODIES["late_actuals"] = (
    "obs",
    """SELECT f.id, f.data_from_dttm, f.forecast_intensity, a.actual_intensity, a.reported_at
       FROM obs f LEFT JOIN
         (SELECT data_from_dttm, data_to_dttm, actual_intensity, created_at AS reported_at
          FROM obs WHERE actual_intensity IS NOT NULL
            AND created_at >= data_from_dttm - INTERVAL 12 HOURS
            AND created_at <= data_from_dttm + INTERVAL 1 DAY
          QUALIFY row_number() OVER (PARTITION BY data_from_dttm, data_to_dttm
                                     ORDER BY created_at, actual_intensity) = 1) a
         USING (data_from_dttm, data_to_dttm)""",
)

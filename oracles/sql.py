"""Small helpers to spell SQL, and the shared table expressions of the layers."""

from __future__ import annotations

from foreledger.config import (
    CATEGORIES,
    DAILY_ADVICE,
    DAILY_ADVICE_REST,
    DAILY_QUALITY,
    DAILY_TREND_WORDS,
    FORECAST_QUALITY,
    HORIZON_BAND_REST,
    HORIZON_BANDS,
    HORIZON_CATEGORIES,
    HORIZON_CATEGORY_REST,
    HOUR_MARK,
    INDEX_NUMBERS,
    NO_RECOMMENDATION,
    RECOMMENDATIONS,
    TREND_WORDS,
    UNIT_TEXT,
)

AS_OF = "TIMESTAMP '2024-02-01'"
AS_OF_DAY = "DATE '2024-02-01'"
OPEN_END = "TIMESTAMP '5999-01-01'"


def lit(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def case(value: str, test: str, steps, rest=None) -> str:
    arms = " ".join(f"WHEN {value} {test} {lit(b)} THEN {lit(label)}" for b, label in steps)
    return f"CASE {arms} ELSE {lit(rest)} END"


def one_of(value: str, mapping, rest=None) -> str:
    return case(value, "=", mapping.items(), rest)


def share(part: str, whole: str, digits: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(({part}) * 100.0::DOUBLE / ({whole}), {digits}) END"


def trend(short: str, long: str, words) -> str:
    up, down, level = words
    return (
        f"CASE WHEN {short} > {long} * 1.05::DOUBLE THEN '{up}' "
        f"WHEN {short} < {long} * 0.95::DOUBLE THEN '{down}' ELSE '{level}' END"
    )


def hours(a: str, b: str, per: str = "3600000000.0") -> str:
    return f"(epoch_us({b}) - epoch_us({a})) / {per}::DOUBLE"


def exact_mean(value: str, digits: int = 2) -> str:
    scaled = f"round(({value}) * {10**digits})::BIGINT"
    return f"sum({scaled}) / nullif(count({value}) * {10**digits}, 0)"


def key(*cols: str) -> str:
    parts = ", ".join(f"coalesce({c}::VARCHAR, '_null_')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def output(spec: str) -> str:
    """Select list of a column spec: `i:` integers as BIGINT, `f:` doubles to 6 places, `t:` as text."""
    cols = []
    for item in spec.split():
        kind, _, name = item.rpartition(":")
        if kind == "i":
            cols.append(f"{name}::BIGINT AS {name}")
        elif kind == "f":
            cols.append(f"round({name}::DOUBLE, 6) + 0.0::DOUBLE AS {name}")
        elif kind == "t":
            cols.append(f"{name}::VARCHAR AS {name}")
        else:
            cols.append(name)
    return ", ".join(cols)


STEPS = ((300, "very high"), (200, "high"), (150, "moderate"), (100, "low"))
LEVELS = ((300, "very_high"), (200, "high"), (150, "moderate"), (100, "low"))
PART_OF_DAY = ((6, "night"), (12, "morning"), (18, "afternoon"), (23, "evening"))

# name -> (names it reads, body)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def table(name: str, reads: str, body: str) -> None:
    TABLES[name] = (tuple(reads.split()), body)


table(
    "obs0",
    "",
    """
    SELECT event_id AS id, ts AS created_at, user_id, event_type,
           round(value * 100)::BIGINT AS c,
           time_bucket(INTERVAL 30 MINUTES, ts)
             + to_minutes(30 * ((event_id * 7) % 61 - 1)) AS data_from_dttm
    FROM events""",
)
table(
    "obs1",
    "obs0",
    """
    SELECT *, data_from_dttm + INTERVAL 30 MINUTES AS data_to_dttm,
           least(50 + (3 * c) // 100, 1000)::INT AS forecast_intensity,
           CASE WHEN event_type IN ('purchase', 'signup', 'view')
                THEN least(50 + (3 * c * (85 + 3 * (user_id % 10))) // 10000, 1000)::INT
           END AS actual_intensity
    FROM obs0""",
)
table(
    "obs",
    "obs1",
    f"""
    SELECT id, created_at, data_from_dttm, data_to_dttm, forecast_intensity, actual_intensity,
           spelled AS index_forecast, spelled AS index_actual
    FROM (SELECT *, CASE id % 3 WHEN 1 THEN upper(label) WHEN 2 THEN ' ' || label || ' '
                    ELSE label END AS spelled
          FROM (SELECT *, {case("forecast_intensity", ">=", STEPS, "very low")} AS label
                FROM obs1))""",
)
_CHANGED = """
    SELECT *, date_trunc('second', created_at) AS valid_from_dttm
    FROM (SELECT *, row_number() OVER p AS seen,
                 lag(forecast_intensity) OVER p AS f0, lag(actual_intensity) OVER p AS a0,
                 lag(index_forecast) OVER p AS if0, lag(index_actual) OVER p AS ia0
          FROM {source}
          WINDOW p AS (PARTITION BY data_from_dttm, data_to_dttm ORDER BY created_at, id))
    WHERE seen = 1 OR forecast_intensity IS DISTINCT FROM f0
          OR actual_intensity IS DISTINCT FROM a0
          OR index_forecast IS DISTINCT FROM if0 OR index_actual IS DISTINCT FROM ia0"""
_VERSIONS = """
    SELECT id, data_from_dttm, data_to_dttm, forecast_intensity, actual_intensity,
           index_forecast, index_actual, valid_from_dttm,
           CASE WHEN lead(valid_from_dttm) OVER p IS NULL THEN TIMESTAMP '5999-01-01'
                ELSE greatest(lead(valid_from_dttm) OVER p - INTERVAL 1 SECOND, valid_from_dttm)
           END AS valid_to_dttm,
           created_at AS src_processed_dttm, valid_from_dttm AS processed_dttm
    FROM {source}
    WINDOW p AS (PARTITION BY data_from_dttm, data_to_dttm ORDER BY created_at, id)"""
table("changed", "obs", _CHANGED.format(source="obs"))
table("raw", "changed", _VERSIONS.format(source="changed"))

_STG = """
    SELECT id, data_from_dttm, data_to_dttm,
           {minutes} AS period_duration_minutes,
           forecast_intensity, actual_intensity,
           forecast_intensity - actual_intensity AS forecast_error_gco2_kwh,
           {pct} AS forecast_error_percent,
           lower(trim(index_forecast)) AS index_forecast,
           {fnum} AS index_forecast_numeric,
           lower(trim(index_actual)) AS index_actual,
           {anum} AS index_actual_numeric,
           CASE WHEN actual_intensity IS NOT NULL THEN 'completed'
                WHEN data_from_dttm <= {now} THEN 'in_progress' ELSE 'future' END AS data_status,
           valid_from_dttm, valid_to_dttm, src_processed_dttm, processed_dttm
    FROM raw WHERE valid_to_dttm = {end}"""
table(
    "stg_all",
    "raw",
    _STG.format(
        minutes=hours("data_from_dttm", "data_to_dttm", "60000000.0"),
        pct=share("forecast_intensity - actual_intensity", "actual_intensity", 2),
        fnum=one_of("lower(trim(index_forecast))", INDEX_NUMBERS),
        anum=one_of("lower(trim(index_actual))", INDEX_NUMBERS),
        now=AS_OF,
        end=OPEN_END,
    ),
)
table(
    "stg",
    "stg_all",
    """
    SELECT * FROM stg_all
    WHERE period_duration_minutes > 0 AND period_duration_minutes <= 60
      AND forecast_intensity >= 0 AND coalesce(actual_intensity, 0) >= 0""",
)
table(
    "hist",
    "raw",
    f"""
    SELECT *, forecast_intensity - prev_forecast_intensity AS forecast_change_from_prev
    FROM (SELECT id, data_from_dttm, data_to_dttm, forecast_intensity, actual_intensity,
                 lower(trim(index_forecast)) AS index_forecast,
                 lower(trim(index_actual)) AS index_actual,
                 valid_from_dttm AS forecast_made_at, valid_to_dttm AS forecast_valid_until,
                 {hours("valid_from_dttm", "data_from_dttm")} AS forecast_horizon_hours,
                 valid_to_dttm = {OPEN_END} AS is_current_version,
                 valid_to_dttm <> {OPEN_END} AS is_historical_version,
                 src_processed_dttm, processed_dttm,
                 row_number() OVER v AS version_number,
                 count(*) OVER (PARTITION BY data_from_dttm, data_to_dttm) AS total_versions,
                 lag(forecast_intensity) OVER v AS prev_forecast_intensity
          FROM raw
          WINDOW v AS (PARTITION BY data_from_dttm, data_to_dttm
                       ORDER BY valid_from_dttm, id))""",
)
table(
    "ods",
    "stg",
    f"""
    SELECT id AS source_id, {key("data_from_dttm", "data_to_dttm")} AS period_key,
           data_from_dttm, data_to_dttm,
           data_from_dttm::DATE AS data_date, year(data_from_dttm) AS data_year,
           month(data_from_dttm) AS data_month, day(data_from_dttm) AS data_day,
           hour(data_from_dttm) AS data_hour, dayname(data_from_dttm) AS data_day_of_week,
           isodow(data_from_dttm) AS data_day_of_week_num,
           {case("hour(data_from_dttm)", "<", PART_OF_DAY, "night")} AS time_of_day,
           if(isodow(data_from_dttm) > 5, 'weekend', 'weekday') AS day_type,
           period_duration_minutes, forecast_intensity, actual_intensity,
           forecast_error_gco2_kwh, forecast_error_percent,
           {case("forecast_intensity", ">=", LEVELS, "very_low")} AS forecast_intensity_category,
           if(actual_intensity IS NULL, NULL,
              {case("actual_intensity", ">=", LEVELS, "very_low")}) AS actual_intensity_category,
           index_forecast, index_forecast_numeric, index_actual, index_actual_numeric,
           data_status,
           actual_intensity IS NOT NULL
             AND coalesce(abs(forecast_error_percent) <= 10, FALSE) AS is_forecast_accurate,
           valid_from_dttm, processed_dttm AS source_processed_dttm
    FROM stg""",
)


def _per_level(template: str) -> str:
    return ", ".join(template.format(level=level) for level in CATEGORIES)


_DAY = (
    "data_date, data_year, data_month, data_day, data_day_of_week, "
    "data_day_of_week_num, day_type"
)
_MINUTES = _per_level(
    "count(*) FILTER (forecast_intensity_category = '{level}') AS forecast_{level}_count, "
    "sum(period_duration_minutes) FILTER (forecast_intensity_category = '{level}') "
    "AS forecast_{level}_minutes"
)
DAILY_BODY = f"""
    SELECT *, {share("accurate_forecasts_count", "periods_with_actual", 2)}
                AS forecast_accuracy_percent,
           {share("hours_with_data", "24", 2)} AS data_completeness_percent,
           {share("stddev_forecast_intensity", "avg_forecast_intensity", 2)}
                AS forecast_volatility_percent
    FROM (SELECT {_DAY}, count(*) AS total_periods, count(DISTINCT data_hour) AS hours_with_data,
                 min(forecast_intensity) AS min_forecast_intensity,
                 max(forecast_intensity) AS max_forecast_intensity,
                 avg(forecast_intensity) AS avg_forecast_intensity,
                 quantile_cont(forecast_intensity, 0.5) AS median_forecast_intensity,
                 stddev_samp(forecast_intensity) AS stddev_forecast_intensity,
                 count(actual_intensity) AS periods_with_actual,
                 min(actual_intensity) AS min_actual_intensity,
                 max(actual_intensity) AS max_actual_intensity,
                 avg(actual_intensity) AS avg_actual_intensity,
                 quantile_cont(actual_intensity, 0.5) AS median_actual_intensity,
                 avg(abs(forecast_error_gco2_kwh)) AS avg_absolute_error,
                 {exact_mean("forecast_error_percent")} AS avg_forecast_error_percent,
                 count(*) FILTER (is_forecast_accurate) AS accurate_forecasts_count,
                 {_MINUTES}
          FROM {{source}} GROUP BY ALL)"""
table("daily", "ods", DAILY_BODY.format(source="ods"))

FACT_BASE = f"""
    SELECT id AS source_id, {key("data_from_dttm", "data_to_dttm")} AS period_key,
           {key("id", "forecast_made_at")} AS fact_key, * EXCLUDE (id),
           {case("forecast_horizon_hours", "<", HORIZON_BANDS, HORIZON_BAND_REST)} AS band
    FROM {{source}}"""
table("fact0", "hist", FACT_BASE.format(source="hist"))
FACT_WINDOWS = f"""
    SELECT *,
           avg(forecast_intensity) OVER (s ROWS 2 PRECEDING) AS forecast_ma3,
           avg(forecast_intensity) OVER (s ROWS 11 PRECEDING) AS forecast_ma12,
           avg(forecast_intensity) OVER (s ROWS 47 PRECEDING) AS forecast_ma48,
           lag(forecast_intensity) OVER s AS before_it,
           rank() OVER (PARTITION BY data_from_dttm::DATE, is_current_version
                        ORDER BY forecast_intensity DESC NULLS FIRST) AS daily_intensity_rank,
           100 * percent_rank() OVER (PARTITION BY data_from_dttm::DATE, is_current_version
                        ORDER BY forecast_intensity NULLS LAST) AS daily_intensity_percentile,
           avg(abs(forecast_intensity - actual_intensity)) OVER (
               PARTITION BY band ORDER BY forecast_made_at, data_from_dttm, source_id
               ROWS 100 PRECEDING) AS avg_error_for_horizon,
           min(forecast_intensity) OVER k AS weekly_min_intensity,
           max(forecast_intensity) OVER k AS weekly_max_intensity
    FROM {{source}}
    WINDOW s AS (PARTITION BY is_current_version
                 ORDER BY data_from_dttm, forecast_made_at, source_id),
           k AS (PARTITION BY date_trunc('week', data_from_dttm), is_current_version)"""
table("fact1", "fact0", FACT_WINDOWS.format(source="fact0"))
FACT_FINAL = f"""
    SELECT * EXCLUDE (band, before_it),
           forecast_intensity - before_it AS forecast_change_from_prev_period,
           {share("forecast_intensity - before_it", "before_it", 2)}
             AS forecast_pct_change_from_prev_period,
           {trend("forecast_ma3", "forecast_ma12", TREND_WORDS)} AS short_term_trend,
           {share("weekly_max_intensity - weekly_min_intensity", "weekly_max_intensity", 2)}
             AS weekly_volatility_pct,
           (daily_intensity_percentile >= 95 OR daily_intensity_percentile <= 5) AS is_outlier,
           {case("forecast_horizon_hours", "<", HORIZON_CATEGORIES, HORIZON_CATEGORY_REST)}
             AS forecast_horizon_category
    FROM {{source}}"""
table("fact", "fact1", FACT_FINAL.format(source="fact1"))

ACCURACY_ROWS = f"""
    SELECT {key("period_key", "forecast_made_at")} AS accuracy_key, fact_key, period_key,
           data_from_dttm, data_to_dttm, forecast_made_at, data_from_dttm::DATE AS data_date,
           hour(data_from_dttm) AS data_hour, forecast_horizon_hours, forecast_horizon_category,
           forecast_intensity, actual_intensity, error, abs(error) AS absolute_error,
           pow(error, 2) AS squared_error, ape AS absolute_percentage_error,
           if(ape IS NULL, NULL, greatest(0, 100 - ape)) AS accuracy_percentage,
           {case("abs(error)", "<=", FORECAST_QUALITY)} AS forecast_quality,
           {case("sign(error)", "=", ((1, "overestimated"), (-1, "underestimated")), "exact")}
             AS error_direction,
           version_number, is_current_version
    FROM (SELECT *, forecast_intensity - actual_intensity AS error,
                 CASE WHEN actual_intensity > 0 THEN
                      abs(forecast_intensity - actual_intensity) * 100.0::DOUBLE
                      / actual_intensity END AS ape
          FROM {{source}} WHERE actual_intensity IS NOT NULL)"""
table("acc0", "fact", ACCURACY_ROWS.format(source="fact"))
ACCURACY_WINDOWS = """
    SELECT *, avg(absolute_error) OVER r AS rolling_24h_mae,
           sqrt(avg(squared_error) OVER r) AS rolling_24h_rmse,
           100 * avg(CASE WHEN absolute_percentage_error <= 10 THEN 1 ELSE 0 END) OVER r
             AS rolling_24h_accuracy_rate,
           avg(absolute_error) OVER (PARTITION BY date_trunc('week', data_from_dttm),
                                     forecast_horizon_category) AS weekly_avg_error,
           coalesce(absolute_error < lag(absolute_error) OVER (
               PARTITION BY forecast_horizon_category
               ORDER BY data_from_dttm, forecast_made_at, fact_key), FALSE) AS is_improving
    FROM {source}
    WINDOW r AS (PARTITION BY forecast_horizon_category
                 ORDER BY data_from_dttm, forecast_made_at, fact_key ROWS 47 PRECEDING)"""
table("acc", "acc0", ACCURACY_WINDOWS.format(source="acc0"))

table(
    "combined",
    "ods acc",
    f"""
    SELECT o.*, absolute_error, absolute_percentage_error, forecast_quality, error_direction,
           rolling_24h_mae, rolling_24h_rmse, rolling_24h_accuracy_rate,
           CASE WHEN o.forecast_intensity < 100 THEN 'green_energy'
                WHEN o.forecast_intensity <= 200 THEN 'moderate_impact'
                WHEN o.forecast_intensity > 300 THEN 'high_carbon'
                ELSE 'standard' END AS energy_cleanliness,
           o.forecast_intensity > 200 AND day_type = 'weekday'
             AND time_of_day IN ('morning', 'afternoon') AS is_peak_carbon_period,
           {one_of("forecast_intensity_category", RECOMMENDATIONS, NO_RECOMMENDATION)}
             AS consumption_recommendation
    FROM (SELECT * EXCLUDE (source_id, period_duration_minutes, index_forecast,
                            index_forecast_numeric, index_actual, index_actual_numeric,
                            valid_from_dttm, source_processed_dttm)
          FROM ods WHERE data_date >= {AS_OF_DAY} - 90) o
    LEFT JOIN (SELECT * FROM acc WHERE data_date >= {AS_OF_DAY} - 90) a
           ON a.period_key = o.period_key""",
)
table(
    "studied",
    "combined",
    """
    SELECT *, CASE WHEN spread > 0 THEN (forecast_intensity - mean) / spread ELSE 0.0 END AS z
    FROM (SELECT *, avg(forecast_intensity) OVER g AS mean,
                 stddev_samp(forecast_intensity) OVER g AS spread,
                 dense_rank() OVER (PARTITION BY data_hour, day_type
                                    ORDER BY forecast_intensity DESC NULLS FIRST) AS dense,
                 100 * percent_rank() OVER (PARTITION BY data_hour, day_type
                                    ORDER BY forecast_intensity NULLS LAST) AS pctl
          FROM combined WINDOW g AS (PARTITION BY data_hour, day_type))""",
)
table(
    "best",
    "combined",
    """
    SELECT min(m) AS lowest
    FROM (SELECT avg(forecast_intensity) AS m FROM combined GROUP BY data_hour)""",
)
table(
    "mart",
    "studied best",
    """
    SELECT period_key, data_from_dttm AS period_start, data_to_dttm AS period_end, data_date,
           data_year, data_month, data_day, data_hour, data_day_of_week, time_of_day, day_type,
           forecast_intensity AS forecast_co2_gco2_kwh, actual_intensity AS actual_co2_gco2_kwh,
           forecast_intensity_category AS forecast_category,
           actual_intensity_category AS actual_category,
           forecast_error_gco2_kwh AS forecast_error, forecast_error_percent,
           is_forecast_accurate, forecast_quality, error_direction,
           rolling_24h_mae AS rolling_mean_absolute_error,
           rolling_24h_rmse AS rolling_root_mean_squared_error,
           rolling_24h_accuracy_rate AS rolling_accuracy_rate_pct,
           energy_cleanliness AS energy_cleanliness_level, is_peak_carbon_period,
           consumption_recommendation, mean AS historical_avg_for_hour,
           z AS intensity_z_score, pctl AS intensity_percentile_same_hour,
           abs(z) > 2 AS is_statistical_anomaly,
           CASE WHEN pctl > 95 THEN 'unusually_high' WHEN pctl < 5 THEN 'unusually_low'
                ELSE 'normal' END AS intensity_anomaly_type,
           CASE WHEN mean > 0 THEN round((forecast_intensity - lowest) * 1.0::DOUBLE, 2) END
             AS potential_co2_saving_per_kwh,
           data_status
    FROM studied, best""",
)
_MEANS = _per_level(
    "count(*) FILTER (forecast_category = '{level}') AS periods_{level}, "
    "round(avg(forecast_co2_gco2_kwh) FILTER (forecast_category = '{level}'), 2) "
    "AS avg_intensity_{level}"
)
table(
    "recent",
    "mart",
    f"SELECT * FROM mart WHERE data_date >= {AS_OF_DAY} - 90",
)
table(
    "report0",
    "recent",
    f"""
    SELECT data_date, data_year, data_month, data_day, data_day_of_week, day_type,
           count(*) AS total_periods, count(DISTINCT data_hour) AS hours_with_data,
           min(forecast_co2_gco2_kwh) AS min_forecast, max(forecast_co2_gco2_kwh) AS max_forecast,
           avg(forecast_co2_gco2_kwh) AS avg_forecast,
           quantile_cont(forecast_co2_gco2_kwh, 0.5) AS median_forecast,
           stddev_samp(forecast_co2_gco2_kwh) AS stddev_forecast,
           min(actual_co2_gco2_kwh) AS min_actual, max(actual_co2_gco2_kwh) AS max_actual,
           avg(actual_co2_gco2_kwh) AS avg_actual,
           quantile_cont(actual_co2_gco2_kwh, 0.5) AS median_actual,
           avg(abs(forecast_error)) AS avg_absolute_error,
           {exact_mean("forecast_error_percent")} AS avg_error_percent,
           {exact_mean("rolling_accuracy_rate_pct", 6)} AS avg_accuracy_rate, {_MEANS}
    FROM recent GROUP BY ALL""",
)
_TEXT = f"data_hour || '{HOUR_MARK} (' || forecast_co2_gco2_kwh || ' {UNIT_TEXT})'"
table(
    "toptext",
    "recent",
    f"""
    SELECT data_date,
           string_agg({_TEXT}, ', ' ORDER BY hi) FILTER (hi <= 3) AS top_3_peak_hours,
           string_agg({_TEXT}, ', ' ORDER BY lo) FILTER (lo <= 3) AS top_3_best_hours
    FROM (SELECT *, row_number() OVER (PARTITION BY data_date
                      ORDER BY forecast_co2_gco2_kwh DESC NULLS FIRST, period_start) AS hi,
                 row_number() OVER (PARTITION BY data_date
                      ORDER BY forecast_co2_gco2_kwh NULLS LAST, period_start) AS lo
          FROM recent)
    GROUP BY data_date""",
)
table(
    "peaks",
    "recent",
    """
    SELECT data_date, avg(forecast_co2_gco2_kwh) FILTER (is_peak_carbon_period)
             AS avg_peak_intensity,
           count(*) FILTER (is_peak_carbon_period) AS peak_periods_count,
           count(*) FILTER (is_statistical_anomaly) AS anomaly_count
    FROM recent GROUP BY data_date""",
)
table(
    "compared",
    "report0",
    """
    SELECT *, avg_forecast - prev_day_avg AS day_over_day_change,
           avg_forecast - prev_week_same_day_avg AS week_over_week_change
    FROM (SELECT data_date, avg_forecast, lag(avg_forecast) OVER d AS prev_day_avg,
                 lag(avg_forecast, 7) OVER d AS prev_week_same_day_avg,
                 avg(avg_forecast) OVER (d ROWS 6 PRECEDING) AS ma7_forecast,
                 avg(avg_forecast) OVER (d ROWS 29 PRECEDING) AS ma30_forecast
          FROM report0 WINDOW d AS (ORDER BY data_date))""",
)
_SHARES = ", ".join(
    f"periods_{level}, {share(f'periods_{level}', 'total_periods', 1)} AS pct_{level}"
    for level in CATEGORIES
)
table(
    "report",
    "report0 toptext peaks compared",
    f"""
    SELECT data_date, data_year, data_month, data_day, data_day_of_week, day_type,
           strftime(data_date, '%d.%m.%Y') AS date_formatted,
           ((data_day + 6) // 7)::VARCHAR AS week_of_year,
           total_periods, hours_with_data,
           {share("hours_with_data", "24", 1)} AS data_completeness_pct,
           round(r.avg_forecast, 2) AS avg_daily_intensity,
           round(median_forecast, 2) AS median_daily_intensity,
           min_forecast AS min_daily_intensity, max_forecast AS max_daily_intensity,
           round(stddev_forecast, 2) AS intensity_volatility, {_SHARES},
           round(avg_absolute_error, 2) AS avg_forecast_error,
           round(avg_error_percent, 2) AS avg_forecast_error_pct,
           round(avg_accuracy_rate, 1) AS forecast_accuracy_rate,
           {case("avg_absolute_error", "<=", DAILY_QUALITY)} AS daily_forecast_quality,
           top_3_peak_hours, top_3_best_hours,
           round(avg_peak_intensity, 2) AS avg_peak_intensity,
           peak_periods_count, anomaly_count,
           round(prev_day_avg, 2) AS prev_day_avg,
           round(day_over_day_change, 2) AS day_over_day_change,
           round(prev_week_same_day_avg, 2) AS prev_week_avg,
           round(week_over_week_change, 2) AS week_over_week_change,
           round(ma7_forecast, 2) AS ma7_intensity, round(ma30_forecast, 2) AS ma30_intensity,
           {trend("r.avg_forecast", "ma7_forecast", DAILY_TREND_WORDS)} AS short_term_trend,
           {case("r.avg_forecast", "<", DAILY_ADVICE, DAILY_ADVICE_REST)} AS daily_recommendation
    FROM report0 r JOIN toptext USING (data_date) JOIN peaks USING (data_date)
         JOIN compared USING (data_date)""",
)


def needed(names) -> list[str]:
    """The named tables and all they read, in an order that defines before use."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out:
            return
        for parent in TABLES[name][0]:
            visit(parent)
        out.append(name)

    for name in names:
        visit(name)
    return out


def query(spec: str, reads: str, body: str) -> str:
    """SELECT the spec'd columns from `body`, which may read the named tables."""
    ctes = [f"{name} AS ({TABLES[name][1]})" for name in needed(reads.split())]
    head = "WITH " + ", ".join(ctes) + " " if ctes else ""
    return f"{head}SELECT {output(spec)} FROM ({body}) AS answer"


# ---- the state at the cut: what an earlier load had seen -------------------

CUT = "TIMESTAMP '2024-01-20'"
table("obs_old", "obs", f"SELECT * FROM obs WHERE created_at < {CUT}")
table("obs_new", "obs", f"SELECT * FROM obs WHERE created_at >= {CUT}")
table("changed_old", "obs_old", _CHANGED.format(source="obs_old"))
table("raw_old", "changed_old", _VERSIONS.format(source="changed_old"))


def earlier(name: str, base: str, body: str, now: bool = False) -> None:
    """The same layer over the earlier load: its source table renamed, its clock at the cut."""
    old = body.replace(f"FROM {base} ", f"FROM {base}_old ").replace(
        f"FROM {base}\n", f"FROM {base}_old\n"
    )
    if old.endswith(f"FROM {base}"):
        old += "_old"
    if now:
        old = old.replace(AS_OF, CUT)
    table(f"{name}_old", f"{base}_old", old)


earlier("stg_all", "raw", TABLES["stg_all"][1], now=True)
earlier("stg", "stg_all", TABLES["stg"][1])
earlier("hist", "raw", TABLES["hist"][1])
earlier("ods", "stg", TABLES["ods"][1])
table("daily_old", "ods_old", DAILY_BODY.format(source="ods_old"))
table("fact0_old", "hist_old", FACT_BASE.format(source="hist_old"))
table("fact1_old", "fact0_old", FACT_WINDOWS.format(source="fact0_old"))
table("fact_old", "fact1_old", FACT_FINAL.format(source="fact1_old"))
# new rows only, so their windows start over
table(
    "fact0_new",
    "fact0 hist_old",
    "SELECT * FROM fact0 WHERE processed_dttm > (SELECT max(processed_dttm) FROM hist_old)",
)
table("fact1_new", "fact0_new", FACT_WINDOWS.format(source="fact0_new"))
table("fact_new", "fact1_new", FACT_FINAL.format(source="fact1_new"))
table(
    "batch",
    "obs_new",
    """
    SELECT * FROM obs_new
    QUALIFY row_number() OVER (PARTITION BY data_from_dttm, data_to_dttm
        ORDER BY created_at DESC, forecast_intensity DESC NULLS LAST,
                 actual_intensity DESC NULLS LAST, index_forecast DESC) = 1""",
)
table("month", "mart", f"SELECT * FROM mart WHERE data_date >= {AS_OF_DAY} - 30")

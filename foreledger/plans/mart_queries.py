"""Queries that explore the mart: the last 30 days, all their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from foreledger.operators import explore
from foreledger.operators.topk import best_worst, n_largest, read_mart
from foreledger.operators.windows import moving_avg
from foreledger.plans.catalog import query
from foreledger.plans.marts import last_days

DAYS = 30
VALUE = explore.VALUE
READ_COLUMNS = (
    "period_start",
    "data_date",
    "data_hour",
    "time_of_day",
    "day_type",
    "data_day_of_week",
    "forecast_co2_gco2_kwh",
    "actual_co2_gco2_kwh",
    "forecast_category",
    "forecast_error",
    "forecast_error_percent",
    "is_forecast_accurate",
    "energy_cleanliness_level",
    "is_peak_carbon_period",
    "consumption_recommendation",
    "intensity_z_score",
    "is_statistical_anomaly",
    "intensity_anomaly_type",
)


def recent(run):
    return last_days(run.mart, "data_date", run.cfg.as_of, DAYS)


@query(
    "mart_read",
    """period_start data_date i:data_hour time_of_day day_type data_day_of_week
       i:forecast_co2_gco2_kwh i:actual_co2_gco2_kwh forecast_category i:forecast_error
       f:forecast_error_percent is_forecast_accurate energy_cleanliness_level
       is_peak_carbon_period consumption_recommendation f:intensity_z_score
       is_statistical_anomaly intensity_anomaly_type""",
)
def _(run):
    first = F.date_sub(F.lit(run.cfg.as_of.date()), DAYS)
    return read_mart(run.mart, first, READ_COLUMNS)


@query("anomaly_rows", "period_start i:forecast_co2_gco2_kwh intensity_anomaly_type f:z")
def _(run):
    return (
        recent(run)
        .filter("is_statistical_anomaly")
        .withColumn("z", F.col("intensity_z_score"))
    )


@query("n_largest", "period_start i:forecast_co2_gco2_kwh time_of_day")
def _(run):
    return n_largest(recent(run), VALUE, 5, [F.col("period_start").desc()])


@query("best_worst_hours", "i:data_hour f:mean_value i:best_rank i:worst_rank")
def _(run):
    return best_worst(recent(run), "data_hour", VALUE)


@query("rolling_mean_48", "period_start f:mean_24h")
def _(run):
    rows = recent(run).select("period_start", VALUE)
    return moving_avg(
        rows, VALUE, [], [F.col("period_start").asc()], {"mean_24h": 48}, run.cfg
    )


@query("describe", "statistic f:value")
def _(run):
    return explore.describe(recent(run), VALUE, run.cfg)


@query("value_counts", "column_name value i:n")
def _(run):
    return explore.value_counts(
        recent(run),
        [
            "forecast_category",
            "energy_cleanliness_level",
            "intensity_anomaly_type",
            "is_peak_carbon_period",
        ],
    )


@query("daily_band", "data_date f:mean i:low i:high")
def _(run):
    return explore.group_stats(
        recent(run),
        ["data_date"],
        [F.avg(VALUE).alias("mean"), F.min(VALUE).alias("low"), F.max(VALUE).alias("high")],
        run.cfg,
    )


@query("time_of_day_stats", "time_of_day f:mean f:std i:place best_time worst_time")
def _(run):
    return explore.time_of_day_stats(recent(run))


@query("day_type_stats", "day_type f:mean f:median")
def _(run):
    return explore.group_stats(
        recent(run), ["day_type"], [F.avg(VALUE).alias("mean")], run.cfg, {"median": VALUE}
    )


@query(
    "hour_dow_heatmap",
    "i:data_hour f:monday f:tuesday f:wednesday f:thursday f:friday f:saturday f:sunday",
)
def _(run):
    return explore.hour_dow_heatmap(recent(run))


@query("scatter_bounds", "i:pairs i:low i:high")
def _(run):
    return explore.pair_bounds(recent(run), VALUE, "actual_co2_gco2_kwh")


@query("error_histogram", "i:bin i:n f:bin_start f:bin_end")
def _(run):
    return explore.histogram(recent(run), "forecast_error")


@query("accuracy_summary", "i:rows_with_actual f:mae f:mape f:accuracy_rate")
def _(run):
    return explore.accuracy(recent(run))


@query("anomaly_summary", "intensity_anomaly_type i:n i:anomalies f:anomaly_share_pct")
def _(run):
    return explore.anomaly_summary(recent(run))


@query("anomaly_examples", "period_start i:forecast_co2_gco2_kwh intensity_anomaly_type")
def _(run):
    ties = [F.col(c) for c in ("period_start", VALUE, "intensity_anomaly_type")]
    return explore.anomaly_examples(recent(run), ties)


@query("shift_saving", "f:overall_mean f:best_hour_mean f:saving f:saving_pct")
def _(run):
    return explore.shift_saving(recent(run))


@query("insights", "metric f:value")
def _(run):
    return explore.insights(recent(run))

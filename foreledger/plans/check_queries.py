"""Queries over the data tests, the monitors, gaps and tumbling counts."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import functions as F

from foreledger.config import INDEX_NUMBERS
from foreledger.operators import audit, metrics, monitors, quality
from foreledger.operators.gaps import gap_islands, gaps
from foreledger.operators.joins import orphans
from foreledger.plans import data_tests
from foreledger.plans.build import Layers, Source, build_daily, build_ods
from foreledger.plans.catalog import query
from foreledger.plans.data_tests import ods_tests
from foreledger.plans.dwh import derived_fact_cols, with_series_windows
from foreledger.plans.load_queries import old_ods
from foreledger.plans.ods import ods_enrich
from foreledger.plans.staging import stg_current
from foreledger.session import materialize, shared_dir
from foreledger.sources import store
from foreledger.streaming.actuals import Reporting, with_actuals
from foreledger.streaming.windows import half_hour

JUDGED = "i:history_size f:history_mean f:history_stddev is_anomaly"


@query("relationships_check", "link i:child_key i:n")
def _(run):
    """Line items without an order, and current facts older periods do not know."""
    items = orphans(
        run.table("lineitem"), run.table("orders"), "l_orderkey", "o_orderkey", F.col("l_returnflag") == "N"
    )
    facts = orphans(
        run.fact_rows, old_ods(run), "period_key", "period_key", F.col("is_current_version")
    )
    return (
        items.select(F.lit("lineitem -> orders").alias("link"), F.col("l_orderkey").alias("k"))
        .unionByName(
            facts.select(F.lit("fact -> periods").alias("link"), F.col("source_id").alias("k"))
        )
        .groupBy("link", F.col("k").alias("child_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("dq_unique", "i:o_custkey i:n")
def _(run):
    return quality.unique(run.table("orders"), "o_custkey")


@query("dq_not_null", "column_name i:failures")
def _(run):
    return quality.not_null(run.ods, [c for c in run.ods.columns if c != "updated_at"])


@query("dq_accepted_values", "index_forecast i:n")
def _(run):
    return quality.accepted_values(run.raw, "index_forecast", list(INDEX_NUMBERS))


@query("dq_accepted_range", "i:source_id f:forecast_pct_change_from_prev_period")
def _(run):
    col = "forecast_pct_change_from_prev_period"
    rows = with_series_windows(run.fact_rows, run.cfg)
    return quality.accepted_range(rows, col, -100, 100, where=F.col(col).isNotNull())


@query("dq_time_range", "i:id data_from_dttm validation_error")
def _(run):
    return quality.time_range(
        run.raw, "data_from_dttm", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 31)
    )


@query(
    "dq_forecast_logic",
    """period_key data_from_dttm i:forecast_intensity i:actual_intensity i:absolute_error
       f:error_percent failure_reason""",
)
def _(run):
    """On values lowered by 50, so that zero values and errors above 100% occur."""
    lowered = run.raw.withColumns(
        {
            "forecast_intensity": F.col("forecast_intensity") - 50,
            "actual_intensity": F.floor((F.col("actual_intensity") - 50) / 2).cast("int"),
        }
    )
    return quality.forecast_logic(ods_enrich(stg_current(lowered, run.cfg), run.cfg))


@query("dq_source_freshness", "latest f:hours_old status is_stale")
def _(run):
    return quality.freshness(run.raw, "processed_dttm", run.cfg.as_of)


@query("dq_expression", "i:source_id i:forecast_error_gco2_kwh")
def _(run):
    return quality.expression(run.ods, "forecast_error_gco2_kwh BETWEEN -20 AND 20")


@query("dq_sequential", "i:l_orderkey i:l_linenumber i:previous")
def _(run):
    return quality.sequential(
        run.table("lineitem"), "l_linenumber", ["l_orderkey"], 1, run.cfg
    )


@query("dq_summary", "test column_name severity i:failures")
def _(run):
    """The declared tests of the period table."""
    return ods_tests(run.ods)


SUMMARY = "test column_name severity i:failures"


@query("dq_raw", SUMMARY)
def _(run):
    return data_tests.raw_tests(run.raw)


@query("dq_current", SUMMARY)
def _(run):
    return data_tests.current_tests(run.stg)


@query("dq_history", SUMMARY)
def _(run):
    return data_tests.history_tests(run.history)


@query("dq_daily", SUMMARY)
def _(run):
    return data_tests.daily_tests(run.daily)


@query("dq_fact", SUMMARY)
def _(run):
    return data_tests.fact_tests(materialize(run.fact, "fact"), run.ods)


@query("dq_accuracy", SUMMARY)
def _(run):
    return data_tests.accuracy_tests(materialize(run.accuracy, "accuracy"), run.fact_rows)


@query("dq_analytics", SUMMARY)
def _(run):
    return data_tests.analytics_tests(run.stored_mart)


@query("dq_report", SUMMARY)
def _(run):
    return data_tests.report_tests(run.report)


@query("dq_volume_anomaly", f"bucket i:row_count {JUDGED}")
def _(run):
    return monitors.volume_anomalies(run.events, "ts", run.cfg)


@query("dq_freshness_anomaly", f"bucket f:max_gap_minutes {JUDGED}")
def _(run):
    return monitors.freshness_anomalies(
        run.events.select("event_id", "ts"), "ts", run.cfg, [F.col("event_id").asc()]
    )


@query("dq_event_freshness", f"bucket f:max_delay_hours {JUDGED}")
def _(run):
    return monitors.event_freshness(run.raw, "data_from_dttm", "processed_dttm", run.cfg)


@query("dq_dimension_anomaly", f"forecast_horizon_category bucket i:row_count {JUDGED}")
def _(run):
    rows = run.fact_rows.withColumn(
        "forecast_horizon_category", derived_fact_cols()["forecast_horizon_category"]
    )
    return monitors.dimension_anomalies(
        rows, ["forecast_horizon_category"], "forecast_made_at", run.cfg
    )


@query("dq_column_anomaly", f"column_name metric bucket f:metric_value {JUDGED}")
def _(run):
    return monitors.column_anomalies(run.stg, ["forecast_intensity"], "data_from_dttm", run.cfg)


@query("dq_all_columns_anomaly", f"column_name metric bucket f:metric_value {JUDGED}")
def _(run):
    return monitors.all_columns_anomalies(
        run.stg.drop("updated_at"), "data_from_dttm", run.cfg
    )


# ---- monitors on stored metrics, tests inside writes, late actuals ----------


def _scratch(run, name: str) -> str:
    return f"{shared_dir(run.spark)}/{name}-{uuid.uuid4().hex}"


def stored_metrics(run, rows, ts: str, dims=(), ties=()):
    """States of a table that was published in two loads, brought up to date after each.

    The first load lacks the later half of the days and the evening of the others.
    """
    source, target = _scratch(run, "monitored"), _scratch(run, "metrics")
    dated = rows.withColumn("data_date", F.to_date(ts))
    early = dated.filter((F.hour(ts) < 18) & (F.dayofmonth(ts) <= 15))
    store.rebuild(early, source, "data_date")
    metrics.update(run.spark, source, target, ts, run.cfg, dims=dims, ties=ties)
    store.replace_partitions(dated, source, "data_date")
    metrics.update(run.spark, source, target, ts, run.cfg, dims=dims, ties=ties)
    return store.read(run.spark, target)


@query("metrics_columns", f"column_name metric bucket f:metric_value {JUDGED}")
def _(run):
    states = stored_metrics(run, run.stg.drop("updated_at"), "data_from_dttm")
    return metrics.column_anomalies(states, run.cfg)


@query("metrics_volume", f"bucket i:row_count {JUDGED}")
def _(run):
    states = stored_metrics(run, run.events.select("event_id", "ts"), "ts")
    return metrics.volume_anomalies(states, run.cfg)


@query("metrics_freshness", f"bucket f:max_gap_minutes {JUDGED}")
def _(run):
    states = stored_metrics(run, run.events.select("event_id", "ts"), "ts", ties=["event_id"])
    return metrics.freshness_anomalies(states, run.cfg)


@query("metrics_dimension", f"event_type bucket i:row_count {JUDGED}")
def _(run):
    rows = run.events.select("event_type", "event_id", "ts")
    states = stored_metrics(run, rows, "ts", dims=["event_type"])
    return metrics.volume_anomalies(states, run.cfg, ["event_type"])


@query(
    "metrics_weeks",
    "week event_type i:rows f:mean_value f:stddev_value f:min_value f:max_value f:longest_wait",
)
def _(run):
    """Weeks from the states of their days."""
    rows = run.events.select("event_type", "event_id", "ts", "value")
    states = stored_metrics(run, rows, "ts", dims=["event_type"], ties=["event_id"])
    week = states.withColumn("week", F.date_trunc("week", "bucket").cast("date"))
    merged = metrics.combined(week, ["week", "event_type"])
    keys = ["week", "event_type"]
    value = merged.filter("column_name = 'value'").select(
        *keys,
        F.col("n").alias("rows"),
        F.col("mean").alias("mean_value"),
        metrics.stddev().alias("stddev_value"),
        F.col("low").alias("min_value"),
        F.col("high").alias("max_value"),
    )
    waits = merged.filter(F.col("column_name") == metrics.ALL).select(*keys, "longest_wait")
    return value.join(waits, keys)


@query("dq_in_writes", "layer test column_name severity i:failures i:tested")
def _(run):
    """What the writes of the period and day tables found, from the table of results."""
    to = Layers(run.spark, _scratch(run, "audited"))
    cfg = dataclasses.replace(run.cfg, test_writes=True)
    build_ods(to, Source(run.spark, run.raw), cfg, True)
    build_daily(to, cfg, True)
    return audit.results(run.spark, to.path("test_results"))


@query(
    "late_actuals",
    "i:id data_from_dttm i:forecast_intensity i:actual_intensity reported_at",
)
def _(run):
    """Forecasts with the first actual reported from 12 hours before their period to a day after."""
    forecasts = run.log.select("id", "data_from_dttm", "data_to_dttm", "forecast_intensity")
    reports = run.log.withColumnRenamed("created_at", "reported_at")
    return with_actuals(forecasts, reports, Reporting("12 hours", "1 day"))


# ---- gaps and tumbling windows --------------------------------------------


@query("gap_check", "i:user_id ts prev_period f:gap_seconds")
def _(run):
    """Gaps are shown in seconds, which six places hold exactly."""
    rows = run.events.select("user_id", "ts", "event_id")
    found = gaps(rows, "ts", ["user_id"], 120, run.cfg, [F.col("event_id").asc()])
    return found.withColumn("gap_seconds", F.col("gap_minutes") * 60)


@query("gap_islands", "i:user_id i:island island_start island_end i:rows")
def _(run):
    rows = run.events.select("user_id", "ts", "event_id")
    return gap_islands(rows, ["user_id"], "ts", 120, run.cfg, [F.col("event_id").asc()])


@query("tumbling_half_hour", "window_start window_end i:n f:mean_value")
def _(run):
    return half_hour(run.events, "ts", "value")

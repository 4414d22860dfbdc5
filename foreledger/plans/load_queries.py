"""Queries over ingest and incremental loads.

The observation log is split at `CUT`: what came before is loaded, the rest is
the batch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from foreledger.functions.scalars import ntz
from foreledger.operators import asof, timeline
from foreledger.operators.explore import recent, stats
from foreledger.operators.incremental import (
    append,
    delete_insert,
    extract_since,
    lookback,
    merge_rows,
    since,
    upsert_counts,
    upsert_latest,
)
from foreledger.operators.joins import cross_scalar
from foreledger.operators.topk import latest
from foreledger.operators.versioning import (
    latest_per_key,
    load_stats,
    scd2_from_log,
    scd2_merge,
)
from foreledger.plans.catalog import query
from foreledger.plans.dwh import (
    accuracy_rows,
    derived_fact_cols,
    fact,
    fact_base,
    forecast_accuracy,
)
from foreledger.plans.layer_queries import LEVELS, PERIOD
from foreledger.plans.loads import compat, load_accuracy, load_fact
from foreledger.plans.ods import daily_summary, ods_enrich
from foreledger.plans.staging import stg_current, stg_history
from foreledger.sources.feed import flatten, parse_feed
from foreledger.sources.series import documents, responses

CUT = dt.datetime(2024, 1, 20)


def old_log(run):
    return run.log.filter(F.col("created_at") < ntz(CUT))


def new_log(run):
    return run.log.filter(F.col("created_at") >= ntz(CUT))


def old_raw(run):
    return scd2_from_log(old_log(run), run.cfg)


def old_cfg(run):
    """Settings of the earlier load: its clock stood at the cut."""
    return replace(run.cfg, as_of=CUT)


def old_ods(run):
    return ods_enrich(stg_current(old_raw(run), old_cfg(run)), old_cfg(run))


def old_daily(run):
    return daily_summary(old_ods(run), old_cfg(run))


# ---- ingest ----------------------------------------------------------------


@query("feed_parse", "i:response_id from_dttm to_dttm i:forecast i:actual index")
def _(run):
    good, _bad = parse_feed(responses(run.log), "body")
    return good.select(
        "response_id",
        F.col("from").alias("from_dttm"),
        F.col("to").alias("to_dttm"),
        "intensity.*",
    )


@query(
    "feed_flatten",
    f"""{PERIOD} i:forecast_intensity i:actual_intensity index_forecast index_actual
        src_processed_dttm""",
)
def _(run):
    return flatten(documents(run.log))


@query(
    "feed_upsert",
    """i:id from_dttm to_dttm created_at i:forecast i:actual index i:inserted i:modified
       i:saved""",
)
def _(run):
    """The batch arrives stamped with one load time; the last record of a key stays."""
    keys = ["from", "to"]
    stored = latest_per_key(documents(old_log(run)), keys, ["created_at", "id"])
    batch = latest_per_key(documents(new_log(run)), keys, ["created_at", "id"])
    stamped = append(batch, "created_at", run.cfg.as_of)
    counts = upsert_counts(stored, stamped, keys)
    merged = upsert_latest(stored, stamped, keys, ["created_at", "id"])
    return cross_scalar(merged, counts).select(
        "id",
        F.col("from").alias("from_dttm"),
        F.col("to").alias("to_dttm"),
        "created_at",
        "intensity.*",
        "inserted",
        "modified",
        "saved",
    )


@query("incremental_extract", "i:id created_at")
def _(run):
    return extract_since(documents(run.log), old_raw(run), "created_at", "src_processed_dttm")


@query("table_statistics", "i:total_records latest_record_time")
def _(run):
    return stats(documents(run.log), "created_at")


@query("recent_counts", "i:total_records i:recent_records")
def _(run):
    return recent(documents(run.log), "created_at", dt.datetime(2024, 1, 29))


@query("latest_records", "i:id from_dttm created_at")
def _(run):
    return latest(documents(run.log), "created_at", [F.col("id").desc()]).withColumn(
        "from_dttm", F.col("from")
    )


# ---- versions --------------------------------------------------------------


@query(
    "scd2_merge",
    f"""{PERIOD} i:forecast_intensity i:actual_intensity index_forecast index_actual
        valid_from_dttm t:valid_to_dttm src_processed_dttm processed_dttm""",
)
def _(run):
    return scd2_merge(old_raw(run), flatten(documents(new_log(run))), run.cfg.as_of)


@query(
    "scd2_late",
    f"""{PERIOD} i:forecast_intensity i:actual_intensity index_forecast index_actual
        valid_from_dttm t:valid_to_dttm src_processed_dttm processed_dttm""",
)
def _(run):
    """The earlier deliveries come once more, after the newer ones have overtaken them."""
    table = scd2_merge(old_raw(run), flatten(documents(new_log(run))), run.cfg.as_of)
    return scd2_merge(table, flatten(documents(old_log(run))), CUT)


@query(
    "scd2_any_order",
    f"""i:id {PERIOD} i:forecast_intensity i:actual_intensity index_forecast index_actual
        valid_from_dttm t:valid_to_dttm src_processed_dttm processed_dttm""",
)
def _(run):
    """The newest deliveries come first, then the oldest, those between, and the newest again."""
    first, last = dt.datetime(2024, 1, 10), CUT
    rows = run.log.withColumn("src_processed_dttm", F.col("created_at"))
    at = F.col("created_at")
    newest, oldest = rows.filter(at >= ntz(last)), rows.filter(at < ntz(first))
    between = rows.filter((at >= ntz(first)) & (at < ntz(last)))
    held = timeline.empty(run.raw)
    for batch in (newest, oldest, between, newest):
        held = timeline.insert(held, batch, run.cfg)
    return held.versions


@query(
    "forecast_at_lead",
    f"""{PERIOD} i:lead_hours forecast_made_at i:forecast_intensity i:actual_intensity i:error
        i:absolute_error""",
)
def _(run):
    return asof.at_lead(run.raw)


@query("lead_accuracy", "i:lead_hours i:periods i:with_actual f:mean_error f:mean_absolute_error")
def _(run):
    return asof.lead_accuracy(run.raw)


@query("load_stats", "i:extracted i:inserted i:reversioned i:loaded transfer_ok")
def _(run):
    return load_stats(old_raw(run), flatten(documents(new_log(run))))


# ---- incremental models ----------------------------------------------------


@query("ods_watermark", "i:id processed_dttm")
def _(run):
    return since(
        run.stg, old_ods(run), "processed_dttm", "updated_at", null_admits_all=False
    )


@query(
    "ods_delete_insert",
    "i:source_id period_key data_date i:forecast_intensity data_status source_processed_dttm",
)
def _(run):
    target = old_ods(run)
    batch = since(run.stg, target, "processed_dttm", "updated_at")
    return delete_insert(target, ods_enrich(batch, run.cfg), "period_key")


@query("daily_lookback", "i:source_id data_date")
def _(run):
    cfg = run.cfg
    return lookback(run.ods, old_daily(run), "data_date", cfg.lookback_days, cfg.start_date)


@query(
    "daily_merge",
    "data_date i:total_periods f:avg_forecast_intensity i:periods_with_actual "
    + " ".join(f"i:forecast_{level}_count" for level in LEVELS),
)
def _(run):
    cfg, target = run.cfg, old_daily(run)
    recent = lookback(run.ods, target, "data_date", cfg.lookback_days, cfg.start_date)
    return merge_rows(target, daily_summary(recent, cfg), "data_date")


@query("fact_watermark", "i:id processed_dttm")
def _(run):
    old = stg_history(old_raw(run), old_cfg(run))
    return since(run.history, old, "processed_dttm", "processed_dttm", run.cfg.start_date)


@query(
    "fact_append",
    """i:source_id is_current_version i:total_versions f:forecast_ma48 i:daily_intensity_rank
       f:avg_error_for_horizon short_term_trend""",
)
def _(run):
    """A plain append: windows of the new rows start over, old rows keep their flags."""
    target = fact(stg_history(old_raw(run), old_cfg(run)), old_cfg(run))
    return load_fact(target, run.history, compat(run.cfg))


@query("accuracy_watermark", "fact_key data_from_dttm")
def _(run):
    loaded = accuracy_rows(_categorised_old(run), old_cfg(run))
    done = run.fact_rows.filter("actual_intensity IS NOT NULL")
    return since(done, loaded, "data_from_dttm", "data_from_dttm", run.cfg.start_date)


@query(
    "accuracy_load",
    """fact_key period_key i:error i:absolute_error is_current_version
       f:rolling_24h_mae f:rolling_24h_rmse f:rolling_24h_accuracy_rate f:weekly_avg_error
       is_improving""",
)
def _(run):
    """Accuracy loaded on top of what the earlier facts gave: the rows of a full rebuild."""
    before = fact(stg_history(old_raw(run), old_cfg(run)), old_cfg(run))
    return load_accuracy(forecast_accuracy(before, old_cfg(run)), run.fact, run.cfg)


def _categorised_old(run):
    rows = fact_base(stg_history(old_raw(run), old_cfg(run)))
    return rows.withColumn(
        "forecast_horizon_category", derived_fact_cols()["forecast_horizon_category"]
    )

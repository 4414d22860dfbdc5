"""Incremental loads of the layers and the full rebuild."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.functions.scalars import horizon_band, ntz, truncate
from foreledger.operators.incremental import (
    delete_insert,
    lookback,
    merge_rows,
    not_loaded,
    since,
)
from foreledger.operators.joins import cross_scalar
from foreledger.operators.windows import settle
from foreledger.plans.dwh import (
    ACCURACY_ORDER,
    DAY_ROWS,
    HORIZON_FRAME,
    MADE_ORDER,
    MOVING,
    SERIES_ORDER,
    derived_fact_cols,
    fact,
    fact_base,
    forecast_accuracy,
    with_daily_ranks,
    with_horizon_error,
    with_series_windows,
    with_weekly_range,
)
from foreledger.plans.ods import daily_summary, ods_enrich


def load_ods(target: DataFrame, stg: DataFrame, cfg: Settings, compat: bool = False) -> DataFrame:
    """Delete + insert of the periods processed since the target was last updated.

    `compat` keeps the rule that an empty target admits nothing (K7).
    """
    batch = since(stg, target, "processed_dttm", "updated_at", null_admits_all=not compat)
    return delete_insert(target, ods_enrich(batch, cfg), "period_key")


def load_daily(target: DataFrame, ods: DataFrame, cfg: Settings) -> DataFrame:
    """Merge of the last days, recomputed so late actuals are taken in."""
    recent = lookback(ods, target, "data_date", cfg.lookback_days, cfg.start_date)
    return merge_rows(target, daily_summary(recent, cfg), "data_date")


def load_fact(target: DataFrame, history: DataFrame, cfg: Settings) -> DataFrame:
    """Target with the versions processed since its newest one.

    With `cfg.windows_restart_per_load` the new rows are appended with windows
    over themselves only and older rows stay as they were (K4, K5). Otherwise
    the result equals a full rebuild, but only weeks from the first touched one
    on are computed.
    """
    new = since(history, target, "processed_dttm", "processed_dttm", cfg.start_date)
    if cfg.windows_restart_per_load:
        return target.unionByName(fact(new, cfg))
    start = first_week(new)
    if start is None:
        return target
    kept = target.filter(F.col("data_from_dttm") < ntz(start))
    return kept.unionByName(facts_from(history, start, cfg))


def first_week(rows: DataFrame) -> dt.datetime | None:
    """Monday of the earliest period among `rows`: the one value fetched to steer a load.

    As a literal it prunes partitions and reaches the scan.
    """
    return rows.agg(truncate(F.min("data_from_dttm"), "week")).first()[0]


def _with_halo(rows: DataFrame, inside, keys, order, n: int) -> DataFrame:
    """Rows that are `inside` plus the last n rows of each key before them."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    earlier = (
        rows.filter(~inside)
        .withColumn("__back", F.row_number().over(window))
        .filter(F.col("__back") <= n)
        .drop("__back")
    )
    return rows.filter(inside).unionByName(earlier)


def facts_from(history: DataFrame, start: dt.datetime, cfg: Settings) -> DataFrame:
    """Facts of the periods from `start` (a Monday) on, as a full rebuild gives them.

    Day ranks and week ranges lie inside the weeks. The row frames need the last
    rows before `start`: per version kind for the moving averages, per horizon
    band, in order of making, for the horizon error.
    """
    rows = settle(fact_base(history), cfg.few_keys(), "fact-base")
    inside = F.col("data_from_dttm") >= ntz(start)
    wanted = rows.filter(inside)

    ranged = with_weekly_range(with_daily_ranks(wanted, cfg), cfg, source=wanted)

    series = _with_halo(
        rows, inside, ["is_current_version"], SERIES_ORDER, max(MOVING.values()) - 1
    )
    series = with_series_windows(series, cfg).filter(inside)

    made = cross_scalar(rows, wanted.agg(F.min("forecast_made_at").alias("__made")))
    late = F.col("forecast_made_at") >= F.col("__made")
    banded = made.withColumn("__h", horizon_band(F.col("forecast_horizon_hours")))
    horizon = _with_halo(banded, late, ["__h"], MADE_ORDER, HORIZON_FRAME)
    horizon = with_horizon_error(horizon, cfg).filter(inside)

    series_cols = [
        *MOVING,
        "forecast_change_from_prev_period",
        "forecast_pct_change_from_prev_period",
    ]
    joined = ranged.join(series.select("fact_key", *series_cols), "fact_key").join(
        horizon.select("fact_key", "avg_error_for_horizon"), "fact_key"
    )
    return joined.withColumns(derived_fact_cols()).withColumn("updated_at", ntz(cfg.as_of))


def load_accuracy(target: DataFrame, facts: DataFrame, cfg: Settings) -> DataFrame:
    """Target with the completed versions it lacks.

    With `cfg.windows_restart_per_load`: only periods after the newest loaded one
    (K6), windows over the new rows. Otherwise missing versions, and those that are
    no longer current, are found by key and the rolling metrics are those of a full rebuild.
    """
    if cfg.windows_restart_per_load:
        new = since(facts, target, "data_from_dttm", "data_from_dttm", cfg.start_date)
        return target.unionByName(forecast_accuracy(new, cfg))
    done = facts.filter("actual_intensity IS NOT NULL")
    # a version without an actual may have replaced one that is loaded as current
    start = first_week(not_loaded(done, target, "fact_key", "is_current_version"))
    if start is None:
        return target
    kept = target.filter(F.col("data_from_dttm") < ntz(start))
    return kept.unionByName(accuracy_from(done, start, cfg))


def accuracy_from(done: DataFrame, start: dt.datetime, cfg: Settings) -> DataFrame:
    """Accuracy of the completed versions from `start` on, with the rows before as context."""
    inside = F.col("data_from_dttm") >= ntz(start)
    keys = ["forecast_horizon_category"]
    context = _with_halo(done, inside, keys, ACCURACY_ORDER, DAY_ROWS)
    return forecast_accuracy(context, cfg).filter(inside)


def compat(cfg: Settings) -> Settings:
    """Settings under which appends behave like plain append loads."""
    return replace(cfg, windows_restart_per_load=True)

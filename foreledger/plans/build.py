"""Write all layers in order, wholly or incrementally."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.functions.scalars import horizon_band, ntz
from foreledger.operators.incremental import delete_insert, since_mark
from foreledger.operators.audit import Audit
from foreledger.plans import data_tests, pruned
from foreledger.plans.dwh import DAY_ROWS, HORIZON_FRAME, MOVING, fact, forecast_accuracy
from foreledger.plans.loads import accuracy_from, facts_from, first_week
from foreledger.plans.marts import analytics, daily_report
from foreledger.plans.ods import daily_summary, ods_enrich
from foreledger.plans.staging import history_rows, stg_current, stg_history
from foreledger.sources import store
from foreledger.sources.store import (
    Snapshot,
    exists,
    materialize_as,
    read_snapshot,
    rebuild,
    replace_partitions,
    touched_partitions,
)

BY = "data_date"
RESULTS = "test_results"
TESTED = {
    "ods_periods": data_tests.ods_rows,
    "ods_daily_summary": data_tests.daily_rows,
    "dwh_version_fact": data_tests.fact_rows,
    "dwh_forecast_accuracy": data_tests.accuracy_rows,
    "dm_analytics": data_tests.analytics_rows,
    "dm_daily_report": data_tests.report_rows,
}


@dataclass(frozen=True)
class Layers:
    """Where the layers of one warehouse lie."""

    spark: SparkSession
    out: str

    def path(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return store.read(self.spark, self.path(name))

    def has(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def audit(self, name: str, cfg: Settings) -> Audit | None:
        """The declared row tests of a layer, counted while it is written."""
        if not cfg.test_writes:
            return None
        return Audit(name, TESTED[name](), self.path(RESULTS), cfg.as_of)

    def state(self, name: str, version: int | None = None) -> Snapshot | None:
        return store.snapshot(self.spark, self.path(name), version)


@dataclass(frozen=True)
class Source:
    """Raw versions: a plain DataFrame, or a published table of which only parts are read."""

    spark: SparkSession
    rows: DataFrame
    path: str | None = None
    state: Snapshot | None = None

    @staticmethod
    def of(spark: SparkSession, raw: DataFrame | str) -> Source:
        if isinstance(raw, DataFrame):
            return Source(spark, raw)
        state = store.snapshot(spark, raw)
        if state is None or state.by != BY:
            raise ValueError(f"no table partitioned by {BY} at {raw}")
        return Source(spark, read_snapshot(spark, raw, state).drop(BY), raw, state)

    @property
    def version(self) -> int | None:
        return self.state.version if self.state else None

    def before(self, target: Snapshot | None) -> Snapshot | None:
        """The state of this source that `target` was built from, if it is still known."""
        known = target.source_version if target else None
        return store.snapshot(self.spark, self.path, known) if known and self.path else None

    def days(self, only: list[str]) -> DataFrame:
        return read_snapshot(self.spark, self.path, self.state, only).drop(BY)


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn(BY, F.to_date("data_from_dttm"))


def build_ods(to: Layers, raw: Source, cfg: Settings, full: bool) -> None:
    path = to.path("ods_periods")
    held = to.state("ods_periods")
    if full or held is None:
        rebuild(ods_enrich(stg_current(raw.rows, cfg), cfg), path, BY, raw.version, to.audit("ods_periods", cfg))
        return
    if raw.state and (older := raw.before(held)):
        # the partitions say what is new, also versions made before the last build
        new = stg_current(raw.days(raw.state.changed_since(older)), cfg)
    else:
        new = since_mark(stg_current(raw.rows, cfg), held.newest("updated_at"), "processed_dttm")
    batch = ods_enrich(new, cfg)
    part = touched_partitions(to.read("ods_periods"), batch, BY)
    columns = [c for c in batch.columns if c in part.columns]
    # a column the policy lets in is NULL in the rows that stay
    kept = delete_insert(part.select(*columns), batch.select(*columns), "period_key")
    if set(columns) != set(batch.columns):
        added = batch.select("period_key", *[c for c in batch.columns if c not in columns])
        kept = kept.join(added, "period_key", "left").select(*batch.columns)
    replace_partitions(
        kept, path, BY, cfg.schema_policy, raw.version, to.audit("ods_periods", cfg)
    )


def build_daily(to: Layers, cfg: Settings, full: bool) -> None:
    path, ods = to.path("ods_daily_summary"), to.read("ods_periods")
    held = to.state("ods_daily_summary")
    if full or held is None:
        rebuild(daily_summary(ods, cfg), path, BY, audit=to.audit("ods_daily_summary", cfg))
        return
    newest = held.newest(BY)
    first = newest - dt.timedelta(days=cfg.lookback_days) if newest else cfg.start_date.date()
    # the partition column is the merge key: a written day replaces the stored one
    recent = ods.filter(F.col(BY) >= F.lit(first))
    audit = to.audit("ods_daily_summary", cfg)
    replace_partitions(daily_summary(recent, cfg), path, BY, cfg.schema_policy, audit=audit)


def build_fact(to: Layers, raw: Source, cfg: Settings, full: bool) -> None:
    path = to.path("dwh_version_fact")
    held, audit = to.state("dwh_version_fact"), to.audit("dwh_version_fact", cfg)
    if full or held is None:
        rows = dated(fact(stg_history(raw.rows, cfg), cfg))
        rebuild(rows, path, BY, raw.version, audit)
        return
    if raw.state and (older := raw.before(held)):
        start = pruned.first_changed_week(raw.state, older)
        if start is None:
            return
        history = stg_history(raw.days(fact_days(raw, start, cfg)), cfg)
        start = dt.datetime.combine(start, dt.time())
    else:
        history = stg_history(raw.rows, cfg)
        mark = held.newest("processed_dttm")
        start = first_week(since_mark(history, mark, "processed_dttm", cfg.start_date))
        if start is None:
            return
    rows = dated(facts_from(history, start, cfg))
    replace_partitions(rows, path, BY, cfg.schema_policy, raw.version, audit)


def fact_days(raw: Source, start: dt.date, cfg: Settings) -> list[str]:
    """Partitions of the version table that the facts from `start` on are made of.

    The moving averages look back over periods, the horizon error over versions in
    the order they were made: a partition may be left out only if all its versions
    were made before those that fill the frames.
    """
    inside, before = pruned.split_days(raw.state, start)
    made = "valid_from_dttm"
    kind, band = F.col("is_current_version"), horizon_band(F.col("forecast_horizon_hours"))
    wanted = history_rows(raw.days(inside), cfg)
    kinds, bands = pruned.values_of(wanted, kind), pruned.values_of(wanted, band)
    oldest = pruned.oldest_in(raw.state, inside, made)

    def full(tried: list[str], left: list[str]) -> bool:
        latest = pruned.newest_in(raw.state, left, made)
        if oldest is None or latest is None or latest >= oldest:
            return False
        rows = history_rows(raw.days(tried), cfg)
        early = rows.filter(F.col("forecast_made_at") < ntz(oldest))
        return pruned.enough(rows, kind, kinds, max(MOVING.values()) - 1) and pruned.enough(
            early, band, bands, HORIZON_FRAME, latest, "forecast_made_at"
        )

    return inside + pruned.halo(before, full)


def build_accuracy(to: Layers, cfg: Settings, full: bool) -> None:
    path, done = to.path("dwh_forecast_accuracy"), F.col("actual_intensity").isNotNull()
    facts, held = to.state("dwh_version_fact"), to.state("dwh_forecast_accuracy")

    def read(days: list[str] | None = None) -> DataFrame:
        where = to.path("dwh_version_fact")
        return read_snapshot(to.spark, where, facts, days).drop(BY).filter(done)

    audit = to.audit("dwh_forecast_accuracy", cfg)
    if full or held is None:
        rebuild(forecast_accuracy(read(), cfg), path, BY, facts.version, audit)
        return
    older = to.state("dwh_version_fact", held.source_version) if held.source_version else None
    start = pruned.first_changed_week(facts, older)
    if start is None:
        return
    inside, before = pruned.split_days(facts, start)
    key = F.col("forecast_horizon_category")
    wanted = pruned.values_of(read(inside), key)
    context = pruned.halo(
        before, lambda tried, left: pruned.enough(read(tried), key, wanted, DAY_ROWS)
    )
    rows = accuracy_from(read(inside + context), dt.datetime.combine(start, dt.time()), cfg)
    replace_partitions(rows, path, BY, cfg.schema_policy, facts.version, audit)


def build_all(
    spark: SparkSession, raw: DataFrame | str, out: str, cfg: Settings, full_refresh: bool = False
) -> Layers:
    """Staging as views, stores and warehouse as partitioned tables, marts rewritten.

    Later layers read the written earlier ones, so each is computed once. An
    incremental run replaces only the partitions its rows fall into. Where `raw` is the
    path of a published version table (as the ingest keeps it), such a run also reads only
    the partitions that changed since the layer was built, and those its windows reach back to.

    The declared row tests run inside the writes (`operators.audit`); their results are
    appended to `test_results` beside the layers.
    """
    to = Layers(spark, out)
    source = Source.of(spark, raw)
    cfg = cfg.sized_by(source.rows)
    materialize_as(stg_current(source.rows, cfg), "stg_current", "view", "")
    materialize_as(stg_history(source.rows, cfg), "stg_history", "view", "")
    build_ods(to, source, cfg, full_refresh)
    build_daily(to, cfg, full_refresh)
    build_fact(to, source, cfg, full_refresh)
    build_accuracy(to, cfg, full_refresh)
    mart = analytics(to.read("ods_periods"), to.read("dwh_forecast_accuracy"), cfg)
    audit = to.audit("dm_analytics", cfg)
    materialize_as(mart, "dm_analytics", "table", to.path("dm_analytics"), BY, audit)
    report = daily_report(to.read("dm_analytics"), cfg)
    audit = to.audit("dm_daily_report", cfg)
    materialize_as(report, "dm_daily_report", "table", to.path("dm_daily_report"), audit=audit)
    return to

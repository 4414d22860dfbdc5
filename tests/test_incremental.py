"""Incremental loads equal a full rebuild, and the policies around them."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from foreledger.operators.incremental import (
    SchemaChanged,
    align_schema,
    append_new,
    extract_since,
    lookback,
    since,
)
from foreledger.operators.versioning import scd2_from_log
from foreledger.plans.build import build_all
from foreledger.plans.dwh import fact, forecast_accuracy
from foreledger.plans.loads import compat, load_accuracy, load_daily, load_fact, load_ods
from foreledger.plans.ods import daily_summary, ods_enrich
from foreledger.plans.run import Run
from foreledger.plans.staging import stg_current, stg_history
from tests.conftest import SMALL, sorted_rows

CUT = dt.datetime(2024, 1, 20)


class Split:
    def __init__(self, spark, cfg):
        run = Run(spark, SMALL, cfg)
        self.cfg, self.old_cfg = cfg, replace(cfg, as_of=CUT)
        self.new = run.raw.cache()
        past = run.log.filter(F.col("created_at") < F.lit(CUT))
        self.old = scd2_from_log(past, cfg).cache()

    def ods(self, raw, cfg):
        return ods_enrich(stg_current(raw, cfg), cfg)


@pytest.fixture(scope="module")
def split(spark):
    from foreledger.config import Settings

    return Split(spark, Settings(as_of=dt.datetime(2024, 2, 1)))


CLOCK = ("updated_at", "data_status")


def without_clock(df):
    return sorted_rows(df, [c for c in df.columns if c not in CLOCK and "valid" not in c])


@pytest.mark.parametrize("wide", [False, True])
def test_fact_load_equals_rebuild(split, wide):
    cfg = replace(split.cfg, wide=wide, bucket_rows=120)
    target = fact(stg_history(split.old, cfg), cfg)
    history = stg_history(split.new, cfg)
    assert without_clock(load_fact(target, history, cfg)) == without_clock(fact(history, cfg))


def test_fact_append_restarts_windows(split):
    cfg = compat(split.cfg)
    target = fact(stg_history(split.old, cfg), cfg)
    history = stg_history(split.new, cfg)
    loaded = load_fact(target, history, cfg)
    assert loaded.count() == history.count()
    assert without_clock(loaded) != without_clock(fact(history, cfg))


def test_accuracy_load_equals_rebuild(split):
    cfg = split.cfg
    old = fact(stg_history(split.old, cfg), cfg)
    new = fact(stg_history(split.new, cfg), cfg)
    loaded = load_accuracy(forecast_accuracy(old, cfg), new, cfg)
    assert without_clock(loaded) == without_clock(forecast_accuracy(new, cfg))


def test_accuracy_load_sees_a_version_replaced_by_one_without_actual(split):
    """Nothing is missing then, but the loaded version is no longer current."""
    cfg = split.cfg
    before = fact(stg_history(split.new, cfg), cfg).cache()
    done = before.filter("actual_intensity IS NOT NULL AND is_current_version")
    gone = done.agg(F.max("fact_key")).first()[0]
    current = F.col("is_current_version") & (F.col("fact_key") != gone)
    after = before.withColumn("is_current_version", current)
    loaded = load_accuracy(forecast_accuracy(before, cfg), after, cfg)
    assert without_clock(loaded) == without_clock(forecast_accuracy(after, cfg))
    assert not loaded.filter(F.col("fact_key") == gone).first().is_current_version


def test_ods_and_daily_loads_equal_rebuild(split):
    cfg = split.cfg
    target = split.ods(split.old, split.old_cfg)
    loaded = load_ods(target, stg_current(split.new, cfg), cfg)
    full = split.ods(split.new, cfg)
    assert without_clock(loaded) == without_clock(full)
    days = load_daily(daily_summary(target, split.old_cfg), full, cfg)
    # days older than the lookback keep what they were; late rows there are lost by design
    first = CUT.date() - dt.timedelta(days=5)
    fresh = daily_summary(full, cfg)
    recent = F.col("data_date") >= F.lit(first)
    assert without_clock(days.filter(recent)) == without_clock(fresh.filter(recent))


def test_empty_target(spark, split):
    cfg = split.cfg
    stg = stg_current(split.new, cfg)
    empty = split.ods(split.new, cfg).filter("false")
    assert load_ods(empty, stg, cfg).count() == stg.count()
    assert load_ods(empty, stg, cfg, compat=True).count() == 0
    assert extract_since(stg, empty, "processed_dttm", "updated_at").count() == stg.count()
    kept = since(stg, empty, "processed_dttm", "updated_at", default=dt.datetime(2024, 1, 10))
    assert 0 < kept.count() < stg.count()
    days = lookback(split.ods(split.new, cfg), empty, "data_date", 7, dt.datetime(2024, 1, 5))
    assert days.agg(F.min("data_date")).first()[0] == dt.date(2024, 1, 5)


def test_append_is_strictly_newer(spark):
    t = spark.createDataFrame([(1, CUT)], "id int, ts timestamp_ntz")
    b = spark.createDataFrame(
        [(2, CUT), (3, CUT + dt.timedelta(seconds=1))], "id int, ts timestamp_ntz"
    )
    assert sorted(r.id for r in append_new(t, b, "ts").collect()) == [1, 3]


def test_schema_policies(spark):
    target = spark.createDataFrame([(1, "a")], "id int, gone string")
    load = spark.createDataFrame([(2, 3.0)], "id int, added double")
    with pytest.raises(SchemaChanged):
        align_schema(load, target, "fail")
    new, old = align_schema(load, target, "sync_all_columns")
    assert sorted_rows(old.unionByName(new), ["id", "added"]) == [(None, 1), (3.0, 2)]


def test_build_all_incremental_equals_full(spark, split, tmp_path):
    """Two runs, the second on top of the first, against one run over everything."""
    step, full = str(tmp_path / "step"), str(tmp_path / "full")
    build_all(spark, split.old, step, split.old_cfg)
    steps = build_all(spark, split.new, step, split.cfg)
    whole = build_all(spark, split.new, full, split.cfg, full_refresh=True)
    for name in ("ods_periods", "dwh_version_fact", "dwh_forecast_accuracy"):
        assert without_clock(steps.read(name)) == without_clock(whole.read(name)), name
    # K14: a period's status is the one of its load, so the mart is compared without it
    mart = without_clock(steps.read("dm_analytics").drop("mart_updated_at"))
    assert mart == without_clock(whole.read("dm_analytics").drop("mart_updated_at"))
    assert steps.read("dm_daily_report").count() == whole.read("dm_daily_report").count()
    again = build_all(spark, split.new, step, split.cfg)
    assert without_clock(again.read("dwh_version_fact")) == without_clock(
        whole.read("dwh_version_fact")
    )

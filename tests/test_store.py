"""A table's state is published at once; watermarks and pruning come from its manifest."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from foreledger.operators.incremental import since_mark
from foreledger.plans import build, pruned
from foreledger.plans.run import Run
from foreledger.sources import store
from tests.conftest import SMALL, sorted_rows

T = dt.datetime
SCHEMA = "k int, at timestamp_ntz, day date"


def rows(spark, *values):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(k, T(2024, 1, d, 5), day + dt.timedelta(days=d - 1)) for k, d in values], SCHEMA
    )


def keys(spark, path):
    return sorted(r.k for r in store.read(spark, path).collect())


def test_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, (1, 1), (2, 2), (3, 2)), path, "day")
    first = store.snapshot(spark, path)
    state = store.replace_partitions(rows(spark, (4, 2), (5, 3)), path, "day")
    assert keys(spark, path) == [1, 4, 5]
    assert state.changed_since(first) == ["2024-01-02", "2024-01-03"]
    assert state.newest("at") == T(2024, 1, 3, 5) and state.newest("day") == dt.date(2024, 1, 3)
    assert state.parts["2024-01-02"].rows == 1
    # an older state stays readable until it is vacuumed
    assert sorted(r.k for r in store.read_snapshot(spark, path, first).collect()) == [1, 2, 3]
    assert store.vacuum(spark, path, keep=1) == 1
    assert keys(spark, path) == [1, 4, 5]


def test_a_load_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, (1, 1), (2, 2)), path, "day")
    store.replace_partitions(store.read(spark, path).withColumn("k", F.col("k") + 10), path, "day")
    assert keys(spark, path) == [11, 12]


def test_failed_load_leaves_the_old_state(spark, tmp_path):
    """One partition of two is written when the load fails; a reader never sees it."""
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, (1, 1), (2, 2)), path, "day")
    reader = store.read(spark, path)
    broken = rows(spark, (7, 1), (8, 2)).withColumn(
        "k", F.when(F.col("k") == 8, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("k"))
    )
    with pytest.raises(Exception, match="lost"):
        store.replace_partitions(broken, path, "day")
    assert keys(spark, path) == [1, 2] and sorted(r.k for r in reader.collect()) == [1, 2]
    with pytest.raises(Exception, match="lost"):
        store.rebuild(broken, path, "day")
    assert keys(spark, path) == [1, 2]
    store.replace_partitions(rows(spark, (7, 1)), path, "day")
    assert keys(spark, path) == [2, 7]


def test_second_of_two_loads_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, (1, 1)), path, "day")
    before = store.snapshot(spark, path)
    store.replace_partitions(rows(spark, (2, 1)), path, "day")
    monkeypatch.setattr(store, "snapshot", lambda *a: before)
    with pytest.raises(store.ConcurrentLoad):
        store.replace_partitions(rows(spark, (3, 1)), path, "day")
    monkeypatch.undo()
    assert keys(spark, path) == [2]


def test_empty_and_null_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark), path, "day")
    assert store.exists(spark, path) and keys(spark, path) == []
    assert store.snapshot(spark, path).newest("at") is None
    store.replace_partitions(rows(spark, (1, 1)).withColumn("day", F.lit(None).cast("date")), path, "day")
    assert [r.day for r in store.read(spark, path).collect()] == [None]
    plain = str(tmp_path / "plain")
    store.rebuild(rows(spark, (1, 1)), plain)
    store.rebuild(rows(spark, (2, 1)), plain)
    assert keys(spark, plain) == [2]


def test_schema_policy_of_a_load(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, (1, 1), (2, 2)).withColumn("gone", F.lit("x")), path, "day")
    load = rows(spark, (3, 2)).withColumn("added", F.lit(1.5))
    with pytest.raises(store.SchemaChanged):
        store.replace_partitions(load, path, "day")
    store.replace_partitions(load, path, "day", "sync_all_columns")
    got = store.read(spark, path)
    assert got.columns == ["k", "at", "day", "added"]
    assert sorted_rows(got, ["k", "added"]) == [(None, 1), (1.5, 3)]
    with pytest.raises(store.SchemaChanged):
        store.replace_partitions(load.withColumn("added", F.lit("t")), path, "day", "sync_all_columns")


def test_watermark_reads_no_data_of_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, (1, 1), (2, 3)), path, "day")
    batch = str(tmp_path / "batch")
    rows(spark, (5, 3), (6, 4)).write.parquet(batch)
    new = since_mark(spark.read.parquet(batch), store.snapshot(spark, path).newest("at"), "at")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 1 and "2024-01-03 05:00:00" in plan and "Join" not in plan
    assert [r.k for r in new.collect()] == [6]
    assert since_mark(new, None, "at", null_admits_all=False).count() == 0
    assert since_mark(new, None, "at").count() == 1


CLOCK = ("updated_at", "data_status", "mart_updated_at")


def unclocked(df):
    return sorted_rows(df, [c for c in df.columns if c not in CLOCK])


def test_pruned_build_equals_full(spark, cfg, tmp_path, monkeypatch):
    """Changed weeks and a halo are read, and give what a build over all versions gives."""
    run = Run(spark, SMALL, cfg)
    raw_path, step, full = (str(tmp_path / x) for x in ("raw", "step", "full"))
    raw = run.raw.withColumn("data_date", F.to_date("data_from_dttm")).cache()
    cut = T(2024, 1, 24)
    store.rebuild(raw.filter(F.col("data_from_dttm") < F.lit(cut)), raw_path, "data_date")
    build.build_all(spark, raw_path, step, replace(cfg, as_of=cut))
    late = raw.filter(F.col("data_from_dttm") >= F.lit(cut))
    store.replace_partitions(late, raw_path, "data_date")

    read, everything = [], store.read_snapshot

    def watched(spark, path, state, only=None):
        if only is not None:
            read.append((path, len(only), len(state.parts)))
        return everything(spark, path, state, only)

    monkeypatch.setattr(build, "read_snapshot", watched)
    monkeypatch.setattr(build.pruned, "FIRST_STEP", 1)
    steps = build.build_all(spark, raw_path, step, cfg)
    # the rare horizon bands of this small table need all of it for 100 rows, the other frames do not
    assert sum(some < whole for _, some, whole in read) > len(read) / 2
    whole = build.build_all(spark, run.raw, full, cfg, full_refresh=True)
    for name in ("ods_periods", "dwh_version_fact", "dwh_forecast_accuracy"):
        assert unclocked(steps.read(name)) == unclocked(whole.read(name)), name
    # nothing changed since: no layer is written again
    versions = [steps.state(n).version for n in ("dwh_version_fact", "dwh_forecast_accuracy")]
    build.build_all(spark, raw_path, step, cfg)
    assert versions == [steps.state(n).version for n in ("dwh_version_fact", "dwh_forecast_accuracy")]


def test_halo_doubles_until_the_frames_are_full():
    days, tried = [str(d) for d in range(100)], []

    def full(some, left):
        assert some + left == days
        tried.append(len(some))
        return len(some) >= 20

    assert pruned.halo(days, full) == days[:32] and tried == [8, 16, 32]
    assert pruned.halo(days[:5], full) == days[:5] and len(tried) == 3
    assert pruned.halo(days[:100], lambda some, left: False) == days


def test_newest_rows_read_newest_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(rows(spark, *[(d * 10 + i, d) for d in range(1, 6) for i in range(3)]), path, "day")
    state = store.snapshot(spark, path)
    assert store.newest_partitions(state, 4) == ["2024-01-05", "2024-01-04"]
    got = store.read_newest(spark, path, "at", 4)
    assert [r.day.day for r in got.collect()] == [5, 5, 5, 4]
    assert len(got.inputFiles()) <= 2 * 3
    assert len(store.newest_partitions(state, 99)) == 5
    assert store.read_newest(spark, path, "at", 99).count() == 15

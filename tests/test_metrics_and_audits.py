"""Monitors on stored metrics, data tests inside writes, late actuals and versions on streams."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from foreledger.operators import audit, metrics, monitors
from foreledger.operators.quality import null_check, range_check
from foreledger.operators.versioning import scd2_from_log
from foreledger.plans.run import Run
from foreledger.sources import store
from foreledger.streaming.actuals import Reporting, with_actuals
from foreledger.streaming.versions import use_rocksdb, versions_stream
from tests.conftest import SMALL, sorted_rows

DAY = "data_date"


def _events(spark, low=1, high=31):
    rows = Run(spark, SMALL).events.select("event_id", "user_id", "ts", "value", "event_type")
    return rows.withColumn(DAY, F.to_date("ts")).filter(F.dayofmonth("ts").between(low, high))


def _states(states):
    return sorted_rows(states.drop("distinct"))


def test_update_reads_changed_days_only_and_equals_a_full_run(spark, cfg, tmp_path):
    source, target, whole = (str(tmp_path / n) for n in ("source", "target", "whole"))
    store.rebuild(_events(spark, 1, 10), source, DAY)
    assert metrics.update(spark, source, target, "ts", cfg, ties=["event_id"]) is None
    assert metrics.update(spark, source, target, "ts", cfg, ties=["event_id"]) == []
    store.replace_partitions(_events(spark, 9, 12), source, DAY)
    days = metrics.update(spark, source, target, "ts", cfg, ties=["event_id"])
    assert days == ["2024-01-09", "2024-01-10", "2024-01-11", "2024-01-12"]
    metrics.update(spark, source, whole, "ts", cfg, ties=["event_id"])
    assert _states(store.read(spark, target)) == _states(store.read(spark, whole))


def test_a_day_that_is_gone_leaves_the_metrics(spark, cfg, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    store.rebuild(_events(spark, 1, 3), source, DAY)
    metrics.update(spark, source, target, "ts", cfg)
    store.rebuild(_events(spark, 2, 3), source, DAY)
    assert metrics.update(spark, source, target, "ts", cfg) is None
    assert store.read(spark, target).agg(F.min("bucket")).first()[0] == dt.date(2024, 1, 2)


def test_merged_halves_are_the_state_of_the_whole(spark, cfg):
    rows = _events(spark, 1, 4).drop(DAY)
    key = ["bucket"]
    noon = F.hour("ts") < 12
    halves = metrics.day_states(rows.filter(noon), "ts", cfg, ties=["event_id"]).unionByName(
        metrics.day_states(rows.filter(~noon), "ts", cfg, ties=["event_id"])
    )
    merged = metrics.combined(halves, key)
    whole = metrics.day_states(rows, "ts", cfg, ties=["event_id"])
    assert _states(merged) == _states(whole)
    exact = rows.groupBy(F.to_date("ts").alias("bucket")).agg(F.countDistinct("user_id").alias("n"))
    found = metrics.distinct_counts(merged).filter("column_name = 'user_id'").join(exact, "bucket")
    assert all(abs(r.distinct_values - r.n) <= 0.1 * r.n for r in found.collect())


def test_states_of_odd_rows(spark, cfg):
    schema = "ts timestamp_ntz, `a.b` double, s string, nothing int"
    at = dt.datetime(2024, 1, 1, 5)
    rows = spark.createDataFrame(
        [(at, 1.0, "xy", None), (at, None, None, None), (None, 5.0, "", None)], schema
    )
    by = {(r.bucket, r.column_name): r for r in metrics.day_states(rows, "ts", cfg).collect()}
    assert by[at.date(), "a.b"].n == 2 and by[at.date(), "a.b"].filled == 1
    assert by[at.date(), "s"].mean == 2.0 and by[None, "s"].mean == 0.0
    assert by[at.date(), "nothing"].filled == 0 and by[at.date(), "nothing"].mean is None
    assert by[at.date(), "*"].longest_wait == 0 and by[None, "*"].n == 1
    none = metrics.day_states(rows.limit(0), "ts", cfg)
    assert none.count() == 0
    assert monitors.judge(metrics.metric_rows(none), ["column_name"], "metric_value", cfg).count() == 0


def _audit(tmp_path, severity, at=1):
    fails = range_check("v", 0, 10)
    checks = [null_check("v"), type(fails)(fails.test, fails.column, fails.fails, severity)]
    return audit.Audit("t", checks, str(tmp_path / "results"), dt.datetime(2024, 1, at))


def _days(spark, *values):
    rows = [(dt.date(2024, 1, 1 + i % 3), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "d date, v int").repartition(5)


def test_a_write_counts_its_tests(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(_days(spark, *range(100), None), path, "d", audit=_audit(tmp_path, "warn"))
    found = {r.test: r for r in audit.results(spark, str(tmp_path / "results")).collect()}
    assert found["not_null"].failures == 1 and found["accepted_range"].failures == 89
    assert found["not_null"].tested == 101 and found["not_null"].published
    assert store.read(spark, path).count() == 101


def test_a_failing_error_test_keeps_the_state_before(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(_days(spark, 1, 2, 3), path, "d", audit=_audit(tmp_path, "error"))
    with pytest.raises(audit.TestsFailed, match=r"accepted_range\(v\): 1"):
        store.replace_partitions(
            _days(spark, 11, 2, 3, 4), path, "d", audit=_audit(tmp_path, "error", 2)
        )
    assert sorted(r.v for r in store.read(spark, path).collect()) == [1, 2, 3]
    kept = audit.results(spark, str(tmp_path / "results"))
    assert kept.filter("NOT published").count() == 2
    fresh = audit.newly_failing(kept).collect()
    assert [(r.test, r.failures) for r in fresh] == [("accepted_range", 1)]


def test_a_write_of_no_rows_is_tested(spark, tmp_path):
    store.rebuild(_days(spark, 1).limit(0), str(tmp_path / "t"), "d", audit=_audit(tmp_path, "error"))
    found = audit.results(spark, str(tmp_path / "results")).collect()
    assert [r.failures for r in found] == [0, 0] and found[0].tested == 0


def _start(df, name, checkpoint):
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert query.exception() is None


def _streamed(spark, rows, order, path, far):
    """`rows` as a stream of files in `order`, then a row that moves the watermark past all."""
    ordered = rows.withColumn("__n", F.ntile(3).over(Window.orderBy(order)))
    for n in (1, 2, 3):
        ordered.filter(F.col("__n") == n).drop("__n").coalesce(1).write.mode("append").parquet(path)
    far.select(*rows.columns).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _far(rows, *times):
    late = F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")
    return rows.limit(1).withColumns({t: late for t in times})


def test_late_actuals_on_a_stream(spark, tmp_path):
    log = Run(spark, SMALL).log
    forecasts = log.select("id", "data_from_dttm", "data_to_dttm", "forecast_intensity")
    reports = log.withColumnRenamed("created_at", "reported_at").filter("actual_intensity IS NOT NULL")
    # one report per period, so that the first to arrive is the first reported
    reports = reports.orderBy("reported_at").dropDuplicates(["data_from_dttm"])
    rule = Reporting("12 hours", "1 day", "40 days")
    left = _streamed(
        spark, forecasts, F.col("id"), str(tmp_path / "f"), _far(forecasts, "data_from_dttm", "data_to_dttm")
    )
    right = _streamed(
        spark, reports, F.col("reported_at"), str(tmp_path / "r"),
        _far(reports, "data_from_dttm", "data_to_dttm", "reported_at"),
    )
    _start(with_actuals(left, right, rule), "late_actuals", tmp_path / "cp")
    got = spark.table("late_actuals").filter("data_from_dttm < '2029-01-01'")
    want = with_actuals(forecasts, spark.read.parquet(str(tmp_path / "r")), rule)
    assert sorted_rows(got) == sorted_rows(want)
    assert want.filter("reported_at IS NULL").count() and want.filter("reported_at IS NOT NULL").count()


def test_versions_in_state(spark, cfg, tmp_path):
    """Deliveries in the wrong order and repeated give the versions of the whole log."""
    log = Run(spark, SMALL).log.filter("data_from_dttm < '2024-01-06'")
    twice = log.unionByName(log.filter("id % 5 = 0"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    try:
        stream = _streamed(
            spark, twice, F.col("id") * 37 % 101, str(tmp_path / "log"),
            _far(log, "created_at", "data_from_dttm", "data_to_dttm"),
        )
        _start(versions_stream(stream, 24 * 40, "60 days"), "state_versions", tmp_path / "cp")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = spark.table("state_versions")
    assert sorted_rows(got) == sorted_rows(scd2_from_log(log, cfg))

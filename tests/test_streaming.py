"""Streams give what the batch operators give."""

import datetime as dt

from pyspark.sql import functions as F

from foreledger.operators.incremental import upsert_latest
from foreledger.operators.versioning import KEYS, TRACKED, latest_per_key, scd2_from_log
from foreledger.plans.run import Run
from foreledger.sources.feed import flatten, parse_feed
from foreledger.sources.series import responses
from foreledger.sources.store import read
from foreledger.streaming.ingest import (
    first_seen,
    landed,
    start_ingest,
)
from foreledger.streaming.windows import half_hour, stream_islands
from tests.conftest import SMALL, sorted_rows

ONCE = {"availableNow": True}


def test_ingest_equals_batch(spark, cfg, tmp_path):
    run = Run(spark, SMALL, cfg)
    halves = []
    body = responses(run.log.filter("id < 600")).drop("response_id")
    broken = spark.createDataFrame([('{"data":[{"from":"2024-01-01T00:00Z"}]}',)], "body string")
    stamps = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
    for n, at in enumerate(stamps):
        part = body if n == 0 else responses(run.log.filter("id >= 400")).drop("response_id")
        part = part.unionByName(broken)
        halves.append(part.withColumn("created_at", F.lit(at).cast("timestamp_ntz")))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in halves:
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(halves[0].schema).parquet(source)
        query = start_ingest(stream, out, str(tmp_path / "cp"), cfg, ONCE)
        query.awaitTermination()
        assert query.exception() is None

    keys, order = ["from", "to"], ["created_at", "intensity"]
    seen = None
    docs = None
    for part, at in zip(halves, stamps):
        good, _ = parse_feed(part, "body")
        good = latest_per_key(
            good.select("from", "to", "created_at", "intensity"), keys, order
        )
        seen = good if seen is None else seen.unionByName(good)
        docs = good if docs is None else upsert_latest(docs, good, keys, order)
    log = flatten(seen).withColumn("created_at", F.col("src_processed_dttm"))
    log = log.withColumn("id", F.xxhash64(*KEYS, *TRACKED, "src_processed_dttm"))
    clock = ["data_date", "processed_dttm"]
    stored = read(spark, f"{out}/raw_versions")
    assert sorted_rows(stored.drop(*clock)) == sorted_rows(scd2_from_log(log, cfg).drop(*clock))
    assert sorted_rows(read(spark, f"{out}/documents").drop("data_date")) == sorted_rows(docs)
    days = read(spark, f"{out}/days")
    assert days.agg(F.sum("total_periods")).first()[0] == docs.count()
    assert read(spark, f"{out}/bad_records").count() == 2


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data":[]}\n')
    query = (
        landed(spark, str(tmp_path))
        .writeStream.format("memory")
        .queryName("landed_files")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    row = spark.table("landed_files").first()
    assert row.body == '{"data":[]}' and row.created_at is not None


def _events(spark, tmp_path, name):
    """Events as a stream, and one far later row that moves the watermark past all others."""
    rows = Run(spark, SMALL).events.select("user_id", "ts", "value")
    late = rows.limit(1).withColumn("ts", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
    path = str(tmp_path / name)
    rows.coalesce(1).write.parquet(path)
    late.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return rows, stream


def _run(df, name):
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.sparkSession.table(name) if hasattr(query, "sparkSession") else None


def test_half_hour_stream(spark, tmp_path):
    rows, stream = _events(spark, tmp_path, "half")
    _run(half_hour(stream, "ts", "value", "40 days"), "half_hours")
    got = spark.table("half_hours").filter("window_start < '2029-01-01'")
    assert sorted_rows(got) == sorted_rows(half_hour(rows, "ts", "value"))


def test_islands_stream(spark, cfg, tmp_path):
    from foreledger.operators.gaps import gap_islands

    rows, stream = _events(spark, tmp_path, "islands")
    _run(stream_islands(stream, ["user_id"], "ts", 120, "40 days"), "islands")
    got = spark.table("islands").filter("island_start < '2029-01-01'")
    want = gap_islands(rows, ["user_id"], "ts", 120, cfg).drop("island")
    assert sorted_rows(got) == sorted_rows(want)


def test_first_seen_drops_repeats(spark, tmp_path):
    schema = "`from` timestamp_ntz, `to` timestamp_ntz, created_at timestamp_ntz, intensity int"
    at = dt.datetime(2024, 1, 1)
    rows = [(at, at, at, 1), (at, at, at + dt.timedelta(minutes=5), 1), (at, at, at, 2)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    _run(first_seen(stream, "1 hour"), "first_seen")
    assert spark.table("first_seen").count() == 2

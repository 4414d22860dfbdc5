"""Landed feed files into the document store, the version table and the day table.

Each micro-batch runs the batch operators inside `foreachBatch`. A replayed
batch changes nothing: the upsert is keyed and stamped, and a version opens only
when values differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foreledger.config import Settings
from foreledger.functions.scalars import ntz
from foreledger.operators import timeline
from foreledger.operators.incremental import upsert_latest
from foreledger.operators.versioning import RAW_COLUMNS, latest_per_key
from foreledger.plans.ods import daily_summary, ods_enrich
from foreledger.plans.staging import stg_current
from foreledger.session import prepare
from foreledger.sources.feed import flatten, parse_feed, require_some
from foreledger.sources.store import (
    exists,
    read,
    rebuild,
    replace_partitions,
    touched_partitions,
)

BY = "data_date"
DOC_KEYS = ("from", "to")
POLL = {"processingTime": "1800 seconds"}


def landed(spark: SparkSession, in_dir: str) -> DataFrame:
    """A stream of response files: one JSON document per line, stamped by its file's time."""
    lines = prepare(spark).readStream.format("text").load(in_dir)
    stamp = ntz(F.col("_metadata.file_modification_time"))
    return lines.select(F.col("value").alias("body"), stamp.alias("created_at"))


def first_seen(docs: DataFrame, delay: str) -> DataFrame:
    """Drop repeated deliveries of one version of a record within a bounded delay."""
    instant = docs.withColumn("__at", F.col("created_at").cast("timestamp"))
    return (
        instant.withWatermark("__at", delay)
        .dropDuplicatesWithinWatermark([*DOC_KEYS, "intensity"])
        .drop("__at")
    )


@dataclass(frozen=True)
class Ingest:
    """The tables of one ingest and what a micro-batch does to them."""

    spark: SparkSession
    out: str
    cfg: Settings
    require_good: bool = True

    def path(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"

    def _put(self, df: DataFrame, name: str, by: str = BY) -> None:
        write = replace_partitions if exists(self.spark, self.path(name)) else rebuild
        write(df, self.path(name), by)

    def _touched(self, name: str, batch: DataFrame) -> DataFrame | None:
        if not exists(self.spark, self.path(name)):
            return None
        return touched_partitions(read(self.spark, self.path(name)), batch, BY)

    def records(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(good records, bad records) of the batch's responses."""
        good, bad = parse_feed(batch, "body")
        docs = good.select(*DOC_KEYS, "created_at", "intensity")
        return docs.withColumn(BY, F.to_date("from")), bad

    def upsert_batch(self, docs: DataFrame) -> None:
        """The latest record of each period stays."""
        docs = latest_per_key(docs, DOC_KEYS, ["created_at", "intensity"])
        stored = self._touched("documents", docs)
        if stored is not None:
            docs = upsert_latest(
                stored.select(*docs.columns), docs, DOC_KEYS, ["created_at", "intensity"]
            )
        self._put(docs, "documents")

    def scd2_batch(self, docs: DataFrame) -> None:
        """Every record finds its place in the versions, also one that comes late."""
        rows = flatten(docs)
        now = rows.agg(F.max("src_processed_dttm")).first()[0]
        held = timeline.empty(self.spark.createDataFrame([], RAW_SCHEMA))
        stored, confirmed = (self._touched(t, docs) for t in ("raw_versions", "raw_confirmed"))
        if stored is not None:
            held = timeline.Timeline(stored.drop(BY), held.confirmed if confirmed is None else confirmed.drop(BY))
        merged = timeline.insert(held, rows, self.cfg, now, one_per_stamp=True)
        day = F.to_date("data_from_dttm")
        self._put(merged.versions.withColumn(BY, day), "raw_versions")
        self._put(merged.confirmed.withColumn(BY, day), "raw_confirmed")

    def recompute_days(self, docs: DataFrame) -> None:
        """Day rows of the touched days; late actuals of past days come in that way."""
        raw = self._touched("raw_versions", docs).select(*RAW_COLUMNS)
        self._put(daily_summary(ods_enrich(stg_current(raw, self.cfg), self.cfg), self.cfg), "days")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            docs, bad = self.records(batch)
            if not bad.isEmpty():
                # by batch, so a replay writes the same partition again
                numbered = bad.withColumn("batch_id", F.lit(batch_id))
                self._put(numbered, "bad_records", "batch_id")
            if batch.isEmpty():
                return
            if docs.isEmpty():
                # a poll that brings responses but no usable record is an error, not an empty load
                if self.require_good:
                    require_some(docs)
                return
            self.upsert_batch(docs)
            self.scd2_batch(docs)
            self.recompute_days(docs)
        finally:
            batch.unpersist()


RAW_SCHEMA = """id bigint, data_from_dttm timestamp_ntz, data_to_dttm timestamp_ntz,
    forecast_intensity int, actual_intensity int, index_forecast string, index_actual string,
    valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz,
    src_processed_dttm timestamp_ntz, processed_dttm timestamp_ntz"""


def start_ingest(
    stream: DataFrame, out: str, checkpoint: str, cfg: Settings, trigger: dict | None = None
) -> StreamingQuery:
    """Run the ingest over a stream of (body, created_at); polls every 30 minutes by default."""
    job = Ingest(stream.sparkSession, out, cfg)
    return (
        stream.writeStream.foreachBatch(job)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or POLL))
        .start()
    )

"""Versions that take deliveries in any order: late rows get their place in history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.functions.scalars import ntz
from foreledger.operators.versioning import (
    KEYS,
    RAW_COLUMNS,
    TRACKED,
    latest_per_key,
    versions_of,
    with_opens,
)
from foreledger.session import materialize

STAMP = "src_processed_dttm"
CONFIRMED = ("id", *KEYS, *TRACKED, STAMP)


@dataclass(frozen=True)
class Timeline:
    """Versions, and the observations that confirmed one of them.

    Both together hold every observation once, which is what a late row needs: it may
    split a version into two, end one earlier, or make two neighbours equal.
    """

    versions: DataFrame
    confirmed: DataFrame


def insert(
    held: Timeline,
    batch: DataFrame,
    cfg: Settings,
    now: dt.datetime | None = None,
    keys: Sequence[str] = KEYS,
    tracked: Sequence[str] = TRACKED,
    one_per_stamp: bool = False,
) -> Timeline:
    """The timeline with the rows of `batch` (keys, tracked columns, src_processed_dttm, maybe id).

    Only keys of the batch are worked on, all others pass through; give a partitioned
    table's touched partitions as `held`. Whatever the order and the split of the same
    deliveries, the versions are those of `scd2_from_log` over all of them, and a row
    that comes again changes nothing. Without an id a row gets one from its content.
    With `one_per_stamp` only the greatest of a key's rows of one moment counts.

    `now` stamps the versions that this load opens, ends or moves (processed_dttm), so
    watermarks behind the table see them; without it they carry their own start.
    """
    if "id" not in batch.columns:
        batch = batch.withColumn("id", F.xxhash64(*keys, *tracked, STAMP))
    batch = materialize(batch.select(*CONFIRMED), "deliveries")
    touched = batch.select(*keys).distinct()
    known = held.versions.select(*CONFIRMED).unionByName(held.confirmed.select(*CONFIRMED))
    every = known.join(touched, list(keys), "left_semi").unionByName(batch).distinct()
    if one_per_stamp:
        every = latest_per_key(every, [*keys, STAMP], [*tracked, "id"])
    marked = materialize(with_opens(every, cfg, keys, tracked, STAMP), "timeline")

    opening = marked.filter("opens").drop("opens").withColumn("created_at", F.col(STAMP))
    versions = versions_of(opening, cfg, keys)
    if now is not None:
        same = ["id", *keys, "valid_from_dttm", "valid_to_dttm"]
        before = held.versions.select(*same, F.col("processed_dttm").alias("__before"))
        loaded = F.coalesce("__before", ntz(now)).alias("processed_dttm")
        versions = versions.join(before, same, "left").select(
            *[c for c in RAW_COLUMNS if c != "processed_dttm"], loaded
        )
    rest = list(keys)
    return Timeline(
        held.versions.join(touched, rest, "left_anti").select(*RAW_COLUMNS).unionByName(
            versions.select(*RAW_COLUMNS)
        ),
        held.confirmed.join(touched, rest, "left_anti").select(*CONFIRMED).unionByName(
            marked.filter("NOT opens").select(*CONFIRMED)
        ),
    )


def empty(like: DataFrame) -> Timeline:
    """A timeline without rows, with the column types of a version table."""
    none = like.filter("false")
    return Timeline(none.select(*RAW_COLUMNS), none.select(*CONFIRMED))

"""Incremental loads: watermarks and the ways a batch enters its target.

The watermark functions filter a batch by one aggregate of the target, joined as
a broadcast row (a global aggregate is one row by construction). The load
functions return the whole new target as a plan; `sources.store` writes only
the partitions such a plan touches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.functions.scalars import ntz
from foreledger.operators.joins import cross_scalar
from foreledger.operators.versioning import latest_per_key
from foreledger.sources.store import SchemaChanged


# ---- document store --------------------------------------------------------


def append(df: DataFrame, ts_col: str, at: dt.datetime) -> DataFrame:
    """Stamp new documents with their load time."""
    return df.withColumn(ts_col, ntz(at))


def upsert_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One whole row per key: the latest by `order` (batch rows carry later stamps)."""
    return latest_per_key(target.unionByName(batch), keys, order)


def upsert_counts(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys inserted, keys modified, and their sum."""
    known = target.select(*keys, F.lit(True).alias("__known")).distinct()
    new = batch.select(*keys).distinct().join(known, list(keys), "left")
    return new.agg(
        F.count(F.when(F.col("__known").isNull(), 1)).alias("inserted"),
        F.count("__known").alias("modified"),
        F.count(F.lit(1)).alias("saved"),
    )


# ---- watermarks ------------------------------------------------------------


def since(
    batch: DataFrame,
    target: DataFrame,
    batch_ts: str,
    target_ts: str,
    default: dt.datetime | None = None,
    null_admits_all: bool = True,
) -> DataFrame:
    """Batch rows later than the target's newest row (strictly).

    With no newest row, `default` stands in; without a default either all rows
    pass or, with `null_admits_all=False`, none (K7).
    """
    newest = F.max(target_ts)
    if default is not None:
        newest = F.coalesce(newest, ntz(default))
    marked = cross_scalar(batch, target.agg(newest.alias("__mark")))
    mark = F.col("__mark")
    keep = F.col(batch_ts) > mark
    if default is None and null_admits_all:
        keep = mark.isNull() | keep
    return marked.filter(keep).drop("__mark")


def since_mark(
    batch: DataFrame,
    mark: dt.datetime | None,
    batch_ts: str,
    default: dt.datetime | None = None,
    null_admits_all: bool = True,
) -> DataFrame:
    """As `since`, for a newest value that is known (from a table's manifest, say).

    The target is not read, and the value reaches the scan of the batch as a literal.
    """
    mark = default if mark is None else mark
    if mark is None:
        return batch if null_admits_all else batch.filter(F.lit(False))
    return batch.filter(F.col(batch_ts) > ntz(mark))


def extract_since(src: DataFrame, target: DataFrame, src_ts: str, tgt_ts: str) -> DataFrame:
    """Source documents created after the newest one already loaded."""
    return since(src, target, src_ts, tgt_ts)


def lookback(
    batch: DataFrame, target: DataFrame, column: str, days: int, default: dt.datetime
) -> DataFrame:
    """Batch rows of the target's last days and later, so late actuals are taken in."""
    first = F.coalesce(F.date_sub(F.max(column), days), F.lit(default.date()))
    marked = cross_scalar(batch, target.agg(first.alias("__from")))
    return marked.filter(F.col(column) >= F.col("__from")).drop("__from")


def not_loaded(batch: DataFrame, target: DataFrame, key: str, *same: str) -> DataFrame:
    """Batch rows whose key the target lacks, or holds with another value in `same` (K6)."""
    held = target.select(key, *same).distinct().alias("held")
    match = F.col(f"batch.{key}") == F.col(f"held.{key}")
    for column in same:
        match &= F.col(f"batch.{column}").eqNullSafe(F.col(f"held.{column}"))
    return batch.alias("batch").join(held, match, "left_anti")


# ---- loads -----------------------------------------------------------------


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Replace every target row whose key is in the batch."""
    kept = target.join(batch.select(key).distinct(), key, "left_anti")
    return kept.select(*target.columns).unionByName(batch)


def merge_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Update matched keys, insert the others; the batch has one row per key."""
    return delete_insert(target, batch, key)


def append_new(
    target: DataFrame, batch: DataFrame, ts: str, default: dt.datetime | None = None
) -> DataFrame:
    """Target plus the batch rows newer than its watermark."""
    return target.unionByName(since(batch, target, ts, ts, default))


def align_schema(df: DataFrame, target: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """(df, target) with equal columns: `fail` on any difference, or `sync_all_columns`.

    Syncing gives old rows NULL in added columns and drops columns the load no
    longer has.
    """
    have = {f.name: f.dataType for f in target.schema.fields}
    want = {f.name: f.dataType for f in df.schema.fields}
    if have == want:
        return df, target.select(*df.columns)
    if policy == "fail":
        changed = sorted(n for n in have.keys() | want.keys() if have.get(n) != want.get(n))
        raise SchemaChanged(f"columns differ: {', '.join(changed)}")
    if policy != "sync_all_columns":
        raise ValueError(f"unknown schema change policy: {policy}")
    cols: list[Column] = []
    for name, kind in want.items():
        value = F.col(name) if name in have else F.lit(None)
        cols.append(value.cast(kind).alias(name))
    return df, target.select(*cols)

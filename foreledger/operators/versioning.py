"""Slowly changing versions (type 2) of keyed rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.config import OPEN_END, Settings
from foreledger.functions.scalars import hours_between, is_current, ntz, truncate
from foreledger.operators.windows import ordered

KEYS = ("data_from_dttm", "data_to_dttm")
TRACKED = ("forecast_intensity", "actual_intensity", "index_forecast", "index_actual")
RAW_COLUMNS = (
    "id",
    *KEYS,
    *TRACKED,
    "valid_from_dttm",
    "valid_to_dttm",
    "src_processed_dttm",
    "processed_dttm",
)

LAST_SEEN = "last_seen_dttm"


def _one_second() -> Column:
    return F.expr("INTERVAL '1' SECOND")


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair differs; NULL equals NULL."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in zip(left, right)])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the one with the greatest `order`; map-side combined."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*df.columns)


def scd2_from_log(
    log: DataFrame,
    cfg: Settings,
    keys: Sequence[str] = KEYS,
    tracked: Sequence[str] = TRACKED,
    ts: str = "created_at",
    tie: str = "id",
) -> DataFrame:
    """Versions from a complete observation log.

    Observations equal to the one before them open no version. A version ends a
    second before the next begins, and never before its own start (two changes
    within one second).
    """
    changed = with_opens(log, cfg, keys, tracked, ts, tie).filter("opens").drop("opens")
    return versions_of(changed, cfg, keys, ts, tie)


def with_opens(
    log: DataFrame,
    cfg: Settings,
    keys: Sequence[str] = KEYS,
    tracked: Sequence[str] = TRACKED,
    ts: str = "created_at",
    tie: str = "id",
) -> DataFrame:
    """`opens` for each observation: whether it differs from the one before it."""
    now = F.struct(*tracked)
    order = [F.col(ts).asc(), F.col(tie).asc()]
    seen = ordered(log, keys, order, {"__before": lambda w: F.lag(now).over(w)}, cfg, before=1)
    opens = F.col("__before").isNull() | ~now.eqNullSafe(F.col("__before"))
    return seen.withColumn("opens", opens).drop("__before")


def versions_of(
    changed: DataFrame,
    cfg: Settings,
    keys: Sequence[str] = KEYS,
    ts: str = "created_at",
    tie: str = "id",
) -> DataFrame:
    """Versions from the observations that open one."""
    order = [F.col(ts).asc(), F.col(tie).asc()]
    begun = changed.withColumn("valid_from_dttm", truncate(F.col(ts), "second"))
    following = ordered(
        begun,
        keys,
        order,
        {"__next": lambda w: F.lead("valid_from_dttm").over(w)},
        cfg,
        after=1,
    )
    end = F.greatest(F.col("__next") - _one_second(), F.col("valid_from_dttm"))
    return (
        following.withColumns(
            {
                "valid_to_dttm": F.when(F.col("__next").isNotNull(), end).otherwise(
                    ntz(OPEN_END)
                ),
                "src_processed_dttm": F.col(ts),
                "processed_dttm": F.col("valid_from_dttm"),
            }
        )
        .drop("__next")
        .select(*RAW_COLUMNS)
    )


def scd2_merge(
    target: DataFrame,
    batch: DataFrame,
    now: dt.datetime,
    keys: Sequence[str] = KEYS,
    tracked: Sequence[str] = TRACKED,
    stamp: str = "src_processed_dttm",
) -> DataFrame:
    """The whole table after loading `batch` (rows as `sources.feed.flatten` makes them).

    The batch is first reduced to one row per key, so a key sent twice cannot
    open two versions at once. Only the open versions take part in the join;
    closed ones pass through without a shuffle. A matched, changed row comes out
    twice from one join: closed, and as the new version. A row older than the open
    version it meets was overtaken on its way and changes nothing; a version never
    starts before the one it follows.

    Where the table has a column `last_seen_dttm`, it holds the newest delivery that
    brought the open version, and advances with each that confirms it; without it
    only the delivery that opened the version is known. `operators.timeline` puts
    late rows into their place in history instead.
    """
    at = truncate(ntz(now), "second")
    closed = target.filter(~is_current(F.col("valid_to_dttm")))
    live = target.filter(is_current(F.col("valid_to_dttm")))
    incoming = latest_per_key(batch, keys, [stamp, *tracked])

    old = live.select(F.struct(*live.columns).alias("old"), *keys)
    new = incoming.select(F.struct(*incoming.columns).alias("new"), *keys)
    both = old.join(new, list(keys), "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    newest = F.col(f"old.{stamp}")
    if LAST_SEEN in target.columns:
        newest = F.greatest(newest, F.col(f"old.{LAST_SEEN}"))  # skips NULL
    overtaken = F.coalesce(F.col(f"new.{stamp}") < newest, F.lit(False))
    changed = (
        has_old
        & has_new
        & ~overtaken
        & differs([F.col(f"old.{c}") for c in tracked], [F.col(f"new.{c}") for c in tracked])
    )
    # the open version is known to start at or before the load
    until = F.greatest(at - _one_second(), F.col("old.valid_from_dttm"))
    kept = F.col("old").withField(
        "valid_to_dttm", F.when(changed, until).otherwise(F.col("old.valid_to_dttm"))
    )
    if LAST_SEEN in target.columns:
        confirmed = F.greatest(newest, F.when(~changed, F.col(f"new.{stamp}")))
        kept = kept.withField(LAST_SEEN, confirmed.cast(target.schema[LAST_SEEN].dataType))
    begins = F.greatest(at, F.col("old.valid_from_dttm"))  # a missing old one does not count
    fresh = F.struct(
        *[_fresh_field(c, target, incoming, keys, begins, stamp).alias(c) for c in target.columns]
    )
    rows = F.array_compact(
        F.array(F.when(has_old, kept), F.when(changed | ~has_old, fresh))
    )
    merged = both.select(F.explode(rows).alias("row")).select("row.*")
    return closed.unionByName(merged.select(*target.columns))


def _fresh_field(name, target, incoming, keys, at, stamp) -> Column:
    kind = target.schema[name].dataType
    if name == LAST_SEEN:
        return F.col(f"new.{stamp}").cast(kind)
    if name == "id":
        # a key from the content: no sequence, same value when the load is replayed
        return F.xxhash64(*[F.col(f"new.{k}") for k in keys], at).cast(kind)
    if name in ("valid_from_dttm", "processed_dttm"):
        return at.cast(kind)
    if name == "valid_to_dttm":
        return ntz(OPEN_END).cast(kind)
    if name in incoming.columns:
        return F.col(f"new.{name}").cast(kind)
    return F.lit(None).cast(kind)


def load_stats(target: DataFrame, batch: DataFrame, keys=KEYS, tracked=TRACKED) -> DataFrame:
    """One row: records extracted, inserted, re-versioned, and whether the load is complete."""
    live = target.filter(is_current(F.col("valid_to_dttm"))).select(
        *keys, F.struct(*tracked).alias("old")
    )
    incoming = latest_per_key(batch, keys, ["src_processed_dttm", *tracked])
    joined = incoming.join(live, list(keys), "left")
    new = F.struct(*tracked)
    counts = joined.agg(
        F.count(F.lit(1)).alias("extracted"),
        F.count(F.when(F.col("old").isNull(), 1)).alias("inserted"),
        F.count(F.when(F.col("old").isNotNull() & ~new.eqNullSafe(F.col("old")), 1)).alias(
            "reversioned"
        ),
    )
    return counts.withColumns(
        {
            "loaded": F.col("inserted") + F.col("reversioned"),
            "transfer_ok": ratio_ok(F.col("extracted"), F.col("inserted") + F.col("reversioned")),
        }
    )


def ratio_ok(n_in: Column, n_out: Column, ratio: float = 0.9) -> Column:
    return (n_in == 0) | (n_out >= n_in * F.lit(ratio))


def current_rows(raw: DataFrame) -> DataFrame:
    """Open versions, without the technical key."""
    return raw.filter(is_current(F.col("valid_to_dttm"))).select(
        *KEYS,
        *TRACKED,
        "src_processed_dttm",
        "processed_dttm",
        "valid_from_dttm",
        "valid_to_dttm",
    )


def forecast_changes(raw: DataFrame) -> DataFrame:
    """All versions with the horizon they were made at."""
    return raw.select(
        *KEYS,
        "forecast_intensity",
        "actual_intensity",
        F.col("valid_from_dttm").alias("forecast_made_at"),
        F.col("valid_to_dttm").alias("forecast_valid_until"),
        hours_between(F.col("valid_from_dttm"), F.col("data_from_dttm")).alias(
            "forecast_horizon_hours"
        ),
        is_current(F.col("valid_to_dttm")).alias("is_current"),
    )

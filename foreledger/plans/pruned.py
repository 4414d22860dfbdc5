"""Which partitions an incremental load has to read: the changed weeks and a halo before them.

All of it is decided from manifests and from counts over partitions that are read
anyway. Partitions are taken from the newest backwards, twice as many each time, until
every row frame that reaches back from the changed weeks is full.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.functions.scalars import ntz
from foreledger.sources.store import Snapshot

FIRST_STEP = 8  # partitions

# of the partitions tried and those left out: whether the frames are full
Full = Callable[[list[str], list[str]], bool]


def first_changed_week(state: Snapshot, older: Snapshot | None) -> dt.date | None:
    """Monday of the earliest partition that changed; None if none did."""
    days = [dt.date.fromisoformat(d) for d in state.changed_since(older)]
    return min(d - dt.timedelta(days=d.weekday()) for d in days) if days else None


def split_days(state: Snapshot, start: dt.date) -> tuple[list[str], list[str]]:
    """Partitions from `start` on, and those before it, the newest first."""
    days = sorted(state.parts, reverse=True)
    first = start.isoformat()
    return [d for d in days if d >= first], [d for d in days if d < first]


def halo(before: Sequence[str], full: Full) -> list[str]:
    """As many of the partitions `before` as the frames need."""
    n = FIRST_STEP
    while n < len(before):
        if full(list(before[:n]), list(before[n:])):
            return list(before[:n])
        n *= 2
    return list(before)


def newest_in(state: Snapshot, days: Sequence[str], column: str) -> dt.datetime | None:
    found = [state.parts[d].high[column] for d in days if state.parts[d].high.get(column)]
    return dt.datetime.fromisoformat(max(found)) if found else None


def oldest_in(state: Snapshot, days: Sequence[str], column: str) -> dt.datetime | None:
    found = [state.parts[d].low[column] for d in days if state.parts[d].low.get(column)]
    return dt.datetime.fromisoformat(min(found)) if found else None


def values_of(rows: DataFrame, key: Column) -> set:
    """The few values of a frame's key (version kinds, horizon bands)."""
    return {r[0] for r in rows.select(key).distinct().collect()}


def enough(rows: DataFrame, key: Column, wanted: set, n: int, later: dt.datetime | None = None, ts: str = "") -> bool:
    """Whether each wanted key has n rows (made after `later`)."""
    if later is not None:
        rows = rows.filter(F.col(ts) > ntz(later))
    counts = dict(rows.groupBy(key.alias("k")).agg(F.count(F.lit(1))).collect())
    return all(counts.get(k, 0) >= n for k in wanted)

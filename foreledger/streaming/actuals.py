"""Forecasts joined to the actual values that are reported later.

The same join reads on tables and on streams. As a stream-stream join it keeps a
forecast until its actual comes, or until none can come any more; then the forecast is
given out without one. The condition on the report's time bounds the state on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.operators.versioning import KEYS

REPORTED = "reported_at"


@dataclass(frozen=True)
class Reporting:
    """When an actual counts: from `early` before its period begins to `late` after.

    `delay` is how far the rows of one stream may lie behind the newest one seen, by the
    period's begin for forecasts and by the report's time for actuals. Forecasts reach
    ahead, so it is at least the longest horizon.
    """

    early: str = "0 hours"
    late: str = "7 days"
    delay: str = "2 days"

    def holds(self, reported, begin):
        early, late = (F.expr(f"INTERVAL {s}") for s in (self.early, self.late))
        return (reported >= begin - early) & (reported <= begin + late)


def _instant(name: str):
    # watermarks exist on instants only; the session runs in UTC
    return F.col(name).cast("timestamp")


def first_reports(actuals: DataFrame, rule: Reporting) -> DataFrame:
    """One report per period: the first that counts. Later ones are revisions.

    On a stream the first to arrive, remembered as long as a repeat may come.
    """
    rows = actuals.filter(
        F.col("actual_intensity").isNotNull() & rule.holds(_instant(REPORTED), _instant(KEYS[0]))
    ).select(*KEYS, "actual_intensity", REPORTED, _instant(REPORTED).alias("__reported"))
    if rows.isStreaming:
        return rows.withWatermark("__reported", rule.delay).dropDuplicatesWithinWatermark([*KEYS])
    first = F.min_by(
        F.struct("actual_intensity", REPORTED, "__reported"),
        F.struct(REPORTED, "actual_intensity"),
    )
    return rows.groupBy(*KEYS).agg(first.alias("__first")).select(*KEYS, "__first.*")


def with_actuals(
    forecasts: DataFrame, actuals: DataFrame, rule: Reporting = Reporting()
) -> DataFrame:
    """Every forecast with `actual_intensity` and `reported_at`, NULL where none came in time.

    One actual per period joins, so the result has a row per forecast. On streams the
    unmatched ones come out when the watermark has passed the end of their time.
    """
    left = forecasts.withColumn("__begin", _instant(KEYS[0]))
    if left.isStreaming:
        left = left.withWatermark("__begin", rule.delay)
    right = first_reports(actuals, rule)
    right = right.select(*[F.col(k).alias(f"__{k}") for k in KEYS], "actual_intensity", REPORTED, "__reported")
    same = rule.holds(F.col("__reported"), F.col("__begin"))
    for k in KEYS:
        same = same & (F.col(k) == F.col(f"__{k}"))
    return left.join(right, same, "left").drop("__begin", "__reported", *[f"__{k}" for k in KEYS])

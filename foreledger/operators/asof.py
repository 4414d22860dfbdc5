"""Forecasts as they were known at a lead time before their period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.functions.scalars import is_current
from foreledger.operators.versioning import KEYS

LEADS = (1, 6, 24)  # hours


def at_lead(raw: DataFrame, leads: Sequence[int] = LEADS, keys: Sequence[str] = KEYS) -> DataFrame:
    """A row per period and lead: the forecast known then, and the period's actual value.

    The versions of a period are disjoint intervals, so each decides by itself which leads
    it covers; of versions that begin within one second the last counts. Nothing is
    joined: one aggregation, combined before the shuffle, so a period with very many
    versions is no hot key. Leads at which no version was known yet give no row.
    """
    begin, end = F.col("valid_from_dttm"), F.col("valid_to_dttm")
    place = F.struct(begin, "id")
    known = F.struct(begin.alias("forecast_made_at"), "forecast_intensity")

    def of(lead: int):
        moment = F.col("data_from_dttm") - F.expr(f"INTERVAL '{int(lead)}' HOUR")
        covers = (begin <= moment) & (end > moment - F.expr("INTERVAL '1' SECOND"))
        return F.max_by(known, F.when(covers, place)).alias(f"__at_{lead}")

    latest = F.max_by("actual_intensity", F.when(is_current(end), place)).alias("actual_intensity")
    seen = raw.groupBy(*keys).agg(latest, *[of(x) for x in leads])
    rows = F.array(*[F.struct(F.lit(x).alias("lead_hours"), F.col(f"__at_{x}").alias("v")) for x in leads])
    error = F.col("forecast_intensity") - F.col("actual_intensity")
    return (
        seen.select(*keys, "actual_intensity", F.inline(rows))
        .filter(F.col("v").isNotNull())
        .select(*keys, "lead_hours", "v.*", "actual_intensity")
        .withColumns({"error": error, "absolute_error": F.abs(error)})
    )


def lead_accuracy(raw: DataFrame, leads: Sequence[int] = LEADS) -> DataFrame:
    """Per lead: periods with a forecast, those with an actual, mean and absolute error."""
    return at_lead(raw, leads).groupBy("lead_hours").agg(
        F.count(F.lit(1)).alias("periods"),
        F.count("error").alias("with_actual"),
        F.avg("error").alias("mean_error"),
        F.avg("absolute_error").alias("mean_absolute_error"),
    )

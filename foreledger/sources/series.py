"""Adapter: an event log read as a log of forecast observations for half-hour periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.functions.scalars import floor_to, ntz

HALF_HOUR = 1800


def observations(events: DataFrame) -> DataFrame:
    """One observation per event: a period, its forecast, maybe its actual, a spelled index.

    After the first rounding all values are integer arithmetic, so any engine
    computes the same ones.
    """
    cents = F.round(F.col("value") * 100).cast("bigint")
    shift = (F.col("event_id") * 7) % 61 - 1
    start = F.unix_seconds(floor_to(F.col("ts"), HALF_HOUR).cast("timestamp")) + shift * HALF_HOUR
    capped = lambda amount: F.least(F.lit(50) + amount, F.lit(1000)).cast("int")
    whole = lambda part, by: F.floor(part / F.lit(by))
    actual = whole(F.lit(3) * cents * (F.lit(85) + (F.col("user_id") % 10) * 3), 10000)
    label = (
        F.when(F.col("forecast") >= 300, "very high")
        .when(F.col("forecast") >= 200, "high")
        .when(F.col("forecast") >= 150, "moderate")
        .when(F.col("forecast") >= 100, "low")
        .otherwise("very low")
    )
    spelled = (
        F.when(F.col("event_id") % 3 == 1, F.upper(label))
        .when(F.col("event_id") % 3 == 2, F.concat(F.lit(" "), label, F.lit(" ")))
        .otherwise(label)
    )
    reported = F.col("event_type").isin("purchase", "signup", "view")
    return (
        events.withColumns(
            {
                "data_from_dttm": ntz(F.timestamp_seconds(start)),
                "data_to_dttm": ntz(F.timestamp_seconds(start + HALF_HOUR)),
                "forecast": capped(whole(cents * 3, 100)),
                "actual": F.when(reported, capped(actual)),
            }
        )
        .withColumn("index", spelled)
        .select(
            F.col("event_id").alias("id"),
            F.col("ts").alias("created_at"),
            "data_from_dttm",
            "data_to_dttm",
            F.col("forecast").alias("forecast_intensity"),
            F.col("actual").alias("actual_intensity"),
            F.col("index").alias("index_forecast"),
            F.col("index").alias("index_actual"),
        )
    )


def documents(log: DataFrame) -> DataFrame:
    """The observation log as nested documents of the document store."""
    return log.select(
        "id",
        F.col("data_from_dttm").alias("from"),
        F.col("data_to_dttm").alias("to"),
        "created_at",
        F.struct(
            F.col("forecast_intensity").alias("forecast"),
            F.col("actual_intensity").alias("actual"),
            F.col("index_forecast").alias("index"),
        ).alias("intensity"),
    )


def responses(log: DataFrame, per_response: int = 48) -> DataFrame:
    """The observation log as feed responses: JSON texts of `per_response` records.

    The response number comes from the unique id, so a response never grows.
    """
    spelled = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm'Z'")
    block = F.struct(
        F.col("forecast_intensity").alias("forecast"),
        F.col("actual_intensity").alias("actual"),
        F.col("index_forecast").alias("index"),
    )
    record = F.struct(
        spelled(F.col("data_from_dttm")).alias("from"),
        spelled(F.col("data_to_dttm")).alias("to"),
        block.alias("intensity"),
    )
    return (
        log.withColumn("record", record)
        .groupBy(F.expr(f"id div {per_response}").alias("response_id"))
        .agg(F.collect_list("record").alias("data"))
        .select("response_id", F.to_json(F.struct("data")).alias("body"))
    )

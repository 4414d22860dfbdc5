"""Time windows that read the same on a table and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foreledger.functions.scalars import ntz


def half_hour(df: DataFrame, ts: str, value: str, delay: str | None = None) -> DataFrame:
    """Rows and mean value per half hour. A stream needs `delay`, how late rows may be."""
    # watermarks exist on instants only; the session runs in UTC
    rows = df.withColumn("__at", F.col(ts).cast("timestamp"))
    if delay:
        rows = rows.withWatermark("__at", delay)
    counted = rows.groupBy(F.window("__at", "30 minutes")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value")
    )
    return counted.select(
        ntz(F.col("window.start")).alias("window_start"),
        ntz(F.col("window.end")).alias("window_end"),
        "n",
        "mean_value",
    )


def stream_islands(
    df: DataFrame, keys: list[str], ts: str, minutes: int, delay: str
) -> DataFrame:
    """Stretches without a hole longer than `minutes`, closed once the watermark passes them."""
    rows = df.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", delay)
    session = F.session_window("__at", f"{minutes} minutes")
    return rows.groupBy(*keys, session).agg(
        F.min("__at").cast("timestamp_ntz").alias("island_start"),
        F.max("__at").cast("timestamp_ntz").alias("island_end"),
        F.count(F.lit(1)).alias("rows"),
    ).drop("session_window")

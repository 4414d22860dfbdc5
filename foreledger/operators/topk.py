"""Sorted heads of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATEST_DEFAULT = 10


def latest(
    df: DataFrame, ts: str, ties: Sequence[Column], n: int = LATEST_DEFAULT
) -> DataFrame:
    """The last n rows by time."""
    return df.orderBy(F.col(ts).desc_nulls_last(), *ties).limit(n)


def n_largest(df: DataFrame, value: str, n: int, ties: Sequence[Column]) -> DataFrame:
    return df.orderBy(F.col(value).desc_nulls_last(), *ties).limit(n)


def best_worst(df: DataFrame, hour: str, value: str, k: int = 3) -> DataFrame:
    """The k lowest and k highest hourly means (24 rows, so one small window)."""
    hourly = df.groupBy(hour).agg(F.avg(value).alias("mean_value"))
    low = Window.orderBy(F.col("mean_value").asc(), F.col(hour).asc())
    high = Window.orderBy(F.col("mean_value").desc(), F.col(hour).desc())
    ranked = hourly.withColumns(
        {"best_rank": F.row_number().over(low), "worst_rank": F.row_number().over(high)}
    )
    return ranked.filter((F.col("best_rank") <= k) | (F.col("worst_rank") <= k))


def read_mart(
    mart: DataFrame, since_day: Column, columns: Sequence[str], n: int | None = None
) -> DataFrame:
    """Rows of the mart from a day on, as the analyses read them; the newest n if asked.

    With n, sort and limit become one top-n per task.
    """
    rows = mart.filter(F.col("data_date") >= since_day).select(*columns)
    if n is None:
        return rows
    newest = [F.col("period_start").desc(), *[F.col(c).asc_nulls_last() for c in columns[1:]]]
    return rows.orderBy(*newest).limit(n)

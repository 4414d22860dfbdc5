"""Holes in a series, and the stretches between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.functions.scalars import minutes_between
from foreledger.operators.windows import cumulate, ordered, settle


def with_gap(
    df: DataFrame, ts: str, keys: Sequence[str], cfg: Settings, ties: Sequence[Column] = ()
) -> DataFrame:
    """Previous time of the key and the minutes since."""
    order = [F.col(ts).asc(), *ties]
    out = ordered(
        df, keys, order, {"prev_period": lambda w: F.lag(ts).over(w)}, cfg, before=1
    )
    return out.withColumn("gap_minutes", minutes_between(F.col("prev_period"), F.col(ts)))


def gaps(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    minutes: float,
    cfg: Settings,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Rows that follow a hole longer than `minutes`."""
    return with_gap(df, ts, keys, cfg, ties).filter(F.col("gap_minutes") > minutes)


def gap_islands(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    minutes: float,
    cfg: Settings,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Stretches without a hole: start, end, rows, numbered per key."""
    order = [F.col(ts).asc(), *ties]
    marked = with_gap(df, ts, keys, cfg, ties).withColumn(
        "__break", F.when(F.col("gap_minutes") <= minutes, 0).otherwise(1)
    )
    numbered = cumulate(
        settle(marked, cfg, "breaks"), keys, order, {"island": F.col("__break")}, cfg
    )
    return numbered.groupBy(*keys, "island").agg(
        F.min(ts).alias("island_start"),
        F.max(ts).alias("island_end"),
        F.count(F.lit(1)).alias("rows"),
    )

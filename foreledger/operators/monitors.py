"""Anomaly monitors: a daily metric against its own recent history.

The history of a day is the `cfg.history_buckets` days before it that have data
(itself excluded); with fewer than `cfg.min_history` of them nothing is judged.
A day is anomalous when it lies more than `cfg.sigmas` sample deviations from
the mean of its history. Metrics are aggregated to days first, so the windows
run over one row per day (and dimension or metric).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foreledger.config import Settings
from foreledger.functions.scalars import hours_between
from foreledger.operators.gaps import with_gap


def judge(days: DataFrame, keys: Sequence[str], metric: str, cfg: Settings) -> DataFrame:
    """Add history mean, deviation, size, and the verdict to day rows."""
    history = (
        Window.partitionBy(*keys).orderBy("bucket").rowsBetween(-cfg.history_buckets, -1)
    )
    value = F.col(metric)
    off = F.abs(value - F.col("history_mean")) > F.col("history_stddev") * F.lit(cfg.sigmas)
    enough = (F.col("history_size") >= cfg.min_history) & (F.col("history_stddev") > 0)
    return days.withColumns(
        {
            "history_size": F.count(value).over(history),
            "history_mean": F.avg(value).over(history),
            "history_stddev": F.stddev_samp(value).over(history),
        }
    ).withColumn("is_anomaly", F.coalesce(enough & off, F.lit(False)))


def _bucketed(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("bucket", F.to_date(ts))


def volume_anomalies(df: DataFrame, ts: str, cfg: Settings) -> DataFrame:
    days = _bucketed(df, ts).groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"))
    return judge(days, [], "row_count", cfg)


def freshness_anomalies(
    df: DataFrame, ts: str, cfg: Settings, ties: Sequence[Column] = ()
) -> DataFrame:
    """Longest wait for a row, per day of the row that ended it."""
    waits = _bucketed(with_gap(df, ts, [], cfg, ties), ts)
    days = waits.groupBy("bucket").agg(F.max("gap_minutes").alias("max_gap_minutes"))
    return judge(days, [], "max_gap_minutes", cfg)


def event_freshness(df: DataFrame, event_ts: str, update_ts: str, cfg: Settings) -> DataFrame:
    """Longest delay from event to update, per day of the event."""
    delay = hours_between(F.col(event_ts), F.col(update_ts))
    days = _bucketed(df, event_ts).groupBy("bucket").agg(F.max(delay).alias("max_delay_hours"))
    return judge(days, [], "max_delay_hours", cfg)


def dimension_anomalies(
    df: DataFrame, dims: Sequence[str], ts: str, cfg: Settings
) -> DataFrame:
    days = _bucketed(df, ts).groupBy(*dims, "bucket").agg(F.count(F.lit(1)).alias("row_count"))
    return judge(days, dims, "row_count", cfg)


def _metrics(name: str, kind: T.DataType) -> dict[str, Column]:
    col = F.col(name)
    nulls = F.count(F.when(col.isNull(), 1)).cast("double")
    found = {"null_count": nulls, "null_pct": nulls * 100.0 / F.count(F.lit(1))}
    if isinstance(kind, T.NumericType):
        number = col.cast("double")
        found |= {
            "min": F.min(number),
            "max": F.max(number),
            "avg": F.avg(number),
            "stddev": F.stddev_samp(number),
        }
    elif isinstance(kind, T.StringType):
        length = F.length(col).cast("double")
        found |= {
            "min_length": F.min(length),
            "avg_length": F.avg(length),
            "max_length": F.max(length),
        }
    return found


def column_anomalies(
    df: DataFrame, cols: Sequence[str], ts: str, cfg: Settings
) -> DataFrame:
    """Day metrics of columns by their type: one wide aggregate, then one row per metric."""
    wide, names = [], []
    for col in cols:
        for metric, agg in _metrics(col, df.schema[col].dataType).items():
            wide.append(agg.alias(f"{col}__{metric}"))
            names.append((col, metric))
    days = _bucketed(df, ts).groupBy("bucket").agg(*wide)
    rows = F.array(
        *[
            F.struct(
                F.lit(col).alias("column_name"),
                F.lit(metric).alias("metric"),
                F.col(f"{col}__{metric}").alias("metric_value"),
            )
            for col, metric in names
        ]
    )
    tall = days.select("bucket", F.inline(rows))
    return judge(tall, ["column_name", "metric"], "metric_value", cfg)


def all_columns_anomalies(df: DataFrame, ts: str, cfg: Settings) -> DataFrame:
    return column_anomalies(df, [c for c in df.columns if c != ts], ts, cfg)

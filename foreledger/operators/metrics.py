"""Monitors on stored day metrics.

A metric table holds one mergeable state per day and column: rows, filled values, mean,
sum of squared deviations, least and greatest value, and a sketch of the distinct values.
The row of column `*` holds the day's row count, its first and last time, and the longest
wait within it. A run computes the states of the days whose partitions changed, so its
cost is that of the new data, and the monitors read states only. States of disjoint rows
merge (`combined`), for weeks or for batches of a day.

Numbers are measured by value, texts by length; other types only by their NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foreledger.config import Settings
from foreledger.functions.scalars import minutes_between
from foreledger.operators.gaps import with_gap
from foreledger.operators.monitors import judge
from foreledger.sources import store

BUCKET = "bucket"
ALL = "*"


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    return "text" if isinstance(kind, T.StringType) else "other"


def _measure(col: Column, kind: str) -> Column:
    if kind == "number":
        return col.cast("double")
    return (F.length(col) if kind == "text" else F.lit(None)).cast("double")


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in dict.fromkeys(names)]


def day_states(
    df: DataFrame,
    ts: str,
    cfg: Settings,
    cols: Sequence[str] | None = None,
    dims: Sequence[str] = (),
    bucket: Column | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """(*dims, bucket, column_name, kind, n, filled, mean, m2, low, high, distinct, first_at,
    last_at, longest_wait), one row per dimension values, day and column.

    `cols` are all columns but the time and the dimensions unless given. Rows without a time
    form a day of their own. One aggregate for all columns; the waits take the rows in order.
    """
    dims = list(dims)
    if cols is None:
        cols = [c for c in df.columns if c not in (ts, *dims)]
    day = F.to_date(ts) if bucket is None else bucket
    keys = [*dims, BUCKET]
    rows = df.select(*_named([*dims, ts, *cols]), day.alias(BUCKET))
    wide, entries = [F.count(F.lit(1)).alias("__n")], []
    for i, name in enumerate(cols):
        col, kind = F.col(f"`{name}`"), _kind(df.schema[name].dataType)
        value = _measure(col, kind)
        parts = {
            "filled": F.count(col),
            "mean": F.avg(value),
            "m2": F.var_pop(value) * F.count(value),
            "low": F.min(value),
            "high": F.max(value),
            "distinct": F.hll_sketch_agg(col.cast("string")),
        }
        wide += [agg.alias(f"__{part}_{i}") for part, agg in parts.items()]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("kind"),
                *[F.col(f"__{part}_{i}").alias(part) for part in parts],
            )
        )
    no_value = F.lit(None).cast("double")
    entries.append(
        F.struct(
            F.lit(ALL).alias("column_name"),
            F.lit("other").alias("kind"),
            F.col("__n").alias("filled"),
            *[no_value.alias(p) for p in ("mean", "m2", "low", "high")],
            F.lit(None).cast("binary").alias("distinct"),
        )
    )
    counted = rows.groupBy(*keys).agg(*wide)
    tall = counted.select(*keys, F.col("__n").alias("n"), F.inline(F.array(*entries)))
    ordered = df.select(*_named([*dims, ts, *ties]), day.alias(BUCKET))
    waits = (
        with_gap(ordered, ts, keys, cfg, [F.col(c).asc() for c in ties])
        .groupBy(*keys)
        .agg(
            F.min(ts).alias("first_at"),
            F.max(ts).alias("last_at"),
            F.max("gap_minutes").alias("longest_wait"),
        )
        .select(*[F.col(k).alias(f"__w_{k}") for k in keys], "first_at", "last_at", "longest_wait")
    )
    same = F.col("column_name") == ALL
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__w_{k}"))
    joined = tall.join(waits, same, "left").drop(*[f"__w_{k}" for k in keys])
    return joined.select(
        *keys, "column_name", "kind", "n", "filled", "mean", "m2", "low", "high", "distinct",
        "first_at", "last_at", "longest_wait",
    )


def combined(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of the unions of disjoint rows: one row per `keys`, column and kind.

    The deviations are moved to the common mean, not taken from sums of squares, so
    nothing cancels. The longest wait counts those between one state and the next, which
    needs states that do not overlap in time, as days do not.
    """
    by = [*keys, "column_name", "kind"]
    whole = Window.partitionBy(*by)
    share = F.col("filled") * F.col("mean")
    grand = F.sum(share).over(whole) / F.sum(F.when(F.col("mean").isNotNull(), F.col("filled"))).over(whole)
    between = minutes_between(F.lag("last_at").over(whole.orderBy("first_at")), F.col("first_at"))
    moved = states.withColumns(
        {
            "__grand": grand,
            "longest_wait": F.greatest("longest_wait", between),
        }
    ).withColumn("m2", F.col("m2") + F.col("filled") * (F.col("mean") - F.col("__grand")) ** 2)
    return moved.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("filled").alias("filled"),
        F.max("__grand").alias("mean"),
        F.sum("m2").alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.max("longest_wait").alias("longest_wait"),
    )


def update(
    spark: SparkSession,
    source: str,
    target: str,
    ts: str,
    cfg: Settings,
    cols: Sequence[str] | None = None,
    dims: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> list[str] | None:
    """Bring the metric table of a published, day-partitioned table up to date.

    Returns the days that were read: those whose partitions differ from the state the
    metrics were made from, or None where all were (the first run, a day that is gone, or
    a state too old to be known).
    """
    state, held = store.snapshot(spark, source), store.snapshot(spark, target)
    if state is None or state.by is None:
        raise ValueError(f"no partitioned table at {source}")
    known = held.source_version if held else None
    older = store.snapshot(spark, source, known) if known else None

    def states(days: list[str] | None) -> DataFrame:
        rows = store.read_snapshot(spark, source, state, days)
        named = [c for c in rows.columns if c not in (ts, state.by, *dims)] if cols is None else cols
        return day_states(rows, ts, cfg, named, dims, F.col(state.by), ties)

    if older is None or older.parts.keys() - state.parts.keys():
        store.rebuild(states(None), target, BUCKET, state.version)
        return None
    days = state.changed_since(older)
    if days:
        store.replace_partitions(states(days), target, BUCKET, source_version=state.version)
    return days


def stddev() -> Column:
    """Sample deviation of a state."""
    return F.when(F.col("filled") > 1, F.sqrt(F.col("m2") / (F.col("filled") - 1)))


def metric_rows(states: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """(*dims, bucket, column_name, metric, metric_value), as the monitors judge them."""
    nulls = (F.col("n") - F.col("filled")).cast("double")
    both = {"null_count": nulls, "null_pct": nulls * 100.0 / F.col("n")}
    low, high, mean = F.col("low"), F.col("high"), F.col("mean")
    by_kind = {
        "number": both | {"min": low, "max": high, "avg": mean, "stddev": stddev()},
        "text": both | {"min_length": low, "avg_length": mean, "max_length": high},
        "other": both,
    }

    def entries(metrics: dict[str, Column]) -> Column:
        pairs = [F.struct(F.lit(m).alias("metric"), v.alias("metric_value")) for m, v in metrics.items()]
        return F.array(*pairs)

    chosen = F.when(F.col("kind") == "number", entries(by_kind["number"]))
    chosen = chosen.when(F.col("kind") == "text", entries(by_kind["text"]))
    rows = states.filter(F.col("column_name") != ALL)
    return rows.select(*dims, BUCKET, "column_name", F.inline(chosen.otherwise(entries(by_kind["other"]))))


def column_anomalies(states: DataFrame, cfg: Settings, dims: Sequence[str] = ()) -> DataFrame:
    return judge(metric_rows(states, dims), [*dims, "column_name", "metric"], "metric_value", cfg)


def volume_anomalies(states: DataFrame, cfg: Settings, dims: Sequence[str] = ()) -> DataFrame:
    days = states.filter(F.col("column_name") == ALL)
    return judge(days.select(*dims, BUCKET, F.col("n").alias("row_count")), dims, "row_count", cfg)


def freshness_anomalies(states: DataFrame, cfg: Settings, dims: Sequence[str] = ()) -> DataFrame:
    """Longest wait per day, the one that began on an earlier day included."""
    days = states.filter(F.col("column_name") == ALL)
    order = Window.partitionBy(*dims).orderBy(BUCKET)
    since = minutes_between(F.lag("last_at").over(order), F.col("first_at"))
    longest = F.greatest("longest_wait", since).alias("max_gap_minutes")
    return judge(days.select(*dims, BUCKET, longest), dims, "max_gap_minutes", cfg)


def distinct_counts(states: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct values per day and column, within some two in a hundred."""
    rows = states.filter(F.col("column_name") != ALL)
    count = F.hll_sketch_estimate("distinct").alias("distinct_values")
    return rows.select(*dims, BUCKET, "column_name", count)

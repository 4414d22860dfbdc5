"""Window operators that keep working when one key holds most of the rows.

Every operator has two shapes with the same result. The plain shape is an
ordinary window. The wide shape (`cfg.wide`) never gathers a key in one task:

* `ordered`: rows are range-partitioned by key and order, numbered, cut into
  buckets of `cfg.bucket_rows`, and each bucket also receives the few rows next
  to it that its frames reach into. Any `ROWS n PRECEDING / m FOLLOWING`, `lag`,
  `lead` and `row_number` is exact that way.
* `cumulate`: running totals, per bucket plus the total of the buckets before.
* `with_ranks`, `percentiles`: read off a histogram of (key, value) counts, which
  is pre-aggregated before it is shuffled.
* `with_group_stats`: aggregate, then join back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.session import materialize, scan_bytes

_SEQ, _POS, _PART, _BUCKET, _HOME = "__seq", "__pos", "__part", "__bucket", "__home"
# monotonically_increasing_id keeps the partition in the bits above this one
_ROW_BITS = 33

Frames = Mapping[str, Callable[[WindowSpec], Column]]


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL, keeping the key columns of `df` once."""
    renamed = small.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(c) for c in small.columns if c not in keys],
    )
    if not keys:
        return df.crossJoin(renamed)
    same = reduce(
        lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"__k_{k}"]) for k in keys]
    )
    return df.join(renamed, same, how).drop(*[f"__k_{k}" for k in keys])


def settle(df: DataFrame, cfg: Settings, label: str) -> DataFrame:
    """Compute once what several wide operators read again; a no-op on small inputs."""
    return materialize(df, label) if cfg.wide else df


def place(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cfg: Settings
) -> DataFrame:
    """Add each row's position within its key (from 0) without a window over the key.

    The range partitioning is written once, since its bounds come from a sample
    and a re-run must not move rows. Positions then follow from the row number
    inside the partition and the counts of the partitions before it.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), cfg.min_parts)
    sort = [F.col(k).asc() for k in keys] + list(order)
    stored = materialize(
        df.repartitionByRange(parts, *sort)
        .sortWithinPartitions(*sort)
        .withColumn(_SEQ, F.monotonically_increasing_id()),
        "ranged",
    ).withColumn(_PART, F.shiftright(F.col(_SEQ), _ROW_BITS))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(_PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # at most one row per key plus one per partition
    starts = materialize(
        stored.groupBy(*keys, _PART)
        .agg(F.min(_SEQ).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .drop("__n"),
        "starts",
    )
    return (
        attach(stored, starts, [*keys, _PART])
        .withColumn(_POS, F.col("__before") + F.col(_SEQ) - F.col("__first"))
        .drop(_SEQ, _PART, "__before", "__first")
    )


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    frames: Frames,
    cfg: Settings,
    before: int = 0,
    after: int = 0,
    number: str | None = None,
) -> DataFrame:
    """Row-frame columns over (keys, order).

    `frames` maps a new column to a function of the window; it may look at most
    `before` rows back and `after` rows ahead. `order` must be total within a
    key (or its ties interchangeable). `number` adds the row number from 1.
    """
    if not cfg.wide:
        window = Window.partitionBy(*keys).orderBy(*order)
        new = {name: make(window) for name, make in frames.items()}
        if number:
            new[number] = F.row_number().over(window)
        return df.withColumns(new)
    placed = place(df, keys, order, cfg)
    if number:
        placed = placed.withColumn(number, (F.col(_POS) + 1).cast("int"))
    if not frames:
        return placed.drop(_POS)
    size = max(cfg.bucket_rows, before, after)
    home = F.expr(f"{_POS} div {size}")
    inside = F.col(_POS) - F.col(_HOME) * F.lit(size)
    copies = [F.col(_HOME)]
    if before:
        copies.append(F.when(inside >= size - before, F.col(_HOME) + 1))
    if after:
        copies.append(F.when((inside < after) & (F.col(_HOME) > 0), F.col(_HOME) - 1))
    window = Window.partitionBy(*keys, _BUCKET).orderBy(_POS)
    return (
        placed.withColumn(_HOME, home)
        .withColumn(_BUCKET, F.explode(F.array_compact(F.array(*copies))))
        .withColumns({name: make(window) for name, make in frames.items()})
        .filter(F.col(_BUCKET) == F.col(_HOME))
        .drop(_POS, _HOME, _BUCKET)
    )


def cumulate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column],
    cfg: Settings,
    number: str | None = None,
) -> DataFrame:
    """Running totals up to and including each row, and optionally the row number."""
    if not cfg.wide:
        window = Window.partitionBy(*keys).orderBy(*order)
        running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = {name: F.sum(col).over(running) for name, col in sums.items()}
        if number:
            new[number] = F.row_number().over(window)
        return df.withColumns(new)
    placed = place(df, keys, order, cfg).withColumn(
        _BUCKET, F.expr(f"{_POS} div {cfg.bucket_rows}")
    )
    if number:
        placed = placed.withColumn(number, (F.col(_POS) + 1).cast("int"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(_BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = placed.groupBy(*keys, _BUCKET).agg(
        *[F.sum(col).alias(f"__t_{name}") for name, col in sums.items()]
    )
    carried = materialize(
        totals.select(
            *keys,
            _BUCKET,
            *[
                F.coalesce(F.sum(f"__t_{name}").over(earlier), F.lit(0)).alias(f"__c_{name}")
                for name in sums
            ],
        ),
        "carried",
    )
    local = (
        Window.partitionBy(*keys, _BUCKET)
        .orderBy(_POS)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = placed.withColumns({name: F.sum(col).over(local) for name, col in sums.items()})
    return (
        attach(running, carried, [*keys, _BUCKET])
        .withColumns({name: F.col(name) + F.col(f"__c_{name}") for name in sums})
        .drop(_POS, _BUCKET, *[f"__c_{name}" for name in sums])
    )


def with_group_stats(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    cfg: Settings,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add whole-group aggregates to every row.

    Wide shape: aggregate with map-side combine, write the groups, join back.
    The written groups have a known size, so the planner broadcasts them when
    they are few and otherwise joins on the key, where AQE splits skewed parts.
    `source` gives the rows to aggregate when `df` is costlier to read.
    """
    if not cfg.wide:
        window = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(window) for name, agg in aggs.items()})
    groups = (source if source is not None else df).groupBy(*keys)
    stats = groups.agg(*[agg.alias(name) for name, agg in aggs.items()])
    return attach(df, materialize(stats, "groups"), keys)


def histogram(
    df: DataFrame, keys: Sequence[str], value: str, cfg: Settings
) -> tuple[DataFrame, Settings]:
    """Written counts per (key, value), and the settings its own windows should use.

    A value with few distinct values gives a small histogram, whose written size
    is known; only a large one needs the wide shapes again.
    """
    counts = materialize(
        df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "histogram"
    )
    return counts, replace(cfg, wide=scan_bytes(counts) > cfg.plain_limit_bytes)


def with_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    kinds: Mapping[str, tuple[str, bool]],
    cfg: Settings,
) -> DataFrame:
    """Add rank columns: `kinds` maps a name to (rank | dense_rank | percent_rank, descending).

    NULL sorts last when ascending and first when descending.
    """
    if not cfg.wide:
        make = {"rank": F.rank, "dense_rank": F.dense_rank, "percent_rank": F.percent_rank}
        new = {}
        for name, (kind, descending) in kinds.items():
            col = F.col(value)
            order = col.desc_nulls_first() if descending else col.asc_nulls_last()
            new[name] = make[kind]().over(Window.partitionBy(*keys).orderBy(order))
        return df.withColumns(new)
    counts, shapes = histogram(df, keys, value, cfg)
    up_to = cumulate(
        counts, keys, [F.col(value).asc_nulls_last()], {"__upto": F.col("__n")}, shapes, "__no"
    )
    spread = with_group_stats(
        settle(up_to, shapes, "running"),
        keys,
        {"__rows": F.sum("__n"), "__values": F.count(F.lit(1))},
        shapes,
    )
    below = F.col("__upto") - F.col("__n")
    above = F.col("__rows") - F.col("__upto")
    others = F.col("__rows") - F.lit(1)
    new = {}
    for name, (kind, descending) in kinds.items():
        ahead = above if descending else below
        if kind == "rank":
            new[name] = (ahead + 1).cast("int")
        elif kind == "dense_rank":
            no = F.col("__values") - F.col("__no") + 1 if descending else F.col("__no")
            new[name] = no.cast("int")
        else:
            new[name] = F.when(others > 0, ahead / others).otherwise(F.lit(0.0))
    ranks = spread.withColumns(new).select(*keys, value, *kinds)
    return attach(df, materialize(ranks, "ranks"), [*keys, value])


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Mapping[str, float],
    cfg: Settings,
) -> DataFrame:
    """Exact interpolated percentiles per group, NULL values ignored; a group of NULLs has NULL."""
    if not cfg.wide:
        return df.groupBy(*keys).agg(
            *[F.percentile(value, p).alias(name) for name, p in points.items()]
        )
    counts, shapes = histogram(df.filter(F.col(value).isNotNull()), keys, value, cfg)
    up_to = cumulate(counts, keys, [F.col(value).asc()], {"__upto": F.col("__n")}, shapes)
    known = with_group_stats(
        settle(up_to, shapes, "running"), keys, {"__rows": F.sum("__n")}, shapes
    )
    cols = []
    for name, p in points.items():
        spot = F.lit(p) * (F.col("__rows") - F.lit(1))
        low = F.min(F.when(F.col("__upto") > F.floor(spot), F.col(value)))
        high = F.min(F.when(F.col("__upto") > F.ceil(spot), F.col(value)))
        part = F.max(spot - F.floor(spot))
        cols.append((low + (high - low) * part).cast("double").alias(name))
    found = known.groupBy(*keys).agg(*cols)
    # groups of NULLs only are in no histogram
    return attach(df.select(*keys).distinct(), found, keys, "left") if keys else found


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    medians: Mapping[str, str],
    cfg: Settings,
) -> DataFrame:
    """Aggregates plus medians per group (`medians` maps a new column to a value column)."""
    if not cfg.wide:
        exact = [F.percentile(v, 0.5).alias(name) for name, v in medians.items()]
        return df.groupBy(*keys).agg(*aggs, *exact)
    out = df.groupBy(*keys).agg(*aggs)
    for name, value in medians.items():
        out = attach(out, percentiles(df, keys, value, {name: 0.5}, cfg), keys, "left")
    return out


# ---- columns built on the above -------------------------------------------


def moving_avg(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[Column],
    sizes: Mapping[str, int],
    cfg: Settings,
) -> DataFrame:
    def frame(rows: int):
        return lambda w: F.avg(value).over(w.rowsBetween(1 - rows, 0))

    return ordered(
        df,
        keys,
        order,
        {name: frame(rows) for name, rows in sizes.items()},
        cfg,
        before=max(sizes.values()) - 1,
    )


def with_versions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, cfg: Settings
) -> DataFrame:
    """Version ordinal, versions per period, previous value and change."""
    counted = with_group_stats(df, keys, {"total_versions": F.count(F.lit(1))}, cfg)
    previous = f"prev_{value}"
    return ordered(
        counted,
        keys,
        order,
        {previous: lambda w: F.lag(value).over(w)},
        cfg,
        before=1,
        number="version_number",
    ).withColumn("forecast_change_from_prev", F.col(value) - F.col(previous))


def _both_ways(value: str, ties: Sequence[Column]) -> tuple[list[Column], list[Column]]:
    col = F.col(value)
    return [col.desc_nulls_first(), *ties], [col.asc_nulls_last(), *ties]


def top_bottom(
    df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[Column], cfg: Settings
) -> DataFrame:
    """Row numbers of every row from the highest and from the lowest value of its group."""
    down, up = _both_ways(value, ties)
    first = ordered(df, keys, down, {}, cfg, number="rnk")
    return ordered(first, keys, up, {}, cfg, number="rnk_low")


def top_k(
    df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[Column], k: int
) -> DataFrame:
    """The k highest and k lowest rows of each group, marked by `side`.

    Two branches in the plain `row_number <= k` form, which Spark turns into a
    limit per task before the shuffle: a hot group sends k rows per task.
    """
    down, up = _both_ways(value, ties)
    sides = []
    for side, order in (("high", down), ("low", up)):
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn("rnk", F.row_number().over(window)).filter(F.col("rnk") <= k)
        sides.append(ranked.withColumn("side", F.lit(side)))
    return sides[0].unionByName(sides[1])

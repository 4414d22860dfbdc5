"""Joins of the layers, shaped so a hot key is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.session import materialize


def cross_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a global aggregate, which is one row by construction."""
    return df.crossJoin(F.broadcast(one_row))


def left_join_versions(
    periods: DataFrame, versions: DataFrame, key: str, spread_by: str, cfg: Settings
) -> DataFrame:
    """periods LEFT JOIN versions, where `key` is unique among periods only.

    AQE cannot split the right side of a left join, so a period with very many
    versions would be one task. In the wide shape the versions of such periods
    are salted by `spread_by`, a salt for every `cfg.bucket_rows` of them, and
    the period is repeated once per salt that really occurs. Everything else
    joins as it is. The hot periods are few by construction (rows / bucket_rows
    at most) and written, so the planner knows their size.
    """
    if not cfg.wide:
        return periods.join(versions, key, "left")
    counts = versions.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    salts = F.ceil(F.col("__n") / F.lit(cfg.bucket_rows))
    hot = materialize(
        counts.filter(F.col("__n") > cfg.bucket_rows).select(key, salts.alias("__salts")), "hot"
    )
    own = F.pmod(F.xxhash64(spread_by), F.col("__salts"))
    salted = versions.join(hot, key, "left").withColumn(
        "__salt", F.when(F.col("__salts").isNotNull(), own).otherwise(F.lit(0))
    )
    present = materialize(
        salted.filter(F.col("__salts").isNotNull()).select(key, "__salt").distinct(), "salts"
    )
    spread = periods.join(present, key, "left").withColumn(
        "__salt", F.coalesce("__salt", F.lit(0))
    )
    return spread.join(salted.drop("__salts"), [key, "__salt"], "left").drop("__salt")


def orphans(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    where: Column | None = None,
) -> DataFrame:
    """Child rows without a parent; NULL child keys pass."""
    rows = child.filter(F.col(child_key).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    parents = parent.select(F.col(parent_key).alias("__parent")).distinct()
    return rows.join(parents, rows[child_key] == parents["__parent"], "left_anti")

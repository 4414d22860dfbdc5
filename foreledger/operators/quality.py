"""Data tests. Each returns the failing rows; none means the test passed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foreledger.config import Settings
from foreledger.functions.scalars import hours_between, ntz
from foreledger.operators.joins import orphans
from foreledger.operators.windows import ordered


def _where(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.filter(where)


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values seen more than once, NULL ignored."""
    counted = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def null_counts(df: DataFrame, cols: Sequence[str], where=None) -> DataFrame:
    """NULLs per column, all columns in one pass: (column_name, failures)."""
    counts = _where(df, where).agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "failures")


def not_null(df: DataFrame, cols: Sequence[str], where=None) -> DataFrame:
    """Columns that hold NULL, with how many."""
    return null_counts(df, cols, where).filter(F.col("failures") > 0)


def accepted_values(df: DataFrame, col: str, values: Sequence, where=None) -> DataFrame:
    """Values outside the list, with their counts; NULL passes."""
    counted = _where(df, where).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def out_of_range(col: Column, lo=None, hi=None, inclusive: bool = True) -> Column:
    below = above = F.lit(False)
    if lo is not None:
        below = col < lo if inclusive else col <= lo
    if hi is not None:
        above = col > hi if inclusive else col >= hi
    return below | above


def accepted_range(
    df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True, where=None
) -> DataFrame:
    return _where(df, where).filter(out_of_range(F.col(col), lo, hi, inclusive))


relationships = orphans


def time_range(df: DataFrame, col: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    ts = F.col(col)
    reason = (
        F.when(ts < ntz(lo), F.lit("Before min_date"))
        .when(ts > ntz(hi), F.lit("After max_date"))
        .when(ts.isNull(), F.lit("NULL value"))
    )
    return df.withColumn("validation_error", reason).filter("validation_error IS NOT NULL")


def forecast_logic(ods: DataFrame) -> DataFrame:
    """Completed periods whose error exceeds 100% or whose values are not positive."""
    forecast, actual = F.col("forecast_intensity"), F.col("actual_intensity")
    gap = F.abs(forecast - actual)
    pct = F.when(actual > 0, gap * F.lit(100.0) / actual)
    done = ods.filter((F.col("data_status") == "completed") & actual.isNotNull())
    reason = (
        F.when(pct > 100, F.lit("Forecast error too high (> 100%)"))
        .when(forecast <= 0, F.lit("Invalid forecast value"))
        .when(actual <= 0, F.lit("Invalid actual value"))
    )
    return done.select(
        "period_key",
        "data_from_dttm",
        forecast,
        actual,
        gap.alias("absolute_error"),
        pct.alias("error_percent"),
        reason.alias("failure_reason"),
    ).filter(F.col("failure_reason").isNotNull())


def freshness(
    df: DataFrame, ts: str, as_of: dt.datetime, warn_hours: float = 2, error_hours: float = 4
) -> DataFrame:
    """One row: newest load, its age, pass / warn / error, and staleness (no rows is stale)."""
    age = hours_between(F.col("latest"), ntz(as_of))
    status = (
        F.when(F.col("latest").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return df.agg(F.max(ts).alias("latest")).select(
        "latest",
        age.alias("hours_old"),
        status.alias("status"),
        (F.col("latest").isNull() | (age > warn_hours)).alias("is_stale"),
    )


def expression(df: DataFrame, predicate: str, where=None) -> DataFrame:
    """Rows for which a predicate is not true; unknown passes."""
    return _where(df, where).filter(~F.expr(predicate))


def sequential(
    df: DataFrame,
    col: str,
    keys: Sequence[str],
    step: int,
    cfg: Settings,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Rows whose value is not the previous one plus `step`."""
    out = ordered(
        df,
        keys,
        [F.col(col).asc(), *ties],
        {"previous": lambda w: F.lag(col).over(w)},
        cfg,
        before=1,
    )
    return out.filter(F.col(col) != F.col("previous") + step)


# ---- running a list of checks ---------------------------------------------


@dataclass(frozen=True)
class RowCheck:
    """A test on single rows: `fails` is true on a failing row."""

    test: str
    column: str
    fails: Column
    severity: str = "warn"


@dataclass(frozen=True)
class FrameCheck:
    """A test that needs its own plan; each row of `failing` is one failure."""

    test: str
    column: str
    failing: DataFrame
    severity: str = "warn"


def null_check(col: str, where: Column | None = None) -> RowCheck:
    fails = F.col(col).isNull()
    return RowCheck("not_null", col, fails if where is None else fails & where)


def values_check(col: str, values: Sequence, where: Column | None = None) -> RowCheck:
    fails = F.col(col).isNotNull() & ~F.col(col).isin(list(values))
    return RowCheck("accepted_values", col, fails if where is None else fails & where)


def range_check(col: str, lo=None, hi=None, where: Column | None = None) -> RowCheck:
    fails = out_of_range(F.col(col), lo, hi)
    return RowCheck("accepted_range", col, fails if where is None else fails & where)


def run_checks(
    df: DataFrame, row_checks: Sequence[RowCheck], frame_checks: Sequence[FrameCheck] = ()
) -> DataFrame:
    """(test, column_name, severity, failures), every row test of the table in one scan."""
    counts = df.agg(
        *[F.count(F.when(c.fails, 1)).alias(f"c{i}") for i, c in enumerate(row_checks)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c.test).alias("test"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, c in enumerate(row_checks)
        ]
    )
    results = [counts.select(F.inline(entries))] if row_checks else []
    for c in frame_checks:
        results.append(
            c.failing.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.test).alias("test"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.severity).alias("severity"),
                "failures",
            )
        )
    return reduce(DataFrame.unionByName, results)

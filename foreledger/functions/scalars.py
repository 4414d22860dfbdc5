"""Scalar columns: text, time, categories, forecast error."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from foreledger.config import (
    DAY_NAMES,
    HORIZON_BAND_REST,
    HORIZON_BANDS,
    HORIZON_CATEGORIES,
    HORIZON_CATEGORY_REST,
    OPEN_END,
    Settings,
)

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


# ---- text ------------------------------------------------------------------


def norm(text: Column) -> Column:
    return F.lower(F.trim(text))


def map_labels(text: Column, mapping: Mapping, default=None) -> Column:
    found = None
    for label, value in mapping.items():
        hit = text == F.lit(label)
        found = F.when(hit, F.lit(value)) if found is None else found.when(hit, F.lit(value))
    return found.otherwise(F.lit(default))


def bands(value: Column, test: str, steps: Iterable[tuple], rest=None) -> Column:
    """First label whose bound passes `value <test> bound`, else `rest`."""
    compare = _COMPARE[test]
    found = None
    for bound, label in steps:
        hit = compare(value, F.lit(bound))
        found = F.when(hit, F.lit(label)) if found is None else found.when(hit, F.lit(label))
    return found.otherwise(F.lit(rest))


def surrogate_key(*cols: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("_null_")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# ---- time ------------------------------------------------------------------


def ntz(value) -> Column:
    """Zone-less timestamp literal or cast."""
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(60_000_000.0)


def hours_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(3_600_000_000.0)


def truncate(ts: Column, unit: str) -> Column:
    return ntz(F.date_trunc(unit, ts))


def floor_to(ts: Column, seconds: int) -> Column:
    """Start of the fixed period that holds `ts`."""
    whole = F.unix_seconds(ts.cast("timestamp"))
    return ntz(F.timestamp_seconds(whole - F.pmod(whole, F.lit(seconds))))


def feed_ts(text: Column) -> Column:
    """`2025-12-21T10:00Z` -> zone-less time; NULL when malformed."""
    return ntz(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mmX")))


def iso_weekday(ts: Column) -> Column:
    return F.weekday(ts) + F.lit(1)


def day_name(ts: Column, padded: bool = False) -> Column:
    name = F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), iso_weekday(ts))
    return F.rpad(name, 9, " ") if padded else name


def calendar(ts: Column, padded: bool = False) -> dict[str, Column]:
    return {
        "data_date": F.to_date(ts),
        "data_year": F.year(ts),
        "data_month": F.month(ts),
        "data_day": F.dayofmonth(ts),
        "data_hour": F.hour(ts),
        "data_day_of_week": day_name(ts, padded),
        "data_day_of_week_num": iso_weekday(ts),
    }


def time_of_day(ts: Column) -> Column:
    hour = F.hour(ts)
    steps = ((6, "night"), (12, "morning"), (18, "afternoon"), (23, "evening"))
    return bands(hour, "<", steps, "night")


def day_type(ts: Column) -> Column:
    return F.when(iso_weekday(ts) >= 6, F.lit("weekend")).otherwise(F.lit("weekday"))


def date_text(day: Column) -> Column:
    return F.date_format(day, "dd.MM.yyyy")


def week_of_month(day: Column) -> Column:
    """1 for the first seven days of the month and so on, as text."""
    return F.ceil(F.dayofmonth(day) / F.lit(7)).cast("int").cast("string")


# ---- versions --------------------------------------------------------------


def is_current(valid_to: Column, open_end=OPEN_END) -> Column:
    return valid_to == ntz(open_end)


def data_status(actual: Column, start: Column, as_of) -> Column:
    return (
        F.when(actual.isNotNull(), F.lit("completed"))
        .when(start <= ntz(as_of), F.lit("in_progress"))
        .otherwise(F.lit("future"))
    )


def horizon_category(hours: Column) -> Column:
    return bands(hours, "<", HORIZON_CATEGORIES, HORIZON_CATEGORY_REST)


def horizon_band(hours: Column) -> Column:
    return bands(hours, "<", HORIZON_BANDS, HORIZON_BAND_REST)


# ---- forecast against actual ----------------------------------------------


def share(part: Column, whole: Column, digits: int) -> Column:
    """`part` in percent of `whole`, rounded; NULL unless `whole` is positive.

    Multiplying first keeps integer inputs exact up to the one division.
    """
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, digits))


def err(forecast: Column, actual: Column) -> Column:
    return forecast - actual


def err_pct(forecast: Column, actual: Column, digits: int = 2) -> Column:
    return share(forecast - actual, actual, digits)


def error_metrics(forecast: Column, actual: Column) -> dict[str, Column]:
    gap = forecast - actual
    ape = F.when(actual > 0, F.abs(gap) * F.lit(100.0) / actual)
    return {
        "error": gap,
        "absolute_error": F.abs(gap),
        "squared_error": gap.cast("double") * gap,
        "absolute_percentage_error": ape,
        # greatest() skips NULL, so the NULL case is kept apart
        "accuracy_percentage": F.when(ape.isNotNull(), F.greatest(F.lit(0.0), F.lit(100.0) - ape)),
    }


def direction(forecast: Column, actual: Column) -> Column:
    return (
        F.when(forecast > actual, F.lit("overestimated"))
        .when(forecast < actual, F.lit("underestimated"))
        .otherwise(F.lit("exact"))
    )


def is_accurate(actual: Column, pct: Column, within: int) -> Column:
    return actual.isNotNull() & F.coalesce(F.abs(pct) <= within, F.lit(False))


# ---- categories, flags, trends --------------------------------------------


def intensity_category(value: Column, cfg: Settings) -> Column:
    steps = (
        (cfg.very_high, "very_high"),
        (cfg.high, "high"),
        (150, "moderate"),
        (100, "low"),
    )
    return bands(value, ">=", steps, "very_low")


def cleanliness(value: Column, cfg: Settings) -> Column:
    return (
        F.when(value < 100, F.lit("green_energy"))
        .when(value.between(100, cfg.high), F.lit("moderate_impact"))
        .when(value > cfg.very_high, F.lit("high_carbon"))
        .otherwise(F.lit("standard"))
    )


def is_peak(value: Column, part_of_day: Column, kind_of_day: Column, cfg: Settings) -> Column:
    flag = (
        (value > cfg.high)
        & part_of_day.isin("morning", "afternoon")
        & (kind_of_day == "weekday")
    )
    return F.coalesce(flag, F.lit(False))


def trend(short: Column, long: Column, words, tolerance: float = 0.05) -> Column:
    up, down, level = words
    return (
        F.when(short > long * F.lit(1 + tolerance), F.lit(up))
        .when(short < long * F.lit(1 - tolerance), F.lit(down))
        .otherwise(F.lit(level))
    )


def volatility(low: Column, high: Column) -> Column:
    return share(high - low, high, 2)


def is_outlier(percentile: Column) -> Column:
    return F.coalesce((percentile >= 95) | (percentile <= 5), F.lit(False))


def z_score(value: Column, mean: Column, spread: Column) -> Column:
    return F.when(spread > 0, (value - mean) / spread).otherwise(F.lit(0.0))


def anomaly_cols(z: Column, percentile: Column) -> dict[str, Column]:
    return {
        "is_statistical_anomaly": F.coalesce(F.abs(z) > 2, F.lit(False)),
        "intensity_anomaly_type": F.when(percentile > 95, F.lit("unusually_high"))
        .when(percentile < 5, F.lit("unusually_low"))
        .otherwise(F.lit("normal")),
    }


def saving(value: Column, best: Column, mean: Column, kwh: float) -> Column:
    return F.when(mean > 0, F.round((value - best) * F.lit(kwh), 2))

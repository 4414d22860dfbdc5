"""Edge values of the scalar columns."""

import datetime as dt

from pyspark.sql import functions as F

from foreledger.config import FORECAST_QUALITY, TREND_WORDS
from foreledger.functions import scalars as S
from foreledger.operators.quality import time_range
from foreledger.plans.staging import stg_current
from foreledger.sources.feed import flatten, parse_feed, require_some
from foreledger.streaming.ingest import RAW_SCHEMA

T = dt.datetime


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def lit(value, kind):
    return F.lit(value).cast(kind)


def test_error_metrics(spark):
    def metrics(f, a):
        cols = S.error_metrics(lit(f, "int"), lit(a, "int"))
        return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()

    assert metrics(110, 100)["absolute_percentage_error"] == 10
    assert metrics(110, 100)["accuracy_percentage"] == 90
    assert metrics(500, 100)["accuracy_percentage"] == 0
    zero = metrics(5, 0)
    assert zero["absolute_percentage_error"] is None and zero["accuracy_percentage"] is None
    assert metrics(5, None)["error"] is None


def test_error_pct_rounds_half_up(spark):
    assert one(spark, S.err_pct(lit(801, "int"), lit(800, "int"))) == 0.13
    assert one(spark, S.err_pct(lit(799, "int"), lit(800, "int"))) == -0.13
    assert one(spark, S.err_pct(lit(7, "int"), lit(0, "int"))) is None


def test_quality_above_the_last_bound_has_no_word(spark):
    words = [one(spark, S.bands(F.lit(v), "<=", FORECAST_QUALITY)) for v in (5, 6, 9999, 10000)]
    assert words == ["excellent", "good", "poor", None]


def test_unknown_values_of_bands(spark, cfg):
    none = lit(None, "int")
    assert one(spark, S.intensity_category(none, cfg)) == "very_low"
    assert one(spark, S.horizon_category(lit(None, "double"))) == "very_long_term"
    assert one(spark, S.cleanliness(none, cfg)) == "standard"
    assert one(spark, S.is_peak(none, F.lit("morning"), F.lit("weekday"), cfg)) is False
    assert one(spark, S.trend(lit(None, "double"), F.lit(1.0), TREND_WORDS)) == "stable"


def test_cleanliness_edges(spark, cfg):
    got = [one(spark, S.cleanliness(F.lit(v), cfg)) for v in (99, 100, 200, 201, 300, 301)]
    assert got == [
        "green_energy",
        "moderate_impact",
        "moderate_impact",
        "standard",
        "standard",
        "high_carbon",
    ]


def test_parts_of_the_day(spark):
    def part(hour):
        return one(spark, S.time_of_day(S.ntz(T(2024, 1, 1, hour))))

    assert [part(h) for h in (5, 6, 11, 12, 17, 18, 22, 23, 0)] == [
        "night",
        "morning",
        "morning",
        "afternoon",
        "afternoon",
        "evening",
        "evening",
        "night",
        "night",
    ]


def test_week_edges(spark):
    sunday, monday = S.ntz(T(2024, 1, 7, 23, 30)), S.ntz(T(2024, 1, 8))
    assert one(spark, S.day_type(sunday)) == "weekend"
    assert one(spark, S.day_type(monday)) == "weekday"
    assert one(spark, S.day_name(sunday)) == "Sunday"
    assert one(spark, S.day_name(monday, padded=True)) == "Monday   "
    assert one(spark, S.truncate(sunday, "week")) == T(2024, 1, 1)
    weeks = [one(spark, S.week_of_month(F.lit(dt.date(2024, 1, d)))) for d in (1, 7, 8, 31)]
    assert weeks == ["1", "1", "2", "5"]


def test_feed(spark):
    docs = [
        (
            '{"data":[{"from":"2025-12-21T10:00Z","to":"2025-12-21T10:30Z",'
            '"intensity":{"forecast":266,"actual":null,"index":"moderate"}},'
            '{"from":"2025-12-21T10:30Z","to":"2025-12-21T11:00Z"},'
            '{"from":"yesterday","to":"2025-12-21T11:00Z","intensity":{}}]}',
        ),
        ("no json",),
    ]
    df = spark.createDataFrame(docs, "body string")
    good, bad = parse_feed(df, "body")
    row = require_some(good).first()
    assert (row["from"], row.intensity.forecast) == (T(2025, 12, 21, 10), 266)
    assert (good.count(), bad.count()) == (1, 3)
    flat = flatten(good.withColumn("created_at", S.ntz(T(2025, 12, 21)))).first()
    assert flat.index_forecast == flat.index_actual == "moderate"


def test_staging_drops_insane_rows(spark, cfg):
    open_end = T(5999, 1, 1)

    def row(n, minutes, forecast, actual):
        start = T(2024, 1, 1)
        end = start + dt.timedelta(minutes=minutes)
        return (n, start, end, forecast, actual, " HIGH ", "High", start, open_end, start, start)

    rows = [
        row(1, 30, 100, None),
        row(2, 0, 100, None),
        row(3, 90, 100, None),
        row(4, 30, None, 5),
        row(5, 30, 100, -1),
        row(6, 60, 0, 0),
    ]
    stg = stg_current(spark.createDataFrame(rows, RAW_SCHEMA), cfg)
    assert sorted(r.id for r in stg.collect()) == [1, 6]
    assert {r.index_forecast for r in stg.collect()} == {"high"}


def test_time_range_reports_null(spark):
    df = spark.createDataFrame(
        [(T(2019, 1, 1),), (T(2024, 1, 1),), (T(2031, 1, 1),), (None,)], "t timestamp_ntz"
    )
    bad = time_range(df, "t", T(2020, 1, 1), T(2030, 12, 31))
    assert sorted(r.validation_error for r in bad.collect()) == [
        "After max_date",
        "Before min_date",
        "NULL value",
    ]

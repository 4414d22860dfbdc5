"""Settings and the fixed values of the data model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from foreledger.session import scan_bytes

# ---- fixed values: they decide results and must not change -----------------

# open end of a version that is still valid
OPEN_END = dt.datetime(5999, 1, 1)

# spelled category of the feed -> number
INDEX_NUMBERS = {"very low": 1, "low": 2, "moderate": 3, "high": 4, "very high": 5}

# intensity categories, from clean to dirty
CATEGORIES = ("very_low", "low", "moderate", "high", "very_high")

# Monday first
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# parts of the day in reporting order
DAY_PARTS = ("night", "morning", "afternoon", "evening")

# upper bound in hours -> horizon category, and the one above all bounds
HORIZON_CATEGORIES = (
    (1, "immediate"),
    (6, "short_term"),
    (12, "medium_term"),
    (24, "long_term"),
)
HORIZON_CATEGORY_REST = "very_long_term"

# upper bound in hours -> horizon band of the error average
HORIZON_BANDS = ((1, "< 1h"), (6, "1-6h"), (12, "6-12h"), (24, "12-24h"))
HORIZON_BAND_REST = "24h+"

# largest absolute error -> quality word
FORECAST_QUALITY = ((5, "excellent"), (10, "good"), (20, "acceptable"), (9999, "poor"))
DAILY_QUALITY = (
    (5, "Отличное"),
    (10, "Хорошее"),
    (20, "Приемлемое"),
    (9999, "Требует улучшения"),
)

# category -> advice on consumption
RECOMMENDATIONS = {
    "very_low": "Отличное время для энергопотребления",
    "low": "Хорошее время для энергопотребления",
    "moderate": "Умеренное время для энергопотребления",
    "high": "По возможности отложите энергопотребление",
    "very_high": "Избегайте энергопотребления",
}
NO_RECOMMENDATION = "Нет данных"

# day mean below the bound -> advice of the day
DAILY_ADVICE = (
    (150, "Отличный день для энергопотребления! Низкая углеродная интенсивность."),
    (200, "Хороший день для обычного энергопотребления."),
    (250, "Умеренная углеродная интенсивность. Рассмотрите оптимизацию потребления."),
)
DAILY_ADVICE_REST = (
    "Высокая углеродная интенсивность. "
    "Рекомендуется отложить энергоемкие задачи на другие дни."
)

# labels of a trend: up, down, level
TREND_WORDS = ("rising", "falling", "stable")
DAILY_TREND_WORDS = ("Растущий", "Снижающийся", "Стабильный")

# pieces of the "hour (value)" text of the day report
HOUR_MARK = "ч"
UNIT_TEXT = "gCO₂/kWh"

# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """What a run may vary. `as_of` stands in for the clock, so runs can be repeated."""

    as_of: dt.datetime
    start_date: dt.datetime = dt.datetime(2020, 1, 1)
    high: int = 200
    very_high: int = 300
    accurate_within_pct: int = 10
    lookback_days: int = 7
    mart_days: int = 90
    consumption_kwh: float = 1.0
    # K3: the analytics mart repeats a period once per version unless this is set
    latest_version_only: bool = False
    # K8: blank-padded day names, as a fixed-width formatter writes them
    padded_day_names: bool = False
    # K4: windows of an append see the new rows only, as in a plain append load
    windows_restart_per_load: bool = False
    # columns that a load may add to or drop from its table: fail, sync_all_columns
    schema_policy: str = "fail"
    # the declared row tests of a layer are counted while it is written
    test_writes: bool = True
    # monitors (volume, freshness, dimension, column)
    history_buckets: int = 14
    min_history: int = 7
    sigmas: float = 3.0
    # distributed window shapes: used when the source is larger than the limit
    wide: bool = False
    plain_limit_bytes: int = 256 << 20
    # the same for windows whose few keys (version kinds, bands, weeks) share all rows: a key
    # grows with the source, and a packed file may hold a row in less than five bytes
    wide_few_keys: bool = False
    few_keys_limit_bytes: int = 4 << 20
    bucket_rows: int = 500_000
    # range partitions at least; sized_by sets it so that one holds some 2 GB
    min_parts: int = 1

    def sized_by(self, source: DataFrame) -> "Settings":
        """Choose the window shapes by the size of the source that feeds the run."""
        size = scan_bytes(source)
        return replace(
            self,
            wide=self.wide or size > self.plain_limit_bytes,
            wide_few_keys=self.wide_few_keys or size > self.few_keys_limit_bytes,
            min_parts=max(self.min_parts, size >> 31),
        )

    def few_keys(self) -> "Settings":
        """The settings for windows whose few keys share all rows."""
        return replace(self, wide=self.wide or self.wide_few_keys)

"""Versions kept in streaming state, one state per period.

The state of a period is what was delivered for it, keyed by the delivery's time, so
replays and rows in any order leave the same state. When the watermark says that no
revision of the period can come any more, a timer gives out its versions and clears the
state: it holds the periods that are still open, not the history.

Needs the RocksDB state store (`use_rocksdb`), which keeps state outside the heap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from foreledger.config import OPEN_END
from foreledger.functions.scalars import ntz, truncate
from foreledger.operators.versioning import KEYS, RAW_COLUMNS, TRACKED

_OPENED = """data_from_dttm timestamp_ntz, data_to_dttm timestamp_ntz, id bigint,
    forecast_intensity int, actual_intensity int, index_forecast string, index_actual string,
    made bigint, following bigint"""
_STAMP = "made bigint, id bigint"
_VALUE = "forecast_intensity int, actual_intensity int, index_forecast string, index_actual string"
_WHOLE = ("forecast_intensity", "actual_intensity")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


class PeriodVersions(StatefulProcessor):
    """Deliveries of one period until it is final, then the rows that open its versions."""

    def __init__(self, retention_ms: int):
        self.retention_ms = retention_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.given = handle.getMapState("given", _STAMP, _VALUE)

    def handleInputRows(self, key, rows, timerValues):
        fresh = not self.given.exists()
        for part in rows:
            for row in part.itertuples(index=False):
                value = tuple(_plain(getattr(row, c), c) for c in TRACKED)
                self.given.updateValue((int(row.made), int(row.id)), value)
        if fresh:
            self.handle.registerTimer(_millis(key[1]) + self.retention_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        opened, before = [], None
        for stamp, value in sorted((tuple(s), tuple(v)) for s, v in self.given.iterator()):
            if value != before:
                opened.append((*stamp, value))
            before = value
        self.given.clear()
        ends = [o[0] for o in opened[1:]] + [None]
        columns = {
            KEYS[0]: [key[0]] * len(opened),
            KEYS[1]: [key[1]] * len(opened),
            "id": [o[1] for o in opened],
            **{c: [o[2][i] for o in opened] for i, c in enumerate(TRACKED)},
            "made": [o[0] for o in opened],
            "following": ends,
        }
        out = pd.DataFrame(columns)
        for name in (*_WHOLE, "following"):
            out[name] = out[name].astype("Int64")
        yield out

    def close(self) -> None:
        pass


def _plain(value, name: str):
    if value is None or value != value:
        return None
    return int(value) if name in _WHOLE else str(value)


def _millis(at) -> int:
    import pandas as pd

    return pd.Timestamp(at).value // 1_000_000


def versions_stream(log: DataFrame, retention_hours: int, delay: str) -> DataFrame:
    """Final versions of each period, as `scd2_from_log` gives them, appended once.

    `log` is a stream of observations (id, KEYS, TRACKED, created_at). A period is final
    `retention_hours` after its end. Observations made later than that are left out here
    (`operators.timeline` puts them into the stored table), and so are those more than
    `delay` behind the newest one.
    """
    limit = F.col(KEYS[1]) + F.make_interval(hours=F.lit(retention_hours))
    rows = (
        log.filter(F.col("created_at") <= limit)
        .withColumn("__at", F.col("created_at").cast("timestamp"))
        .withWatermark("__at", delay)
        .withColumn("made", F.unix_micros("__at"))
    )
    opened = rows.groupBy(*KEYS).transformWithStateInPandas(
        PeriodVersions(retention_hours * 3_600_000), _OPENED, "Append", "EventTime"
    )
    made, following = (ntz(F.timestamp_micros(F.col(c))) for c in ("made", "following"))
    begin = truncate(made, "second")
    end = F.greatest(truncate(following, "second") - F.expr("INTERVAL '1' SECOND"), begin)
    return opened.select(
        "*",
        begin.alias("valid_from_dttm"),
        F.when(F.col("following").isNull(), ntz(OPEN_END)).otherwise(end).alias("valid_to_dttm"),
        made.alias("src_processed_dttm"),
        begin.alias("processed_dttm"),
    ).select(*RAW_COLUMNS)

"""Data tests inside the write of a table.

The row tests of a layer are counted by the tasks that write its rows, so they cost no
scan. The counts are observed above the last shuffle, in the stage that writes: a
repeated task of that stage is counted once, where one below the shuffle might not be.
The results are known before the load is published. They are kept in a table, and a
failing test of severity `error` stops the load: readers go on with the state before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foreledger.operators.quality import RowCheck

RESULTS = """run_at timestamp_ntz, layer string, test string, column_name string,
    severity string, failures bigint, tested bigint, published boolean"""


class TestsFailed(ValueError):
    """A load was not published, because tests of severity `error` failed."""

    __test__ = False


@dataclass(frozen=True)
class Audit:
    """The row tests of one write, and where their results are kept."""

    layer: str
    checks: Sequence[RowCheck]
    results: str
    at: dt.datetime
    seen: Observation = field(default_factory=Observation)

    def watch(self, rows: DataFrame) -> DataFrame:
        counts = [F.count(F.when(c.fails, 1)).alias(f"c{i}") for i, c in enumerate(self.checks)]
        return rows.observe(self.seen, F.count(F.lit(1)).alias("tested"), *counts)

    def settle(self, spark: SparkSession) -> None:
        """Keep the results of the write just done; raise if the load must not be published."""
        found = self.seen.get
        failures = [int(found.get(f"c{i}", 0)) for i in range(len(self.checks))]
        stop = [
            f"{c.test}({c.column}): {n}"
            for c, n in zip(self.checks, failures)
            if n and c.severity == "error"
        ]
        tested = int(found.get("tested", 0))
        rows = [
            (self.at, self.layer, c.test, c.column, c.severity, n, tested, not stop)
            for c, n in zip(self.checks, failures)
        ]
        # a row per test; one file, which is there whole or not at all
        kept = spark.createDataFrame(rows, RESULTS).coalesce(1)
        kept.write.mode("append").parquet(self.results)
        if stop:
            raise TestsFailed(f"{self.layer} not published: {', '.join(stop)}")


def results(spark: SparkSession, path: str) -> DataFrame:
    """All results kept so far."""
    return spark.read.schema(RESULTS).parquet(path)


def newly_failing(kept: DataFrame) -> DataFrame:
    """Tests that fail in their latest run and passed, or were not there, in the one before."""
    keys = ["layer", "test", "column_name"]
    lines = F.sort_array(F.collect_list(F.struct("run_at", "failures")), asc=False)
    runs = kept.groupBy(*keys).agg(F.slice(lines, 1, 2).alias("runs"))
    now, before = F.get("runs", 0), F.get("runs", 1)
    fresh = (now["failures"] > 0) & (F.coalesce(before["failures"], F.lit(0)) == 0)
    return runs.filter(fresh).select(*keys, now["run_at"].alias("run_at"), now["failures"].alias("failures"))

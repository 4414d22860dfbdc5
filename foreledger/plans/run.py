"""The layers over one folder of tables, each built on first use."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from foreledger.config import Settings
from foreledger.operators.versioning import scd2_from_log
from foreledger.plans.dwh import fact, fact_base, forecast_accuracy
from foreledger.plans.marts import analytics, daily_report
from foreledger.plans.ods import daily_summary, ods_enrich
from foreledger.plans.staging import stg_current, stg_history
from foreledger.session import materialize
from foreledger.sources.series import observations
from foreledger.sources.tables import read_table

AS_OF = dt.datetime(2024, 2, 1)


class Run:
    def __init__(self, spark: SparkSession, folder: str, cfg: Settings | None = None):
        self.spark = spark
        self.folder = folder
        self._cfg = cfg

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    @cached_property
    def cfg(self) -> Settings:
        if self._cfg:
            return self._cfg
        conf = self.spark.conf
        asked = Settings(
            as_of=AS_OF,
            wide=conf.get("spark.foreledger.wide", "false") == "true",
            bucket_rows=int(conf.get("spark.foreledger.bucketRows", "500000")),
        )
        return asked.sized_by(self.events)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def log(self) -> DataFrame:
        return observations(self.events)

    @cached_property
    def raw(self) -> DataFrame:
        return scd2_from_log(self.log, self.cfg)

    @cached_property
    def stg(self) -> DataFrame:
        return stg_current(self.raw, self.cfg)

    @cached_property
    def history(self) -> DataFrame:
        return stg_history(self.raw, self.cfg)

    @cached_property
    def ods(self) -> DataFrame:
        return ods_enrich(self.stg, self.cfg)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_summary(self.ods, self.cfg)

    @cached_property
    def fact_rows(self) -> DataFrame:
        return fact_base(self.history)

    @cached_property
    def fact(self) -> DataFrame:
        return fact(self.history, self.cfg)

    @cached_property
    def accuracy(self) -> DataFrame:
        return forecast_accuracy(self.fact, self.cfg)

    @cached_property
    def mart(self) -> DataFrame:
        return analytics(self.ods, self.accuracy, self.cfg)

    @cached_property
    def stored_mart(self) -> DataFrame:
        """The mart as a written table, for plans that read it several times."""
        return materialize(self.mart, "mart")

    @cached_property
    def report(self) -> DataFrame:
        return daily_report(self.stored_mart, self.cfg)

"""Named queries: a column spec and a plan for each, over a `Run`.

The spec lists the output columns; `i:` marks integers (given as bigint), `f:`
doubles (rounded to six places), `t:` values given as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from foreledger.plans.run import Run


@dataclass(frozen=True)
class Query:
    spec: str
    plan: Callable[[Run], DataFrame]

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return shape(self.plan(Run(spark, folder)), self.spec)


# adding zero turns -0.0 into 0.0
_SHAPES = {
    "": "`{0}`",
    "i": "CAST(`{0}` AS BIGINT) AS `{0}`",
    "f": "ROUND(CAST(`{0}` AS DOUBLE), 6) + 0.0D AS `{0}`",
    "t": "CAST(`{0}` AS STRING) AS `{0}`",
}


def shape(df: DataFrame, spec: str) -> DataFrame:
    parts = [item.rpartition(":") for item in spec.split()]
    return df.selectExpr(*[_SHAPES[kind].format(name) for kind, _, name in parts])


QUERIES: dict[str, Query] = {}


def query(name: str, spec: str):
    """Register a plan under a name."""

    def keep(plan: Callable[[Run], DataFrame]) -> Callable[[Run], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(" ".join(spec.split()), plan)
        return plan

    return keep

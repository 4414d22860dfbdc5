"""DuckDB spellings of the registered queries, for the correctness check only."""

from __future__ import annotations

from foreledger.plans.registry import QUERIES
from oracles import checks, layers, loads, mart
from oracles.sql import query


def build() -> dict[str, str]:
    bodies = layers.BODIES | loads.BODIES | checks.BODIES | mart.BODIES
    return {
        name: query(QUERIES[name].spec, reads, body) for name, (reads, body) in bodies.items()
    }

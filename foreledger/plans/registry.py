"""All registered queries."""

from foreledger.plans import (  # noqa: F401
    check_queries,
    layer_queries,
    load_queries,
    mart_queries,
)
from foreledger.plans.catalog import QUERIES

__all__ = ["QUERIES"]

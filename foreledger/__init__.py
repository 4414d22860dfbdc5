"""Versioned forecast-vs-actual analytics over half-hour (or any) intervals, on Spark."""

from foreledger.config import Settings

__all__ = ["Settings"]

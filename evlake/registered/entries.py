"""Every registered query, next to the SQL another engine checks it with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def micros(column: str) -> "F.Column":
    """A timestamp column as a number, printed the same everywhere."""
    return F.unix_micros(column).alias(f"{column}_us")

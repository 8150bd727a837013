"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a query function under its own name."""
    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_views(oracle)
        return fn

    return register


def any_of(text: str, words: list[str]) -> str:
    """SQL test for any of the words in a text."""
    return "(" + " OR ".join("contains({}, '{}')".format(text, w.replace("'", "''")) for w in words) + ")"

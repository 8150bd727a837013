"""All registered queries."""

from workload import entities, indexed, pages, reports, sources, texts  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

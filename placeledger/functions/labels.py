"""Business-profile labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from placeledger.fixed_values import PROFILE_LABEL_OTHER, PROFILE_LABELS, SALON_TYPE_BY_PROFILE
from placeledger.functions.text import col


def _lookup(c: Column | str, table: dict[str, str], other: str) -> Column:
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    return F.coalesce(F.element_at(pairs, col(c)), F.lit(other))


def salon_type(profile: Column | str) -> Column:
    return _lookup(profile, SALON_TYPE_BY_PROFILE, "unknown")


def profile_label(profile: Column | str) -> Column:
    return _lookup(profile, PROFILE_LABELS, PROFILE_LABEL_OTHER)

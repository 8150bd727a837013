"""Additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def add_missing_columns(df: DataFrame, schema: str | StructType, defaults: dict | None = None) -> DataFrame:
    """`df` with every column of `schema`: missing ones are added, and a default also
    fills the NULLs of older rows. Extra columns stay."""
    defaults = defaults or {}
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def value(field):
        filled = F.lit(defaults.get(field.name)).cast(field.dataType)
        if field.name not in df.columns:
            return filled
        current = F.col(field.name)
        return F.coalesce(current, filled) if field.name in defaults else current

    return df.withColumns({f.name: value(f) for f in wanted.fields if f.name not in df.columns or f.name in defaults})


def union_evolved(old: DataFrame, new: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Rows of an older and a newer layout together."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.fillna(defaults) if defaults else both

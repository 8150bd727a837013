"""Many-to-one joins that survive a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(many: DataFrame, one: DataFrame, on: str | list[str], how: str = "inner", broadcast: bool = True) -> DataFrame:
    """Join `many` rows to at most one row of `one` per key.

    Adaptive execution splits a partition that a hot key has filled beyond its skew
    threshold, but only where both inputs come straight from a shuffle. `one` is usually an
    aggregate by the same key whose partitioning the planner would reuse. The second key
    column, itself derived from the key, spreads nothing; it only rules that reuse out, so
    that the small side is shuffled once more and splitting stays possible. A side that
    turns out to be small is broadcast at run time, by its measured size, instead; not where `broadcast` is false, which
    is for joins repeated so often that what goes through the driver would add up.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spread = F.pmod(F.hash(*keys), F.lit(1024))
    one = one.withColumn("_spread", spread)
    joined = many.withColumn("_spread", spread).join(one if broadcast else one.hint("merge"), [*keys, "_spread"], how)
    return joined.drop("_spread")

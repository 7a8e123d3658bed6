"""Aggregations beyond a single ``groupBy``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.columns import spread

# How the partial results of an additive measure are put together.
_FINAL = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def two_phase_agg(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]], salts: int = 16
) -> DataFrame:
    """Aggregate by key and salt, then by key: a hot key is reduced by several tasks.

    ``measures`` maps a result name to (``sum``, ``count``, ``min`` or ``max``; column).
    """
    needed = list(dict.fromkeys([*keys, *[column for _, column in measures.values()]]))
    salted = df.select(*needed).withColumn("__salt", spread(needed, salts))
    partial = salted.groupBy(*keys, "__salt").agg(
        *[_PARTIAL[kind](column).alias(name) for name, (kind, column) in measures.items()]
    )
    return partial.groupBy(*keys).agg(
        *[_FINAL[kind](name).alias(name) for name, (kind, _) in measures.items()]
    )

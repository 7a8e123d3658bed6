"""History tables (slowly changing dimensions, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.columns import moment, row_hash
from tablewright.operators.ordered import OrderedGroups

# Columns of the hash form and the end of an open row.
VALID_FROM = "effective_start"
VALID_TO = "effective_end"
IS_CURRENT = "is_current"
HASH = "record_hash"
OPEN_END = "2999-12-31 00:00:00"


def scd2_hash(
    dim: DataFrame, staging: DataFrame, keys: Sequence[str], attrs: Sequence[str], change_ts: datetime
) -> DataFrame:
    """The dimension after a load: changed rows are closed and opened anew in one pass.

    Closed rows are passed through without a shuffle. A second run with the same staging
    rows changes nothing. Staging must hold each key once.
    """
    keys, attrs = list(keys), list(attrs)
    ts_type = dim.schema[VALID_FROM].dataType
    change = moment(change_ts, ts_type)
    closed = dim.filter(~F.coalesce(F.col(IS_CURRENT), F.lit(False)))
    current = dim.filter(F.col(IS_CURRENT))

    # Open rows and staged rows meet in one aggregation by key: a single shuffle.
    old = current.select(*keys, F.struct(*dim.columns).alias("t"))
    fresh = staging.select(*keys, F.struct(*attrs, row_hash(*keys, *attrs).alias(HASH)).alias("s"))
    pairs = (
        old.unionByName(fresh, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.first("t", ignorenulls=True).alias("t"),
            F.first("s", ignorenulls=True).alias("s"),
            F.count("t").alias("open_rows"),
            F.count("s").alias("copies"),
        )
    )
    once = F.when(
        F.col("copies") > 1, F.raise_error("scd2_hash: a key occurs twice in staging").cast("boolean")
    ).when(F.col("open_rows") > 1, F.raise_error("scd2_hash: a key has two open rows").cast("boolean"))
    pairs = pairs.filter(once.otherwise(F.lit(True))).select(*keys, "t", "s")

    differs = F.col("t").isNotNull() & F.col("s").isNotNull() & ~F.col(f"t.{HASH}").eqNullSafe(F.col(f"s.{HASH}"))
    appears = F.col("t").isNull()
    types = dict(dim.dtypes)

    def old_row(column: str):
        value = F.col(f"t.`{column}`")
        if column == VALID_TO:
            value = F.when(differs, change).otherwise(value)
        elif column == IS_CURRENT:
            value = F.when(differs, F.lit(False)).otherwise(value)
        return value.cast(types[column]).alias(column)

    def new_row(column: str):
        if column in keys:
            value = F.col(column)
        elif column in attrs or column == HASH:
            value = F.col(f"s.`{column}`")
        else:
            value = {
                VALID_FROM: change,
                VALID_TO: F.lit(OPEN_END),
                IS_CURRENT: F.lit(True),
            }.get(column, F.lit(None))
        return value.cast(types[column]).alias(column)

    rows = F.array_compact(
        F.array(
            F.when(~appears, F.struct(*[old_row(c) for c in dim.columns])),
            F.when(appears | differs, F.struct(*[new_row(c) for c in dim.columns])),
        )
    )
    return closed.unionByName(pairs.select(F.inline(rows)))


def empty_dimension(staging: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """A dimension without rows, to load for the first time."""
    return staging.select(
        *keys,
        *attrs,
        F.lit(None).cast("timestamp_ntz").alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        F.lit(None).cast("boolean").alias(IS_CURRENT),
        F.lit(None).cast("string").alias(HASH),
    ).limit(0)


def scd2_as_of(dim: DataFrame, at, start: str, end: str) -> DataFrame:
    """The rows valid at a point: started, and not yet ended."""
    at = F.lit(at)  # a value or a column
    return dim.filter((F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end))))


def scd2_overlaps(dim: DataFrame, keys: Sequence[str], start: str, end: str, **sizing) -> DataFrame:
    """History rows that have not ended when the next row of their key starts.

    ``next_start`` is the start that falls into the row.
    """
    groups = OrderedGroups(dim, keys, [start, end], break_ties=True, **sizing)
    rows = groups.with_neighbour(groups.df, F.struct(F.col(start).alias("at")), "__next", ahead=True)
    rows = rows.withColumn("next_start", F.col("__next.at")).drop("__next")
    clash = F.col("next_start").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("next_start")))
    return groups.finish(rows.filter(clash))

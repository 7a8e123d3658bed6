"""Joins for small and for skewed sides."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import hashable, spread

# Fixed value: the session default for automatic broadcast.
BROADCAST_BYTES = 10 * 1024 * 1024
_SALT, _SALTS = "__salt", "__salts"
_SAMPLE_ROWS = 200_000
# Sampled rows of a key that just fills a task; hot keys at most; buckets over which NULL keys are spread.
_PER_BUDGET, _HOT_KEYS, _NULL_WAYS = 50, 100_000, 1 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as they would be broadcast, from one aggregation over them."""
    size = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = size + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            size = size + 16
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Is the table small enough to be replicated? Row counts of Parquet files cost next to nothing."""
    least = 16 * (1 + len(df.columns))
    return df.count() * least <= max_bytes and measured_bytes(df) <= max_bytes


def broadcast_join(
    left: DataFrame, right: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Replicate the right side if it measures at most ``max_bytes``, else join by shuffle."""
    if fits_broadcast(right, max_bytes):
        right = F.broadcast(right)
    return left.join(right, on, how)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float) -> list:
    """Keys that hold at least ``share`` of the rows of a sample, of which there are at most 1/share."""
    total = df.count()
    sample = df.select(*keys)
    if total > _SAMPLE_ROWS:
        sample = sample.sample(False, _SAMPLE_ROWS / total, 7)
    counted = sample.groupBy(*keys).count()
    drawn = min(total, _SAMPLE_ROWS)
    return counted.filter(F.col("count") >= max(1.0, share * drawn)).drop("count").collect()


def key_budgets(df: DataFrame, keys: Sequence[str], task_rows: int) -> list[tuple]:
    """Keys with more rows than one task should take, each with the number of tasks it needs.

    Row counts come from a sample that holds about ``_PER_BUDGET`` rows of a key of ``task_rows``
    rows. A budget below total / ``_HOT_KEYS`` is raised to it, so that at most about that many
    keys are found, whatever the table holds. NULL keys are left out.
    """
    total = df.count()
    budget = max(task_rows, total / _HOT_KEYS)
    if total <= budget:
        return []
    rows = df.select(*[F.col(f"`{k}`") for k in keys]).dropna()
    fraction = min(1.0, _PER_BUDGET / budget)
    if fraction < 1.0:
        rows = rows.sample(False, fraction, 7)
    counted = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    found = counted.filter(F.col("__n") > budget * fraction).collect()
    return [(*row[:-1], math.ceil(row["__n"] / fraction / budget)) for row in found]


def _with_salts(df: DataFrame, keys: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Add the number of salts of each row's key: 1 unless the key is a hot one."""
    if hot is None:
        return df.withColumn(_SALTS, F.lit(1))
    same = [F.col(f"`{k}`") == F.col(f"__hot_{i}") for i, k in enumerate(keys)]
    found = df.join(F.broadcast(hot), same, "left")
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(f"__hot_{len(keys)}", F.lit(1)).alias(_SALTS))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: Sequence | float | None = None,
    salts: int = 8,
    spread_by: Sequence[str] | None = None,
    task_rows: int = 1_000_000,
) -> DataFrame:
    """An inner, left, left semi or left anti join that splits the hot keys of the left side.

    A key with more than ``task_rows`` rows on the left is split into as many salts as keep each
    below that. Instead, ``hot`` may list the keys or give the share of rows that makes a key
    hot; these then have ``salts`` salts each. Only rows of the right side with a hot key are
    repeated, once per salt of the key. NULL keys, which find no partner, are spread widely.
    Salts come from the left columns, or from ``spread_by`` where reading all of them only for
    this would be a waste.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do {how!r} joins")
    keys = list(on)
    if hot is None:
        rows = key_budgets(left, keys, task_rows)
    else:
        listed = heavy_keys(left, keys, hot) if isinstance(hot, float) else hot
        listed = [tuple(h) if isinstance(h, (tuple, list)) else (h,) for h in listed]
        rows = [(*row, salts) for row in dict.fromkeys(listed) if None not in row]
    table = None
    if rows:
        fields = [T.StructField(f"__hot_{i}", left.schema[k].dataType) for i, k in enumerate(keys)]
        fields.append(T.StructField(f"__hot_{len(keys)}", T.IntegerType()))
        table = left.sparkSession.createDataFrame(rows, T.StructType(fields))
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(f"`{key}`").isNull()
    scattered = spread(list(spread_by or hashable(left)), _NULL_WAYS)
    salt = F.when(absent, scattered).otherwise(scattered % F.col(_SALTS))
    salted_left = _with_salts(left, keys, table).withColumn(_SALT, salt).drop(_SALTS)
    salted_right = _with_salts(right, keys, table)
    salted_right = salted_right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col(_SALTS) - 1))).drop(_SALTS)
    return salted_left.join(salted_right, [*keys, _SALT], how).drop(_SALT)


def touched_rows(df: DataFrame, batch: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key occurs in the batch, or with ``left_anti`` all the others.

    The keys of a small batch are replicated, so that ``df`` is not shuffled at all.
    """
    touched = batch.select(*keys).distinct()
    if fits_broadcast(touched):
        return df.join(F.broadcast(touched), list(keys), how)
    return salted_join(df, touched, keys, how)

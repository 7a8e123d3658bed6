"""Profiling: one pass over a table, however many columns it has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T


def _columns(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else df.columns


def _named(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of any numeric type, decimals of every precision included."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def category_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column the number of NULLs."""
    cols = _columns(df, cols)
    counts = df.select(*[F.count_if(_named(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], [_named(c) for c in cols], "column_name", "nulls")


def ndv_counts(df: DataFrame, cols: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """Per column the approximate number of distinct values."""
    cols = _columns(df, cols)
    counts = df.select(*[F.approx_count_distinct(_named(c), rsd).alias(c) for c in cols])
    return counts.unpivot([], [_named(c) for c in cols], "column_name", "ndv")


def quantiles(
    df: DataFrame, cols: Sequence[str] | None = None, probabilities: Sequence[float] = (0.0, 0.5, 1.0),
    rel_error: float = 0.01,
) -> DataFrame:
    """Approximate quantiles of numeric columns: one row per column and probability."""
    cols = numeric_columns(df) if cols is None else list(cols)
    points = list(probabilities)
    accuracy = int(1 / rel_error)
    sketches = df.select(
        *[F.percentile_approx(_named(c).cast("double"), points, accuracy).alias(c) for c in cols]
    )
    wide = sketches.unpivot([], [_named(c) for c in cols], "column_name", "points")
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in points]).alias("p"), F.col("points").alias("v"))
    return wide.select("column_name", F.explode(pairs).alias("q")).select(
        "column_name", F.col("q.p").alias("probability"), F.col("q.v").alias("value")
    )


def profile(
    df: DataFrame, cols: Sequence[str] | None = None, rel_error: float = 0.01, rsd: float = 0.05
) -> DataFrame:
    """Rows, NULLs, distinct values, minimum, median and maximum of each column, as text.

    Everything is one aggregation whose state per column is a counter, a sketch or a
    single value. Only numeric columns have a median; columns without an order have no extremes.
    """
    cols = _columns(df, cols)
    numeric = set(numeric_columns(df))
    accuracy = int(1 / rel_error)

    # Maps, variants and what holds them have no order.
    unordered = {f.name for f in df.schema.fields if any(k in f.dataType.simpleString() for k in ("map<", "variant"))}

    def extreme(pick, c: str) -> Column:
        return (F.lit(None) if c in unordered else pick(_named(c))).cast("string")

    def measures(c: str):
        median = F.lit(None).cast("string")
        if c in numeric:
            median = F.percentile_approx(_named(c).cast("double"), 0.5, accuracy).cast("string")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(_named(c).isNull()).alias("nulls"),
            F.approx_count_distinct(_named(c), rsd).alias("ndv"),
            extreme(F.min, c).alias("min"),
            median.alias("median"),
            extreme(F.max, c).alias("max"),
        )

    return df.agg(F.array(*[measures(c) for c in cols]).alias("columns")).select(F.inline("columns"))


def top_values(df: DataFrame, cols: Sequence[str] | None = None, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values of each text or boolean column, in one job.

    Ties are broken by value. Only the ``n`` best candidates of a task reach the ranking.
    """
    cols = category_columns(df) if cols is None else list(cols)
    long = df.select(*[_named(c).cast("string").alias(c) for c in cols]).unpivot([], [_named(c) for c in cols], "column_name", "value")
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    order = Window.partitionBy("column_name").orderBy(F.desc("row_count"), F.col("value").asc_nulls_first())
    return counted.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)

"""Cleaning and the write contract of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.columns import as_column, collapse_space, digits_only, safe_cast, safe_date
from tablewright.operators.ordered import latest
from tablewright.session import materialize


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order_by`` (a leading minus sorts descending)."""
    return latest(df, keys, order_by)


def clean(
    df: DataFrame,
    *,
    fills: Mapping[str, object] | None = None,
    text_fill: str | None = None,
    required: Sequence[str] = (),
    unique_by: Sequence[str] = (),
    unique_order: Sequence[str] = (),
    casts: Mapping[str, str] | None = None,
    dates: Mapping[str, tuple[str, str]] | None = None,
    replacements: Mapping[str, Mapping[str, str]] | None = None,
    lower: Sequence[str] = (),
    trim: Sequence[str] = (),
    digits: Sequence[str] = (),
    squeeze: Sequence[str] = (),
    keep: Sequence[Column | str] = (),
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """The usual cleaning steps in their usual order.

    Fill named columns, then all other text columns; require columns; drop copies and keep
    one row per key; convert types (text that does not fit becomes NULL); map spellings;
    tidy text; filter; drop and rename.
    """
    if fills:
        df = df.na.fill(dict(fills))
    if text_fill is not None:
        df = df.na.fill(text_fill)
    if required:
        df = df.na.drop(how="any", subset=list(required))
    if unique_by:
        df = dedup(df, unique_by, unique_order)
    else:
        df = df.dropDuplicates()
    converted = {c: safe_cast(c, t) for c, t in (casts or {}).items()}
    converted.update({target: safe_date(source, pattern) for target, (source, pattern) in (dates or {}).items()})
    if converted:
        df = df.withColumns(converted)
    for column, mapping in (replacements or {}).items():
        df = df.replace(dict(mapping), subset=[column])
    tidy = {c: F.lower(c) for c in lower}
    tidy.update({c: F.trim(F.col(c)) for c in trim})
    tidy.update({c: digits_only(c) for c in digits})
    tidy.update({c: collapse_space(c) for c in squeeze})
    if tidy:
        df = df.withColumns(tidy)
    for condition in keep:
        df = df.filter(as_column(condition))
    return df.drop(*drop).withColumnsRenamed(dict(rename or {}))


def with_defaults(df: DataFrame, defaults: Mapping[str, object], fill_nulls: bool = False) -> DataFrame:
    """Add missing columns with their default; explicit NULLs are filled only on demand."""
    present = set(df.columns)
    values = {c: v if isinstance(v, Column) else F.lit(v) for c, v in defaults.items()}
    chosen = {c: v for c, v in values.items() if c not in present}
    if fill_nulls:
        chosen.update({c: F.coalesce(F.col(c), v) for c, v in values.items() if c in present})
    return df.withColumns(chosen) if chosen else df


def with_generated(df: DataFrame, generated: Mapping[str, Column | str]) -> DataFrame:
    """Add derived columns. A supplied value that differs from the derived one is an error."""
    present = set(df.columns)

    def checked(column: str, value: Column) -> Column:
        if column not in present:
            return value
        message = F.lit(f"column {column} differs from its generation expression")
        return F.when(F.col(column).eqNullSafe(value), value).otherwise(F.raise_error(message).cast(dict(df.dtypes)[column]))

    return df.withColumns({c: checked(c, as_column(v)) for c, v in generated.items()})


def assign_identity(df: DataFrame, column: str, start: int) -> DataFrame:
    """Number rows upwards from ``start``: unique and increasing, gaps allowed.

    The numbers depend on how rows are spread over tasks, so they are written to the
    shared folder before anything reads them twice.
    """
    numbered = df.withColumn(column, F.monotonically_increasing_id() + F.lit(start).cast("bigint"))
    return materialize(numbered)

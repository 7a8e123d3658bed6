"""Safe conversions, hashing and other scalar building blocks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType


def as_column(value: Column | str) -> Column:
    """SQL text or a Column, as a Column."""
    return F.expr(value) if isinstance(value, str) else value


def moment(value: datetime, kind: DataType | str = "timestamp_ntz") -> Column:
    """A point in time as written, whatever the time zones of driver and session."""
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def holds(condition: Column | str | None) -> Column:
    """A predicate with SQL filter semantics: NULL counts as false, none at all as true."""
    if condition is None:
        return F.lit(True)
    return F.coalesce(as_column(condition), F.lit(False))


def safe_cast(column: Column | str, type_name: str) -> Column:
    """NULL in place of an error on text that does not fit the type."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast(type_name)


def safe_date(column: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(column, pattern)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def second_piece(column: Column, separator: str) -> Column:
    """The part after the first separator, NULL when there is none."""
    return F.get(F.split(column, separator), F.lit(1))


def collapse_space(column: Column | str) -> Column:
    return F.regexp_replace(column, r"\s+", " ")


def digits_only(column: Column | str) -> Column:
    return F.regexp_replace(column, r"\D", "")


def row_hash(*columns: Column | str) -> Column:
    """SHA-256 of a row.

    Each value is written as ``<bytes>:<value>`` and a NULL as ``-``, so that neither a
    NULL nor a separator inside a value can make two different rows look alike.
    """
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_fingerprint(columns: list[str]) -> Column:
    """A 64-bit fingerprint of a row, for order-free comparison of two copies of a table."""
    return F.xxhash64(*[F.col(c) for c in columns])


def hashable(df) -> list[str]:
    """The columns a hash can be taken of; maps and variants have no defined order."""
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def spread(columns: list[str], ways: int) -> Column:
    """A bucket in ``[0, ways)`` that also separates identical rows.

    Row content alone would put all copies of one row into one bucket. The task number
    is added because, unlike a random number or a row counter, it stays the same when a
    lost task is run again, whatever the order in which its input arrives.
    """
    content = F.hash(*[F.col(c) for c in columns]).cast("bigint")
    return F.pmod(content + F.spark_partition_id(), F.lit(ways)).cast("int")

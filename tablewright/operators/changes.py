"""Change logs: reading, reducing, replaying and producing row changes.

A change log is a flat table: the row, ``_change_type``, ``_commit_version`` and
``_commit_timestamp``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import moment
from tablewright.operators.merge import ALL, DELETE, merge
from tablewright.operators.ordered import latest

# Names of the metadata columns and of the kinds of change.
CHANGE_TYPE = "_change_type"
VERSION = "_commit_version"
TIMESTAMP = "_commit_timestamp"
INSERT = "insert"
UPDATE_BEFORE = "update_preimage"
UPDATE_AFTER = "update_postimage"
REMOVE = "delete"

META = [CHANGE_TYPE, VERSION, TIMESTAMP]


def read_changes(
    log: DataFrame,
    start: int | datetime | Column | None = None,
    end: int | datetime | Column | None = None,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Changes between two versions or two points in time, both bounds included."""

    def bound(value) -> tuple[str, Column]:
        if isinstance(value, datetime):
            return TIMESTAMP, moment(value, log.schema[TIMESTAMP].dataType)
        return VERSION, value if isinstance(value, Column) else F.lit(value)

    if start is not None:
        column, value = bound(start)
        log = log.filter(F.col(column) >= value)
    if end is not None:
        column, value = bound(end)
        log = log.filter(F.col(column) <= value)
    if types is not None:
        log = log.filter(F.col(CHANGE_TYPE).isin(list(types)))
    return log


def _removal_first() -> Column:
    """Inside one commit a key is removed before it is written again."""
    return F.when(F.col(CHANGE_TYPE) == REMOVE, F.lit(0)).otherwise(F.lit(1))


def net_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = (VERSION,)) -> DataFrame:
    """The last change of each key; what lies before it has no effect on the outcome."""
    effective = changes.filter(F.col(CHANGE_TYPE) != UPDATE_BEFORE)
    return latest(effective, keys, [*[F.col(o).desc() for o in order], _removal_first().desc()])


def as_of(log: DataFrame, keys: Sequence[str], at: int | datetime | None = None) -> DataFrame:
    """The table at a version or point in time (None: now), rebuilt from its log."""
    state = net_changes(read_changes(log, end=at), keys)
    return state.filter(F.col(CHANGE_TYPE) != REMOVE).drop(*META)


def _comparable(row: Column, kind: T.StructType) -> Column:
    """A row with maps as sorted entries: maps themselves cannot be compared."""

    def entries(name: str, of: T.DataType) -> Column:
        value = row.getField(name)
        return F.array_sort(F.map_entries(value)) if isinstance(of, T.MapType) else value

    if not any(isinstance(f.dataType, T.MapType) for f in kind.fields):
        return row
    return F.when(row.isNotNull(), F.struct(*[entries(f.name, f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]))


def _change_rows(pairs: DataFrame, keys: Sequence[str], columns: Sequence[str], version, ts) -> DataFrame:
    """Rows of (``old``, ``new``) structs, either of them possibly NULL, as change rows."""
    old, new, kind = F.col("old"), F.col("new"), pairs.schema["old"].dataType

    def change(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    kinds = (
        F.when(old.isNull(), F.array(change(INSERT, new)))
        .when(new.isNull(), F.array(change(REMOVE, old)))
        .otherwise(F.array(change(UPDATE_BEFORE, old), change(UPDATE_AFTER, new)))
    )
    return (
        pairs.filter(~_comparable(old, kind).eqNullSafe(_comparable(new, kind)))
        .select(*keys, F.explode(kinds).alias("c"))
        .select(
            *[F.col(c) if c in keys else F.col(f"c.row.`{c}`").alias(c) for c in columns],
            F.col("c.kind").alias(CHANGE_TYPE),
            F.lit(version).cast("bigint").alias(VERSION),
            moment(ts).alias(TIMESTAMP),
        )
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, ts: datetime) -> DataFrame:
    """The changes that turn one snapshot into the other; keys must identify rows.

    Both snapshots go through one aggregation by key: a single shuffle, NULL keys are
    compared like any other, and a key that occurs twice is reported instead of multiplied.
    Columns may be maps; inside structs and arrays there may be none.
    """
    columns = old.columns
    maps = any(isinstance(f.dataType, T.MapType) for f in old.schema.fields)
    only = F.first if maps else F.max  # one row a side, the other side's are NULL
    more = [True] if maps else []
    row = F.struct(*columns)
    both = old.select(*keys, F.lit(True).alias("was"), row.alias("row")).unionByName(
        new.select(*columns).select(*keys, F.lit(False).alias("was"), row.alias("row"))
    )
    pairs = both.groupBy(*keys).agg(
        only(F.when(F.col("was"), F.col("row")), *more).alias("old"),
        only(F.when(~F.col("was"), F.col("row")), *more).alias("new"),
        F.greatest(F.count_if(F.col("was")), F.count_if(~F.col("was"))).alias("copies"),
    )
    checked = F.when(
        F.col("copies") > 1, F.raise_error("snapshot_diff: the keys do not identify rows").cast("boolean")
    ).otherwise(F.lit(True))
    return _change_rows(pairs.filter(checked), keys, columns, version, ts)


def restore(
    log: DataFrame, keys: Sequence[str], at: int | datetime, new_version: int, ts: datetime
) -> DataFrame:
    """The changes that make an earlier state current again; to be appended to the log.

    The present and the earlier state of a key come out of the same aggregation.
    """
    columns = [c for c in log.columns if c not in META]
    effective = log.filter(F.col(CHANGE_TYPE) != UPDATE_BEFORE)
    position = F.struct(F.col(VERSION), _removal_first())
    row = F.struct(F.struct(*columns).alias("row"), (F.col(CHANGE_TYPE) == REMOVE).alias("gone"))
    if isinstance(at, datetime):
        early = F.col(TIMESTAMP) <= moment(at, log.schema[TIMESTAMP].dataType)
    else:
        early = F.col(VERSION) <= at

    def alive(state: str) -> Column:
        return F.when(~F.col(f"{state}.gone"), F.col(f"{state}.row"))

    states = effective.groupBy(*keys).agg(
        F.max_by(row, position).alias("now"),
        F.max_by(F.when(early, row), F.when(early, position)).alias("then"),
    )
    pairs = states.select(*keys, alive("now").alias("old"), alive("then").alias("new"))
    return _change_rows(pairs, keys, columns, new_version, ts)


def next_version(mark: DataFrame, name: str) -> DataFrame:
    """One row: the first version not yet processed for the named table."""
    return mark.filter(F.col("table_name") == name).agg(
        (F.coalesce(F.max("processed_version"), F.lit(0)) + 1).cast("bigint").alias("start_version")
    )


def advance_mark(mark: DataFrame, name: str, processed: DataFrame) -> DataFrame:
    """The high-water marks after a run; ``processed`` holds one row with the last version.

    Without new changes that version is NULL and the mark stays where it is.
    """
    own = F.col("table_name").eqNullSafe(F.lit(name))
    seen = mark.filter(own).select("processed_version").union(processed)
    reached = seen.agg(F.max("processed_version").cast("bigint").alias("processed_version"))
    reached = reached.filter(F.col("processed_version").isNotNull())
    return mark.filter(~own).unionByName(reached.select(F.lit(name).alias("table_name"), "processed_version"))


def apply_change_feed(
    target: DataFrame, log: DataFrame, mark: DataFrame, name: str, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Bring ``target`` up to date with everything beyond its mark.

    Returns the new target and the new marks. Write the target first: if the run ends in
    between, the same changes are applied once more, with the same outcome. The last version
    is read once, now: what the log gains before the results are computed is left to the
    next run, by the target and by the mark.
    """
    last = log.agg(F.max(VERSION)).first()[0]
    pending = read_changes(log, start=next_version(mark, name).scalar(), end=0 if last is None else last)
    net = net_changes(pending, keys)
    removed = F.col(f"s.{CHANGE_TYPE}") == REMOVE
    state = merge(
        target,
        net,
        on=keys,
        matched=[(removed, DELETE), (None, ALL)],
        not_matched=[(~removed, ALL)],
    )
    reached = log.sparkSession.createDataFrame([(last,)], "processed_version bigint")
    return state, advance_mark(mark, name, reached)

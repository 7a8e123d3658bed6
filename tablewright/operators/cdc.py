"""Change data capture: current state and history from events that may arrive in any order.

The result depends on the sequence of the events, never on their arrival. All operators
work on the retained event log; ``cdc_refresh`` limits the work to the keys of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.columns import holds
from tablewright.operators.joins import touched_rows
from tablewright.operators.ordered import OrderedGroups, latest

# The validity columns of a history table.
START = "__START_AT"
END = "__END_AT"


def _parts(sequence: str | Sequence[str]) -> list[str]:
    return [sequence] if isinstance(sequence, str) else list(sequence)


def _position(sequence: str | Sequence[str]) -> Column:
    parts = _parts(sequence)
    return F.col(parts[0]) if len(parts) == 1 else F.struct(*parts)


def _is(condition: Column | str | None) -> Column:
    return F.lit(False) if condition is None else holds(condition)


def cdc_scd1(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    delete_when: Column | str | None = None,
    truncate_when: Column | str | None = None,
    except_cols: Sequence[str] = (),
    ignore_nulls: bool = False,
) -> DataFrame:
    """The current row of each key.

    ``truncate_when`` marks events that empty the table up to their place in the
    sequence. With ``ignore_nulls`` a NULL in an update leaves the column as it was; a
    delete ends the life of a row, and values from before it do not come back.
    """
    columns = [c for c in events.columns if c not in set(except_cols)]
    position = _position(sequence)
    if truncate_when is not None:
        truncates = _is(truncate_when)
        last_truncate = events.filter(truncates).agg(F.max(position)).scalar()
        # One value, compared with each event; NULL where nothing was truncated.
        events = events.filter(~truncates).filter(last_truncate.isNull() | (position > last_truncate))
    if not ignore_nulls:
        newest = latest(events, keys, [F.col(p).desc() for p in _parts(sequence)])
        return newest.filter(~_is(delete_when)).select(*columns)

    # The last non-NULL value of a column counts if no delete follows it. Every measure is
    # a maximum, so one aggregation with map-side combining is enough.
    values = [c for c in columns if c not in keys]
    gone = _is(delete_when)

    def last_value(column: str) -> Column:
        filled = ~gone & F.col(column).isNotNull()
        return F.max(F.when(filled, F.struct(position.alias("at"), F.col(column).alias("value"))))

    lives = events.groupBy(*keys).agg(
        F.max(F.when(gone, position)).alias("__ended"),
        F.max(F.when(~gone, position)).alias("__written"),
        *[last_value(c).alias(f"__last_{c}") for c in values],
    )
    after_end = lambda at: F.col("__ended").isNull() | (at > F.col("__ended"))
    alive = lives.filter(F.col("__written").isNotNull() & after_end(F.col("__written")))
    return alive.select(
        *[
            F.col(c) if c in keys else F.when(after_end(F.col(f"__last_{c}.at")), F.col(f"__last_{c}.value")).alias(c)
            for c in columns
        ]
    )


def cdc_scd2(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    delete_when: Column | str | None = None,
    except_cols: Sequence[str] = (),
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    **sizing,
) -> DataFrame:
    """History rows with the sequence values at which they start and end (NULL: open).

    Consecutive events with equal tracked columns are one row; the other columns hold
    their last values in it. A delete ends the open row and leaves none of its own. With
    several sequence columns the bounds are structs of them.
    """
    columns = [c for c in events.columns if c not in set(except_cols)]
    values = [c for c in columns if c not in keys]
    if track is not None:
        tracked = list(track)
    elif track_except is not None:
        tracked = [c for c in values if c not in set(track_except)]
    else:
        tracked = values
    untracked = [c for c in values if c not in set(tracked)]

    parts = _parts(sequence)
    gone = _is(delete_when)
    flat = events.select(
        *keys,
        *[F.col(p).alias(f"__seq_{i}") for i, p in enumerate(parts)],
        gone.alias("__gone"),
        F.struct(*tracked, F.lit(0).alias("__")).alias("__tracked"),
        F.struct(*untracked, F.lit(0).alias("__")).alias("__rest"),
    )
    order = [f"__seq_{i}" for i in range(len(parts))]
    groups = OrderedGroups(flat, keys, order, **sizing)
    if groups.heavy_ties:
        # One event delivered very often: copies add nothing to a history.
        groups = OrderedGroups(flat.dropDuplicates([*keys, *order]), keys, order, **sizing)

    if len(parts) == 1:
        at = F.col("__seq_0")
    else:
        at = F.struct(*[F.col(o).alias(p) for o, p in zip(order, parts)])
    here = F.struct(at.alias("at"), F.col("__gone").alias("gone"), F.col("__tracked").alias("tracked"))
    rows = groups.with_neighbour(groups.df, here, "__before")
    starts = ~F.col("__gone") & (
        F.col("__before").isNull()
        | F.col("__before.gone")
        | ~F.col("__before.tracked").eqNullSafe(F.col("__tracked"))
    )
    rows = rows.withColumn("__starts", starts)

    if not untracked:
        # Only where something changes matters: each start, and each delete as an end.
        edges = rows.filter(F.col("__starts") | F.col("__gone"))
        edges = groups.with_neighbour(edges, F.struct(at.alias("at")), "__next", ahead=True)
        history = edges.filter("__starts").withColumn("__end", F.col("__next.at"))
    else:
        # The last event of a run supplies the untracked values, what follows it the end.
        rows = groups.with_neighbour(rows, here, "__after", ahead=True)
        last = ~F.col("__gone") & (
            F.col("__after").isNull()
            | F.col("__after.gone")
            | ~F.col("__after.tracked").eqNullSafe(F.col("__tracked"))
        )
        edges = rows.withColumn("__last", last).filter(F.col("__starts") | F.col("__last"))
        closing = F.struct(F.col("__rest").alias("rest"), F.col("__after.at").alias("end"))
        edges = groups.with_neighbour(edges, closing, "__next", ahead=True)
        one_event = F.col("__last")
        history = edges.filter("__starts").withColumns(
            {
                "__end": F.when(one_event, F.col("__after.at")).otherwise(F.col("__next.end")),
                "__rest": F.when(one_event, F.col("__rest")).otherwise(F.col("__next.rest")),
            }
        )

    def source(column: str) -> Column:
        if column in keys:
            return F.col(column)
        side = "__tracked" if column in set(tracked) else "__rest"
        return F.col(f"{side}.`{column}`").alias(column)

    return history.select(*[source(c) for c in columns], at.alias(START), F.col("__end").alias(END))


def cdc_refresh(
    target: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    rebuild: Callable[[DataFrame], DataFrame],
    sequence: str | Sequence[str] | None = None,
    truncate_when: Column | str | None = None,
) -> DataFrame:
    """``target`` with the keys of ``batch`` rebuilt from the log, which already holds the batch.

    ``truncate_when`` marks events that empty the table up to their place in the ``sequence``.
    Where the batch brings the last of them, all that is left is rebuilt from the events
    behind it; otherwise ``rebuild`` sees the events of the touched keys behind the last one.
    """
    if truncate_when is None:
        return touched_rows(target, batch, keys, "left_anti").unionByName(rebuild(touched_rows(log, batch, keys)))
    position, truncates = F.struct(*_parts(sequence)), _is(truncate_when)
    newest = log.filter(truncates).agg(F.max(position).alias("last"))
    last = newest.scalar()
    alive = log.filter(~truncates).filter(last.isNull() | (position > last))
    brought = batch.filter(truncates).agg(F.max(position).alias("own")).join(newest)  # one row each
    if brought.filter("own = last").count():
        return rebuild(alive)
    touched = batch.filter(~truncates)
    return touched_rows(target, touched, keys, "left_anti").unionByName(rebuild(touched_rows(alive, touched, keys)))


def cdc_validate(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    scd_type: int = 1,
    truncate_when: Column | str | None = None,
) -> DataFrame:
    """Broken rules of an event log: keys, ``violation`` and the number of events affected.

    Rules: the sequence is never NULL, events with the same key and sequence are copies of
    each other, and no truncate feeds a history.
    """
    parts = _parts(sequence)
    fingerprint = F.xxhash64(*events.columns)
    missing = F.lit(False)
    for part in parts:
        missing = missing | F.col(part).isNull()
    per_place = events.groupBy(*keys, *parts).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_is(truncate_when)).alias("n_truncate"),
        F.min(fingerprint).alias("low"),
        F.max(fingerprint).alias("high"),
    )
    found = F.array_compact(
        F.array(
            F.when(missing, F.struct(F.lit("null_sequence").alias("violation"), F.col("n").alias("events"))),
            F.when(
                ~missing & (F.col("low") != F.col("high")),
                F.struct(F.lit("ambiguous_sequence").alias("violation"), F.col("n").alias("events")),
            ),
            F.when(
                F.lit(scd_type == 2) & (F.col("n_truncate") > 0),
                F.struct(F.lit("truncate_in_history").alias("violation"), F.col("n_truncate").alias("events")),
            ),
        )
    )
    return (
        per_place.select(*keys, F.explode(found).alias("v"))
        .groupBy(*keys, F.col("v.violation").alias("violation"))
        .agg(F.sum("v.events").alias("events"))
    )

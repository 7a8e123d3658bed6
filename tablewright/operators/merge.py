"""Row-changing operators. Each returns the new state of the table; the caller writes it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.columns import as_column, holds

ALL = "*"
DELETE = "DELETE"

Assignments = Mapping[str, "Column | str"]
MatchedClause = tuple["Column | str | None", "Assignments | str"]
InsertClause = tuple["Column | str | None", "Assignments | str"]

_SOURCE, _COPIES = "__source", "__copies"


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows for which the predicate is not true; an unknown predicate keeps the row."""
    return df.filter(~holds(predicate))


def update_where(df: DataFrame, predicate: Column | str, assignments: Assignments) -> DataFrame:
    """Conditional assignment; every right-hand side sees the values before the update."""
    hit = holds(predicate)
    types = dict(df.dtypes)
    return df.select(
        *[
            F.when(hit, as_column(assignments[c]).cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in assignments
            else F.col(c)
            for c in df.columns
        ]
    )


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``like`` in its order and types, then the further columns of ``df``."""
    own = set(df.columns)
    known = [
        (F.col(f"`{n}`") if n in own else F.lit(None)).cast(t).alias(n) for n, t in like.dtypes
    ]
    return df.select(*known, *[F.col(f"`{c}`") for c in df.columns if c not in set(like.columns)])


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[MatchedClause] = ((None, ALL),),
    not_matched: Sequence[InsertClause] = ((None, ALL),),
    evolve: bool = False,
    condition: Column | str | None = None,
) -> DataFrame:
    """MERGE as dataflow: the state of ``target`` after ``source`` has been merged in.

    Rows match if they agree in ``on`` and if ``condition``, the rest of an ON clause, is true
    of the two, say ``t.is_current``. A source row whose key the target has, but only in
    rows for which that is not true, is unmatched.

    Conditions and values refer to the sides as ``t.column`` and ``s.column``. The first
    clause whose condition is true decides; a matched row without one stays as it is, an
    unmatched source row without one is left out. NULL keys never match. Two source rows
    for one target row are an error, raised when the result is computed.

    Target rows look their source row up in a left join, which Spark broadcasts when the
    source is small and in which it can split a key that holds much of the target; a full
    outer join could do neither. Source rows whose key the target lacks are added; the keys
    the sides share come from a second scan of the target, of its key columns alone. Whether
    a source key occurs twice is looked up in the source only and seen at the rows it meets.
    """
    keys = list(on)
    if evolve:
        extra = [(n, t) for n, t in source.dtypes if n not in set(target.columns)]
        target = target.select("*", *[F.lit(None).cast(t).alias(n) for n, t in extra])
    columns = target.columns
    if matched:
        joined = _pairs(target, source, keys, condition, "left")
        kept = _after_match(joined, target, source, keys, matched, condition)
    else:
        kept = target
    if not not_matched:
        return kept
    return kept.unionByName(_inserts(target, source, keys, not_matched, condition))


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _pairs(target: DataFrame, source: DataFrame, keys: Sequence[str], condition: Column | str | None, how: str) -> DataFrame:
    """Matching rows as the structs ``t`` and ``s``; without a condition also whether the source has the key twice."""
    lookup = source.select(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys], _row(source).alias(_SOURCE))
    if condition is None:
        repeated = source.groupBy(*[F.col(f"`{k}`").alias(f"__twice_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
        repeated = repeated.filter(F.col("__n") > 1)
        twice = [F.col(f"`__key_{k}`") == F.col(f"`__twice_{k}`") for k in keys]
        lookup = lookup.join(repeated, twice, "left").withColumn(_COPIES, F.col("__n").isNotNull())
    flat = target.select(*[F.col(f"`{k}`").alias(f"__own_{k}") for k in keys], _row(target).alias("t"))
    same = [F.col(f"`__own_{k}`") == F.col(f"`__key_{k}`") for k in keys]
    if condition is not None:
        lookup = lookup.withColumnRenamed(_SOURCE, "s")
        return flat.join(lookup, [*same, holds(condition)], how).select("t", "s")
    return flat.join(lookup, same, how).select("t", F.col(_SOURCE).alias("s"), _COPIES)


def _clashes(target: DataFrame, source: DataFrame, keys: Sequence[str], condition: Column | str) -> Column:
    """One value: are there (1) or are there not (0) several source rows for a target row?

    Only for rows with a repeated key it has to be seen which of them match.
    """
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    several = source.join(repeated.drop("n"), list(keys), "left_semi").select(*source.columns)
    numbered = target.withColumn("__number", F.monotonically_increasing_id())
    counted = _pairs(numbered, several, keys, condition, "inner").groupBy("t.__number").count()
    return counted.filter("count > 1").limit(1).agg(F.count(F.lit(1))).scalar()


def _after_match(
    joined: DataFrame,
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[MatchedClause],
    condition: Column | str | None = None,
) -> DataFrame:
    columns, types, source_columns = target.columns, dict(target.dtypes), set(source.columns)
    several = F.col(_COPIES) if condition is None else _clashes(target, source, keys, condition) > 0
    unique = F.when(
        several,
        F.raise_error("merge: several source rows match one target row").cast("int"),
    )
    is_match = F.col("s").isNotNull()
    clause = F.when(~is_match, F.lit(-1))
    for index, (condition, _) in enumerate(matched):
        clause = clause.when(holds(condition), F.lit(index))
    clause = F.coalesce(unique, clause.otherwise(F.lit(-1)))

    outcome = joined.withColumn("__clause", clause)
    deletes = [i for i, (_, action) in enumerate(matched) if isinstance(action, str) and action == DELETE]
    if deletes:
        outcome = outcome.filter(~F.col("__clause").isin(deletes))

    def after_update(column: str) -> Column:
        result = None
        for index, (_, action) in enumerate(matched):
            if index in deletes:
                continue
            if isinstance(action, str):
                if action != ALL:
                    raise ValueError(f"unknown action {action!r}")
                if column not in source_columns or column in keys:
                    continue
                new = F.col(f"s.`{column}`").cast(types[column])
            elif column in action:
                new = as_column(action[column]).cast(types[column])
            else:
                continue
            chosen = F.col("__clause") == index
            result = F.when(chosen, new) if result is None else result.when(chosen, new)
        old = F.col(f"t.`{column}`")
        # The clause number is read even where no clause assigns, so that the check for
        # copies cannot be pruned away.
        if result is None:
            return F.when(F.col("__clause") >= -1, old).alias(column) if column in keys else old.alias(column)
        return result.otherwise(old).alias(column)

    return outcome.select(*[after_update(c) for c in columns])


def _inserts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    not_matched: Sequence[InsertClause],
    condition: Column | str | None = None,
) -> DataFrame:
    columns, types, source_columns = target.columns, dict(target.dtypes), set(source.columns)
    # Keys both sides have. With a small source Spark filters the target by it before the
    # distinct, otherwise the distinct is combined on the map side before any shuffle.
    shared = target.select(*keys).distinct().join(source.select(*keys), list(keys), "left_semi")
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(f"`{key}`").isNotNull()
    # Rows without a key match nothing; joining them would gather them in one task.
    if condition is None:
        known = source.filter(complete).alias("s")
        fresh = known.join(shared.alias("k"), [F.col(f"s.`{k}`") == F.col(f"k.`{k}`") for k in keys], "left_anti")
        fresh = fresh.select(_row(source).alias("s"))
    else:
        known = source.filter(complete).select(*[F.col(f"`{k}`").alias(f"__key_{k}") for k in keys], _row(source).alias("s"))
        rows = target.select(*[F.col(f"`{k}`").alias(f"__own_{k}") for k in keys], _row(target).alias("t"))
        same = [F.col(f"`__own_{k}`") == F.col(f"`__key_{k}`") for k in keys]
        fresh = known.join(rows, [*same, holds(condition)], "left_anti").select("s")
    fresh = fresh.unionByName(source.filter(~complete).select(_row(source).alias("s")))

    clause = F.lit(None).cast("int")
    for index, (condition, _) in reversed(list(enumerate(not_matched))):
        clause = F.when(holds(condition), F.lit(index)).otherwise(clause)
    fresh = fresh.withColumn("__clause", clause).filter(F.col("__clause").isNotNull())

    def inserted(column: str) -> Column:
        result = F.lit(None).cast(types[column])
        for index, (_, action) in enumerate(not_matched):
            if isinstance(action, str):
                new = F.col(f"s.`{column}`") if column in source_columns else F.lit(None)
            else:
                new = as_column(action[column]) if column in action else F.lit(None)
            result = F.when(F.col("__clause") == index, new.cast(types[column])).otherwise(result)
        return result.alias(column)

    return fresh.select(*[inserted(c) for c in columns])

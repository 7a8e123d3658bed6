"""Windows over groups of which one may be far too large for a single task.

A plain window puts each group into one task. Where a probe finds groups with an outsized
share of the rows, these are cut along the window order into slices; windows then run per
slice, and what a slice needs from the ones before or after it is carried over through a
table with one row per slice. Slices hold about as many rows as one task should take; beyond 16,384 of them they grow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tablewright.session import materialize

SLICE = "__slice"
_TASK = "__task"
_PARTS = 16_384  # outsized groups, and slices, at most about twice as many
_PER_SLICE = 32  # sampled rows of a slice


def descending(name: str) -> bool:
    return name.startswith("-")


def bare(name: str) -> str:
    return name.lstrip("-")


def sort_column(name: str) -> Column:
    return F.col(bare(name)).desc() if descending(name) else F.col(bare(name)).asc()


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and ordered by ``order`` inside a group.

    A name in ``order`` with a leading minus sorts descending. A group of more than
    ``min_rows`` rows is cut into slices of about that size; no table has more than about
    two slices per 1/``parts`` of its rows, so that where they begin fits into one broadcast.

    Rows that agree in keys and order cannot be told apart by a cut. With ``break_ties``
    a large set of them is ordered by the task it was read in, which is written down first
    so that every later use sees the same order.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        min_rows: int = 1_000_000,
        parts: int = _PARTS,
        break_ties: bool = False,
    ):
        self.keys = list(keys)
        self.order = list(order)
        self.heavy_ties = False
        bounds = self._bounds(df, min_rows, parts)
        if self.heavy_ties and break_ties:
            df = materialize(df.withColumn(_TASK, F.spark_partition_id()))
            self.order.append(_TASK)
            bounds = self._bounds(df, min_rows, parts)
        self.sliced = bounds is not None
        self.df = self._cut(df, bounds) if self.sliced else df

    @property
    def by(self) -> list[str]:
        return self.keys + [SLICE] if self.sliced else self.keys

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*[sort_column(o) for o in self.order])

    def _bounds(self, df: DataFrame, min_rows: int, parts: int) -> list | None:
        """Per outsized key the order values at which to cut, from a sample of the rows."""
        total = df.count()
        if total <= min_rows:
            return None
        rows = max(total / parts, min_rows)
        fraction = min(1.0, _PER_SLICE / rows)
        names = self.keys + [bare(o) for o in self.order]
        sample = df.select(*names)
        if fraction < 1.0:
            sample = sample.sample(False, fraction, 7)
        step = max(1, int(rows * fraction))
        in_key = Window.partitionBy(*self.keys)
        cuts = (
            sample.withColumn("__n", F.count(F.lit(1)).over(in_key))
            .filter(F.col("__n") > step)
            .withColumn("__rn", F.row_number().over(in_key.orderBy(*[sort_column(o) for o in self.order])))
            .filter(F.col("__rn") % step == 0)
            .select(F.struct(*self.keys).alias("k"), F.struct(*[bare(o) for o in self.order]).alias("b"), "__rn")
        )
        # At most two cuts per part: the sample has total * fraction rows, one cut per step.
        rows = sorted(cuts.collect(), key=lambda r: (repr(r["k"]), r["__rn"]))
        if not rows:
            return None
        grouped: list[tuple] = []
        for row in rows:
            if grouped and grouped[-1][0] == row["k"]:
                if grouped[-1][1][-1] == row["b"]:
                    self.heavy_ties = True
                else:
                    grouped[-1][1].append(row["b"])
            else:
                grouped.append((row["k"], [row["b"]]))
        self._bounds_schema = cuts.select("k", F.array("b").alias("bounds")).schema
        return grouped

    def _cut(self, df: DataFrame, bounds: list) -> DataFrame:
        """Add the slice number: -1 in ordinary groups, the number of cuts passed in others."""
        cuts = df.sparkSession.createDataFrame(bounds, self._bounds_schema)
        cuts = cuts.select(F.col("k").alias("__k"), F.col("bounds").alias("__bounds"))
        powers = [1 << bit for bit in reversed(range(max(len(b) for _, b in bounds).bit_length()))]
        same_key = F.lit(True)
        for key in self.keys:
            same_key = same_key & F.col(key).eqNullSafe(F.col(f"__k.{key}"))

        def further(number: Column, power: Column) -> Column:
            there = number + power
            passed = (there <= F.size("__bounds")) & self._reached(F.get("__bounds", there - 1))
            return F.when(passed, there).otherwise(number)

        # The number of bounds passed, by halving.
        passed = F.reduce(F.array(*[F.lit(p) for p in powers]), F.lit(0), further)
        number = F.when(F.col("__bounds").isNull(), F.lit(-1)).otherwise(passed)
        return df.join(F.broadcast(cuts), same_key, "left").select(*df.columns, number.alias(SLICE))

    def _reached(self, bound: Column) -> Column:
        """Does the row stand at or after the bound in the window order?"""
        reached = F.lit(True)
        for name in reversed(self.order):
            mine, cut = F.col(bare(name)), bound[bare(name)]
            low, high = (mine, cut) if descending(name) else (cut, mine)
            after = F.coalesce(high > low, high.isNotNull() & low.isNull())
            reached = after | (mine.eqNullSafe(cut) & reached)
        return reached

    def _carried(self, df: DataFrame, summary: DataFrame, name: str) -> DataFrame:
        """Bring one value per slice to its rows; at most two slices per part exist."""
        side = summary.select(*[F.col(k).alias(f"__c_{k}") for k in self.by], name)
        same = F.lit(True)
        for key in self.by:
            same = same & F.col(key).eqNullSafe(F.col(f"__c_{key}"))
        return df.join(F.broadcast(side), same, "left").drop(*[f"__c_{k}" for k in self.by])

    def with_running_sum(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        """Add the sum of ``value`` from the start of the group up to and including the row."""
        frame = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if not self.sliced:
            return df.withColumn(name, F.sum(value).over(frame))
        local = self._with_earlier_slices(df.withColumn("__local", F.sum(value).over(frame)), df, value)
        # NULL + x is NULL: a missing side counts as nothing, two missing sides as NULL.
        total = F.coalesce(F.col("__carry") + F.col("__local"), F.col("__local"), F.col("__carry"))
        return local.withColumn(name, total).drop("__local", "__carry")

    def with_rank(self, df: DataFrame, name: str) -> DataFrame:
        """Add the rank in the group. Cuts lie between different values: ties share a slice."""
        if not self.sliced:
            return df.withColumn(name, F.rank().over(self.window).cast("bigint"))
        local = self._with_earlier_slices(df.withColumn("__local", F.rank().over(self.window)), df, F.lit(1))
        rank = F.col("__local") + F.coalesce(F.col("__carry"), F.lit(0))
        return local.withColumn(name, rank.cast("bigint")).drop("__local", "__carry")

    def _with_earlier_slices(self, df: DataFrame, rows: DataFrame, value: Column) -> DataFrame:
        """Add ``__carry``: the sum of ``value`` over the earlier slices of the group."""
        per_slice = rows.filter(F.col(SLICE) >= 0).groupBy(*self.by).agg(F.sum(value).alias("__sum"))
        before = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        return self._carried(df, per_slice.withColumn("__carry", F.sum("__sum").over(before)).drop("__sum"), "__carry")

    def with_neighbour(self, df: DataFrame, value: Column, name: str, ahead: bool = False) -> DataFrame:
        """Add ``value`` of the row before (or after) in the group, NULL at its edge.

        ``value`` should be a struct, so that a NULL inside it differs from no neighbour.
        ``df`` may be a subset of ``self.df``: neighbours are then those of the subset.
        """
        if any(descending(o) for o in self.order):
            raise ValueError("with_neighbour needs an ascending order")
        step = F.lead if ahead else F.lag
        if not self.sliced:
            return df.withColumn(name, step(value).over(self.window))
        position = F.struct(*[F.col(o) for o in self.order])
        edge = F.min_by(value, position) if ahead else F.max_by(value, position)
        per_slice = df.filter(F.col(SLICE) >= 0).groupBy(*self.by).agg(edge.alias("__edge"))
        along = Window.partitionBy(*self.keys).orderBy(SLICE)
        carry = per_slice.withColumn("__carry", step(F.col("__edge")).over(along)).drop("__edge")
        local = df.withColumn(name, step(value).over(self.window))
        return self._carried(local, carry, "__carry").withColumn(
            name, F.coalesce(F.col(name), F.col("__carry"))
        ).drop("__carry")

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(SLICE, _TASK)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, **sizing
) -> DataFrame:
    """Running sum of ``value`` inside each group, current row included.

    ``order`` should identify a row; among rows it does not tell apart any order will do.
    """
    groups = OrderedGroups(df, keys, order, break_ties=True, **sizing)
    return groups.finish(groups.with_running_sum(groups.df, F.col(value), name))


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, **sizing) -> DataFrame:
    """``rank`` of every row in its group, as a bigint: equal rows share a rank, gaps follow.

    Where one value holds very many rows, which no cut can separate, the rank is taken from
    counts per distinct value: these are combined on the map side.
    """
    values = [bare(o) for o in order]
    groups = OrderedGroups(df, keys, order, **sizing)
    if not groups.heavy_ties:
        return groups.finish(groups.with_rank(groups.df, name))
    counted = groups.df.groupBy(*groups.by, *values).agg(F.count(F.lit(1)).alias("__n"))
    ranked = groups.with_running_sum(counted, F.col("__n"), "__upto")
    ranked = ranked.select(
        *[F.col(c).alias(f"__r_{c}") for c in [*keys, *values]],
        (F.col("__upto") - F.col("__n") + 1).cast("bigint").alias(name),
    )
    same = F.lit(True)
    for c in [*keys, *values]:
        same = same & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(ranked, same, "inner").select(*df.columns, name)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, name: str) -> DataFrame:
    """Rows of rank 1 to ``n``. Spark drops the others in each input task, before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*[sort_column(o) for o in order])
    return df.withColumn(name, F.rank().over(window)).filter(F.col(name) <= n)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each group in the given total order.

    As in ``top_n`` each input task passes on one row per key at most, so a key with most
    of the rows is no burden.
    """
    sort = [sort_column(o) if isinstance(o, str) else o for o in order]
    window = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") == 1).drop("__rn")

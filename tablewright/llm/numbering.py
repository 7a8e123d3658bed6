"""Sums over the earlier rows of a group, where one group may hold most of the rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.llm.common import stored

_TASK, _PART = "__task", "__part"


def numbered(
    df: DataFrame, group: str, keys: Sequence[Column | str], sizes: Mapping[str, str], label: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """Rows with, for each ``name: size`` of ``sizes``, the sum of ``size`` over the rows of the group before them.

    ``group`` holds no NULL and is the first key of the order; sizes are not negative. Range
    partitions are sorted and summed by themselves, so that a group may lie in many of them;
    of each partition only its first and last group go through the driver. Rows that agree
    in all keys are dealt out by a salt and ordered by chance, once: the result is stored.
    ``keep`` names the columns that are still wanted after sorting.
    """
    kept = df.select(*(keep or df.columns))
    schema = T.StructType(kept.schema.fields + [T.StructField(n, T.LongType()) for n in sizes] + [T.StructField(_PART, T.IntegerType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, before = TaskContext.get().partitionId(), None, {n: 0 for n in sizes}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = batch.column(batch.schema.get_field_index(group))
            heads = np.ones(n, bool)
            heads[1:] = pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)
            same = last is not None and own[0] == last
            at = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
            made = []
            for name, size in sizes.items():
                values = batch.column(batch.schema.get_field_index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
                starts = np.cumsum(values) - values
                sums = starts - starts[at]
                if same:
                    sums[at == 0] += before[name]
                before[name] = int(sums[-1] + values[-1])
                made.append(pa.array(sums))
            last = own[n - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made, pa.array(np.full(n, task, np.int32))], names=[*batch.schema.names, *sizes, _PART]
            )

    salt = F.spark_partition_id().alias(_TASK)
    order = [*keys, F.col(_TASK)]
    dealt = df.select("*", salt).repartitionByRange(*order).sortWithinPartitions(*order).select(*kept.columns)
    rows = stored(dealt.mapInArrow(add, schema), label)

    ends = [F.max(F.struct(F.col(group).alias("g"), (F.col(n) + F.col(s)).alias("v"))).alias(n) for n, s in sizes.items()]
    parts = rows.groupBy(_PART).agg(F.min(group).alias("__low"), F.max(group).alias("__high"), *ends).orderBy(_PART).collect()
    offsets, high, carried = [], None, {}
    for row in parts:  # one row per partition
        goes_on = high is not None and row["__low"] == high
        if goes_on:
            offsets.append((row[_PART], row["__low"], *[carried[n] for n in sizes]))
        through = goes_on and row["__low"] == row["__high"]
        carried = {n: row[n]["v"] + (carried[n] if through else 0) for n in sizes}
        high = row["__high"]
    if not offsets:
        return rows.drop(_PART)
    kind = T.StructType(
        [T.StructField(_PART, T.IntegerType()), T.StructField(group, df.schema[group].dataType)]
        + [T.StructField(f"__plus_{n}", T.LongType()) for n in sizes]
    )
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, kind))  # at most one row per partition
    rows = rows.join(table, [_PART, group], "left")
    rows = rows.withColumns({n: F.col(n) + F.coalesce(F.col(f"__plus_{n}"), F.lit(0)) for n in sizes})
    return rows.select(*kept.columns, *sizes)

"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablewright.session import scratch

# Fixed value: white space that separates words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Queries in here remove their shuffle files when they end, not only when the driver collects garbage."""
    before = spark.conf.get(_SWEEP, "false")
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SWEEP, before)


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back: they survive lost executors."""
    path = scratch(df.sparkSession, f"llm-{label}")
    with swept(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(spark: SparkSession, path: str) -> None:
    """Give back the disk of a scratch folder that nobody reads any more: no rows take the place of its rows."""
    spark.range(0).write.mode("overwrite").parquet(path)


def reuse() -> None:
    """Keep freed memory of up to 64 MB for the next arrays of numpy; else the system hands out and clears new pages for each."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD, the most it may be
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):
        pass  # another C library


def release() -> None:
    """Give freed memory back to the system; a Python worker waits for its next task with what it still holds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def tidied(work: Callable[[Iterator], Iterator], forget: Callable[[], None] = release) -> Callable[[Iterator], Iterator]:
    """The same function of batches, with ``forget`` when its task ends.

    ``forget`` is a function of a module: a task has a copy of its own of a cache that ``work`` names.
    """

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        forget()

    return run


def n_words(text: Column) -> Column:
    """How many words a text has; none where it is NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def running(df: DataFrame, keys: Sequence[str], size: str, start: str, label: str) -> DataFrame:
    """Rows in global order of ``keys`` with the sum of ``size`` over all rows before them as ``start``.

    Range partitions are sorted and summed by themselves; only one total per partition
    goes through the driver. Equal keys are ordered by chance, once: the result is stored.
    """
    schema = T.StructType(df.schema.fields + [T.StructField("__task", T.IntegerType()), T.StructField(start, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes) + total
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(ends), task, np.int32)), pa.array(ends - sizes)],
                names=[*batch.schema.names, "__task", start],
            )
            total = int(ends[-1]) if len(ends) else total

    spark = df.sparkSession
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(tidied(add), schema), label)
    totals = rows.groupBy("__task").agg(F.sum(size).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(totals, key=lambda r: r["__task"]):
        offsets.append((row["__task"], total))
        total += row["n"]
    # An Arrow table needs no Python worker beside those of the job.
    tasks, sums = pa.array([t for t, _ in offsets], pa.int32()), pa.array([n for _, n in offsets], pa.int64())
    table = spark.createDataFrame(pa.table({"__task": tasks, "__offset": sums}))
    return (
        rows.join(F.broadcast(table), "__task")
        .withColumn(start, F.col(start) + F.col("__offset"))
        .drop("__task", "__offset")
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers: shifts and odd multipliers, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int | np.ndarray, key: int, rounds: int = 6, back: bool = False) -> np.ndarray:
    """A keyed permutation of the numbers below ``n``, applied to each index, or its inverse.

    A balanced Feistel network permutes the next power of four; a result that is not below
    ``n`` is put through it again until it is (cycle walking). No table is kept, so that
    any task can compute any slot. ``n`` may differ from index to index.
    """
    x = np.asarray(index, np.uint64).copy()
    top = np.broadcast_to(np.asarray(n, np.uint64), x.shape)
    bits = np.frompyfunc(lambda v: max(1, (int(v - 1).bit_length() + 1) // 2), 1, 1)
    sizes, which = np.unique(top, return_inverse=True)
    half = bits(sizes.astype(object)).astype(np.uint64)[which] if len(sizes) else np.zeros(0, np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mixed(np.uint64(key & (2**64 - 1)) + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = list(keys[::-1] if back else keys)
    todo = np.arange(len(x))
    while len(todo):
        h, m = half[todo], mask[todo]
        left, right = x[todo] >> h, x[todo] & m
        for k in order:
            if back:
                left, right = right ^ (mixed(left ^ k) & m), left
            else:
                left, right = right, left ^ (mixed(right ^ k) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= top[todo]]
    return x.astype(np.int64)

"""Layout jobs and table health: file sizes, clustering, data skipping, partition choice.

Every job writes to a new folder. Overwriting a folder that is being read would destroy it.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_left
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import as_column, hashable, safe_divide, spread
from tablewright.sources.tables import list_files

# Target file size, small-file alarm, and the most columns worth interleaving.
TARGET_BYTES = 256 * 1024 * 1024
MAX_FILES = 1000
MIN_AVERAGE_BYTES = 134_217_728
MAX_ZORDER_COLUMNS = 4
# Bits of a column at most: finer order comes from the columns themselves. Sampled texts for a bucket.
_MOST_BITS, _TEXTS_PER_BUCKET = 13, 16
# Fixed value: the folder name that stands for NULL in a partitioned table.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    target_bytes: int = TARGET_BYTES,
    by: Sequence[str] = (),
    where: Column | str | None = None,
) -> int:
    """Rewrite a folder of small files into files of about ``target_bytes``.

    ``by`` names the partition columns of the table, ``where`` limits the job to some
    partitions, which the caller then swaps in. Returns the number of files aimed at.
    """
    df = spark.read.parquet(src)
    files = list_files(spark, src)
    if not by:
        if where is not None:
            raise ValueError("only whole partitions can be chosen: name the partition columns")
        total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        wanted = max(1, math.ceil(total / target_bytes))
        df.repartition(wanted).write.parquet(dst)
        return wanted

    # Bytes per partition value, read off the folder names; one row per partition.
    types = dict(df.dtypes)

    def value(c: str) -> Column:
        text = F.regexp_extract("path", rf"/{re.escape(c)}=([^/]*)/", 1)
        decoded = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(text != NULL_PARTITION, decoded).cast(types[c]).alias(c)

    sizes = files.select(*[value(c) for c in by], "length")
    if where is not None:
        condition = as_column(where)
        df, sizes = df.filter(condition), sizes.filter(condition)
    counts = sizes.groupBy(*by).agg(F.ceil(F.sum("length") / F.lit(target_bytes)).cast("int").alias("__files"))
    wanted = counts.agg(F.coalesce(F.sum("__files"), F.lit(1))).first()[0]
    spread_rows = df.withColumn("__slot", spread([c for c in hashable(df) if c not in by], 1 << 16))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    sized = spread_rows.alias("d").join(counts.alias("c"), same, "left").select("d.*", "c.__files")
    slot = F.col("__slot") % F.coalesce("__files", F.lit(1))
    sized = sized.withColumn("__slot", slot).drop("__files")
    sized.repartition(int(wanted), *by, "__slot").drop("__slot").write.partitionBy(*by).parquet(dst)
    return int(wanted)


def _is_text(df: DataFrame, column: str) -> bool:
    """Are bounds of the column compared as text? Types without an order of numbers are, by their text."""
    kinds = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return not isinstance(df.schema[column].dataType, kinds)


def _ordinal(df: DataFrame, column: str) -> Column:
    """A value that sorts like the column: a double, or the text itself."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("string") if _is_text(df, column) else c.cast("double")


def separators(values: Sequence[str], parts: int) -> list[str]:
    """At most ``parts`` - 1 texts that cut sorted ``values`` into runs of about one size.

    Each is the shortest head of a value that is greater than the value before it, so that
    long texts with much in common do not make long bounds.
    """
    found: list[str] = []
    for i in range(1, parts if values else 0):
        value = values[i * len(values) // parts]
        at = bisect_left(values, value)
        before = values[at - 1] if at else ""
        same = next((n for n, (a, b) in enumerate(zip(value, before)) if a != b), min(len(value), len(before)))
        head = value[: same + 1]
        if value > before and (not found or head > found[-1]):
            found.append(head)
    return found


def _bounds(df: DataFrame, cols: Sequence[str], parts: int, text_chars: int) -> dict[str, list]:
    """Per column the values at which its buckets begin: from sketches, for text from a sample of bounded size."""
    points = [i / parts for i in range(1, parts)]
    numbers, texts = [c for c in cols if not _is_text(df, c)], [c for c in cols if _is_text(df, c)]
    bounds: dict[str, list] = {}
    if numbers:
        sketches = df.agg(*[F.percentile_approx(_ordinal(df, c), points, 20 * parts).alias(c) for c in numbers]).first()
        bounds |= {c: sorted({v for v in sketches[c] or [] if math.isfinite(v)}) for c in numbers}
    if texts:
        total, wanted = df.count(), _TEXTS_PER_BUCKET * parts
        rows = df.sample(False, wanted / total, 7) if total > wanted else df
        heads = [F.substring(_ordinal(df, c), 1, text_chars).alias(c) for c in texts]
        sample = rows.select(*heads).collect()
        for c in texts:
            bounds[c] = separators(sorted(row[c] for row in sample if row[c] is not None), parts)
    return bounds


def _with_bucket(df: DataFrame, name: str, value: Column, bounds: Sequence) -> DataFrame:
    """Add the number of sorted bounds a value has reached, by halving. NULL has reached none."""
    kind = "string" if bounds and isinstance(bounds[0], str) else "double"
    # One literal for all bounds; a place beyond the last one is NULL and never reached.
    steps = F.from_json(F.lit(json.dumps(list(bounds))), f"array<{kind}>")
    df = df.withColumns({"__value": value, name: F.lit(0)})
    for bit in reversed(range(len(bounds).bit_length())):
        reached = F.col("__value") >= F.get(steps, F.col(name) + (1 << bit) - 1)
        df = df.withColumn(name, F.col(name) + F.when(reached, F.lit(1 << bit)).otherwise(F.lit(0)))
    return df.drop("__value")


def curve_bits(files: int, columns: int) -> int:
    """Bits of each column: 16 times as many buckets as files can tell apart, within 62 bits in all."""
    return min(62 // columns, _MOST_BITS, math.ceil(math.log2(max(2, files)) / columns) + 4)


def zorder(df: DataFrame, cols: Sequence[str], files: int, bits: int | None = None, text_chars: int = 256) -> DataFrame:
    """Rows gathered and sorted along a curve that keeps all ``cols`` local.

    Quantile bounds give each column ``2**bits`` buckets of about equal size, by default as
    many as ``files`` and the number of columns ask for; the bits of the buckets are
    interleaved into one number to sort by. Numbers and dates have their bounds from a
    sketch. Text is compared as text, with bounds from a sample of 16 rows a bucket; texts
    that agree in their first ``text_chars`` characters share a bucket. Rows of one cell of
    the curve are sorted by the columns themselves. NULL comes first. An empty table stays empty.
    """
    cols = list(cols)
    if not 1 <= len(cols) <= MAX_ZORDER_COLUMNS:
        raise ValueError(f"zorder takes 1 to {MAX_ZORDER_COLUMNS} columns")
    bits = curve_bits(files, len(cols)) if bits is None else bits
    bounds = _bounds(df, cols, 1 << bits, text_chars)
    curve = F.lit(0).cast("bigint")
    for position, c in enumerate(cols):
        bucket = f"__b{position}"
        df = _with_bucket(df, bucket, _ordinal(df, c), bounds[c])
        for bit in range(bits):
            taken = F.shiftright(F.col(bucket).cast("bigint"), bit).bitwiseAND(F.lit(1))
            curve = curve + F.shiftleft(taken, bit * len(cols) + position)
    df = df.withColumn("__z", curve).drop(*[f"__b{i}" for i in range(len(cols))])
    # The last sort key tears large sets of equal rows apart.
    df = df.withColumn("__spread", spread(cols, 1 << 16))
    placed = df.repartitionByRange(files, "__z", *cols, "__spread").sortWithinPartitions("__z", *cols)
    return placed.drop("__z", "__spread")


def cluster(df: DataFrame, cols: Sequence[str], files: int) -> DataFrame:
    """Rows gathered and sorted by ``cols``, leading column first."""
    tagged = df.withColumn("__spread", spread(list(cols), 1 << 16))
    return tagged.repartitionByRange(files, *cols, "__spread").sortWithinPartitions(*cols).drop("__spread")


def skipping_report(df: DataFrame, cols: Sequence[str], ranges: Mapping[str, tuple]) -> DataFrame:
    """Per file of a scanned table: rows, bounds of ``cols``, and whether a filter must read it.

    ``ranges`` maps a column to the (low, high) interval a query asks for.
    """
    overlap = F.lit(True)
    for column, (low, high) in ranges.items():
        overlap = overlap & (F.col(f"max_{column}") >= F.lit(low)) & (F.col(f"min_{column}") <= F.lit(high))
    bounds = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return (
        df.groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("row_count"), *bounds)
        .withColumn("must_read", F.coalesce(overlap, F.lit(False)))
    )


def file_health(
    files: DataFrame, max_files: int = MAX_FILES, min_average: int = MIN_AVERAGE_BYTES
) -> DataFrame:
    """Per table (``table_name``, ``path``, ``length``): files, bytes, average, verdict."""
    totals = files.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("size_in_bytes")
    )
    average = safe_divide(F.col("size_in_bytes"), F.col("num_files"))
    small = (F.col("num_files") > max_files) & (F.col("avg_file_bytes") < min_average)
    return totals.withColumn("avg_file_bytes", average).withColumn(
        "status", F.when(small, F.lit("NEEDS_OPTIMIZE")).otherwise(F.lit("OK"))
    )


def scanned_files(df: DataFrame, table_name: str) -> DataFrame:
    """The data files that a scan reads: ``table_name``, ``path``, ``length``, ``row_count``.

    Only file footers are read. Files without rows are not seen; a folder listing has them.
    """
    return (
        df.groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.max("_metadata.file_size").alias("length"), F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(table_name))
    )


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum, NULLs and approximate distinct values of the given columns."""
    from tablewright.operators.profile import profile

    return profile(df, cols).select("column_name", "row_count", "nulls", "ndv", "min", "max")


def partition_advice(
    df: DataFrame, candidates: Sequence[str], max_values: int = 10_000, max_skew: float = 3.0
) -> DataFrame:
    """Per candidate partition column: distinct values, rows per value, skew, verdict.

    A first pass estimates the distinct values. Only columns that could serve as
    partitions at all are counted value by value, so that result stays small.
    """
    estimate = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.approx_count_distinct(c).alias(c) for c in candidates]
    ).first()
    total = estimate["__rows"]
    low = [c for c in candidates if estimate[c] <= max_values]
    high = [c for c in candidates if c not in low]
    spark = df.sparkSession
    schema = "column_name string, ndv bigint, avg_rows double, max_rows bigint, skew double, advice string"
    flagged = spark.createDataFrame(
        [(c, estimate[c], total / estimate[c], None, None, "TOO_MANY_VALUES") for c in high], schema
    )
    if not low:
        return flagged
    long = df.select(*[F.col(c).cast("string").alias(c) for c in low]).unpivot([], low, "column_name", "value")
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    advised = (
        counted.groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("ndv"),
            F.avg("n").alias("avg_rows"),
            F.max("n").alias("max_rows"),
            (F.max("n") / F.avg("n")).alias("skew"),
        )
        .withColumn("advice", F.when(F.col("skew") > max_skew, F.lit("SKEWED")).otherwise(F.lit("OK")))
    )
    return advised.unionByName(flagged)

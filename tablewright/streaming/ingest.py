"""File ingestion: new JSON files once each, with schema inference, evolution and rescue."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Schema evolution modes and the column for what does not fit.
ADD = "addNewColumns"
RESCUE = "rescue"
FAIL = "fail"
RESCUED = "_rescued_data"

BATCH = "batch_id"


class SchemaChanged(Exception):
    """New fields arrived while the mode is ``fail``."""


def _storable(kind: T.DataType) -> T.DataType:
    """The type to keep for an inferred one: wide numbers, text where nothing is certain."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType)) for f in kind.fields])
    return kind


def infer_fields(lines: DataFrame) -> T.StructType:
    """Fields and types of JSON lines, by one aggregation whose result is the schema text.

    Lines that hold something else than an object say nothing about fields.
    """
    objects = lines.filter(F.col("value").rlike(r"^\s*\{"))
    found = objects.select(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType([])
    return _storable(T.StructType.fromDDL(f"root {found.replace('OBJECT<', 'STRUCT<')}")["root"].dataType)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(text: Column) -> Column:
    """The significant digits of a number's text."""
    return F.regexp_replace(F.regexp_replace(text, "[Ee].*$|[-.]", ""), "^0+|0+$", "")


def _fitted(v: Column, kind: T.DataType) -> Column:
    """A variant as ``value`` of a type, and as ``fits`` whether the value holds all of it.

    Text holds every scalar. Numbers hold numbers of the same value, not text or truth
    values; floating-point columns take the nearest number. Structs, arrays and maps are
    read leaf by leaf, and leave nothing out if all leaves fit and no field is unknown.
    """
    name = kind.simpleString()
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return _let(v, lambda x: _nested(x, kind))

    def leaf(x: Column) -> Column:
        own, value = F.schema_of_variant(x), F.try_variant_get(x, "$", name)
        nothing = x.isNull() | F.coalesce(F.is_variant_null(x), F.lit(True))
        number = own.isin("BIGINT", "DOUBLE", "FLOAT") | own.startswith("DECIMAL")
        if isinstance(kind, (T.StringType, T.VariantType)):
            fits = value.isNotNull()
        elif isinstance(kind, T.BooleanType):
            fits = own == "BOOLEAN"
        elif isinstance(kind, T.NumericType):
            text = F.try_variant_get(x, "$", "string")
            fits = number & value.isNotNull() & (_digits(text) == _digits(value.cast("string")))
        else:
            fits = (own == "STRING") & value.isNotNull()
        fits = nothing | F.coalesce(fits, F.lit(False))
        keep = number if isinstance(kind, (T.DoubleType, T.FloatType)) else fits
        return F.struct(F.when(keep & ~nothing, value).alias("value"), fits.alias("fits"))

    return _let(v, leaf)


def _nested(x: Column, kind: T.DataType) -> Column:
    nothing = x.isNull() | F.coalesce(F.is_variant_null(x), F.lit(True))
    if isinstance(kind, T.ArrayType):
        read = F.transform(F.try_variant_get(x, "$", "array<variant>"), lambda e: _fitted(e, kind.elementType))
        return _let(
            read, lambda r: F.struct(
                F.transform(r, lambda e: e["value"]).alias("value"),
                (nothing | F.coalesce(F.forall(r, lambda e: e["fits"]), F.lit(False))).alias("fits"),
            )
        )
    fields = F.try_variant_get(x, "$", "map<string,variant>")
    if isinstance(kind, T.MapType):
        read = F.transform_values(fields, lambda k, e: _fitted(e, kind.valueType))
        return _let(
            read, lambda r: F.struct(
                F.transform_values(r, lambda k, e: e["value"]).cast(kind).alias("value"),
                (nothing | F.coalesce(F.forall(F.map_values(r), lambda e: e["fits"]), F.lit(False))).alias("fits"),
            )
        )

    def struct(m: Column) -> Column:
        names = kind.fieldNames()
        unknown = F.map_filter(m, lambda k, e: ~F.coalesce(F.is_variant_null(e), F.lit(True)) & ~(k.isin(*names) if names else F.lit(False)))
        read = F.struct(
            *[_fitted(F.try_element_at(m, F.lit(f.name)), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)],
            (F.size(unknown) == 0).alias("all"),
        )
        return _let(
            read, lambda r: F.struct(
                F.when(m.isNotNull(), F.struct(*[r[f"f{i}"]["value"].alias(f.name) for i, f in enumerate(kind.fields)])).alias("value"),
                (nothing | F.coalesce(m.isNotNull() & reduce(and_, [r[f"f{i}"]["fits"] for i in range(len(names))], r["all"]), F.lit(False))).alias("fits"),
            )
        )

    return _let(fields, struct)


def parse_json_lines(lines: DataFrame, schema: T.StructType, rescued: str = RESCUED) -> DataFrame:
    """Typed columns from a ``value`` column of JSON lines.

    Fields outside the schema, and fields that their column does not hold without loss at
    every depth, are kept as JSON in the rescue column, each field of a line whole, with its
    types and digits; what of such a field fits stays in its column too. A line that is no JSON object is kept there whole.
    """
    parsed = F.try_parse_json("value")
    something = lambda x: ~F.coalesce(F.is_variant_null(x), F.lit(True))
    read = [
        _fitted(F.try_variant_get(parsed, "$['" + f.name.replace("'", "\\'") + "']", "variant"), f.dataType).alias(f"f{i}")
        for i, f in enumerate(schema.fields)
    ]
    rows = lines.select(
        "value", F.struct(*read, F.lit(0).alias("__")).alias("__v"),
        F.try_variant_get(parsed, "$", "map<string,variant>").alias("__raw"), parsed.isNotNull().alias("__valid"),
    )
    if schema.fields:
        fits = F.map_from_arrays(
            F.array(*[F.lit(f.name) for f in schema.fields]),
            F.array(*[F.col(f"__v.f{i}.fits") for i in range(len(schema.fields))]),
        )
        left_over = F.map_filter(
            "__raw", lambda k, x: something(x) & ~F.coalesce(F.try_element_at(fits, k), F.lit(False))
        )
    else:
        left_over = F.map_filter("__raw", lambda k, x: something(x))
    whole_line = ~F.col("__valid") | F.col("__raw").isNull()
    rest = F.when(whole_line, F.col("value")).when(F.size(left_over) > 0, F.to_json(left_over))
    return rows.select(*[F.col(f"__v.f{i}.value").alias(f.name) for i, f in enumerate(schema.fields)], rest.alias(rescued))


def stored_schema(spark: SparkSession, schema_dir: str, before: int | None = None) -> T.StructType | None:
    """The newest stored schema, or the one in force before a batch."""
    try:
        kept = spark.read.option("wholetext", "true").text(f"{schema_dir}/*")
        kept = kept.select(
            F.regexp_extract(F.col("_metadata.file_path"), rf"{BATCH}=(\d+)", 1).cast("bigint").alias(BATCH), "value"
        )
    except AnalysisException:
        return None
    if before is not None:
        kept = kept.filter(F.col(BATCH) < before)
    newest = kept.agg(F.max_by("value", BATCH)).first()[0]
    return None if newest is None else T.StructType.fromJson(json.loads(newest))


def _widened(known: T.DataType, found: T.DataType, path: str, new: list[str]) -> T.DataType:
    """``known`` with the fields that only ``found`` has, at every depth; ``new`` gets their paths."""
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_widened(known.elementType, found.elementType, path, new), known.containsNull)
    if not (isinstance(known, T.StructType) and isinstance(found, T.StructType)):
        return known
    there = {f.name: f for f in found.fields}
    fields = [
        T.StructField(f.name, _widened(f.dataType, there[f.name].dataType, f"{path}{f.name}.", new), f.nullable, f.metadata)
        if f.name in there else f
        for f in known.fields
    ]
    fresh = [f for f in found.fields if f.name not in set(known.fieldNames())]
    new += [path + f.name for f in fresh]
    return T.StructType(fields + fresh)


def evolve(known: T.StructType | None, found: T.StructType, mode: str) -> T.StructType:
    """The schema to use: fields once stored keep their types, new ones of any depth depend on the mode."""
    if known is None:
        return found
    new: list[str] = []
    widened = _widened(known, found, "", new)
    if not new or mode == RESCUE:
        return known
    if mode == FAIL:
        raise SchemaChanged(", ".join(new))
    return widened


def ingest_batch(lines: DataFrame, batch_id: int, sink: str, schema_dir: str, mode: str, rescued: str) -> None:
    """Write one batch below ``sink``, in a folder named after it: a replay overwrites it."""
    if mode not in (ADD, RESCUE, FAIL):
        raise ValueError(f"unknown mode {mode!r}")
    spark = lines.sparkSession
    known = stored_schema(spark, schema_dir, before=batch_id)
    found = known if known is not None and mode == RESCUE else infer_fields(lines)
    schema = evolve(known, found, mode)
    if schema != known and schema.fields:
        line = spark.createDataFrame([(schema.json(),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{schema_dir}/{BATCH}={batch_id}")
    parse_json_lines(lines, schema, rescued).write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")


def ingest_stream(
    spark: SparkSession,
    src: str,
    schema_dir: str,
    checkpoint: str,
    sink: str,
    mode: str = ADD,
    rescued: str = RESCUED,
    files_per_batch: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a stream that takes each new file of ``src`` once and appends it to ``sink``.

    By default it ends after the backlog; ``trigger={"processingTime": "5 minutes"}`` keeps
    it running. Started again with the same checkpoint it goes on where it stopped.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(lines: DataFrame, batch_id: int) -> None:
        ingest_batch(lines, batch_id, sink, schema_dir, mode, rescued)

    return (
        reader.load(src)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_ingested(spark: SparkSession, sink: str) -> DataFrame:
    """Everything ingested so far, columns of all batches together."""
    return spark.read.option("mergeSchema", "true").parquet(sink).drop(BATCH)

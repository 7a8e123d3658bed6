import pytest
from pyspark.sql import functions as F

from tablewright.operators import layout
from tablewright.sources import tables as io


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_compaction_of_partitions(spark, folder):
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.lit("a b/c")).when(F.col("id") % 4 < 3, F.lit("x")).alias("p"))
    df.repartition(12).write.partitionBy("p").parquet(f"{folder}/src")
    before = io.list_files(spark, f"{folder}/src")
    layout.compact(spark, f"{folder}/src", f"{folder}/all", by=["p"])
    after = io.list_files(spark, f"{folder}/all")
    assert before.count() > 30 and after.count() == 3
    assert same_rows(spark.read.parquet(f"{folder}/all").select("id", "p"), df)
    size = before.agg(F.sum("length")).first()[0]
    layout.compact(spark, f"{folder}/src", f"{folder}/some", target_bytes=size // 8, by=["p"], where="p = 'x'")
    some = io.list_files(spark, f"{folder}/some")
    assert 2 <= some.count() <= 6
    assert same_rows(spark.read.parquet(f"{folder}/some").select("id", "p"), df.filter("p = 'x'"))
    with pytest.raises(ValueError):
        layout.compact(spark, f"{folder}/src", f"{folder}/none", where="p = 'x'")


def test_compaction_of_null_and_plus_partitions(spark, folder):
    df = spark.range(600).select(
        "id", F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("int")).alias("n"),
        F.when(F.col("id") % 2 == 0, F.lit("a+b c%d")).alias("s"),
    )
    df.repartition(8).write.partitionBy("n", "s").parquet(f"{folder}/src")
    size = io.list_files(spark, f"{folder}/src").agg(F.sum("length")).first()[0]
    aimed = layout.compact(spark, f"{folder}/src", f"{folder}/all", by=["n", "s"])
    assert aimed == 6 and io.list_files(spark, f"{folder}/all").count() == 6
    assert same_rows(spark.read.parquet(f"{folder}/all").select("id", "n", "s"), df)
    assert layout.compact(spark, f"{folder}/src", f"{folder}/some", size // 30, ["n", "s"], where="n is null and s = 'a+b c%d'") > 1
    assert spark.read.parquet(f"{folder}/some").count() == 100


def test_files_of_a_scan(spark, folder):
    spark.range(1000).repartition(5).write.parquet(folder)
    found = layout.scanned_files(spark.read.parquet(folder), "t")
    listed = io.list_files(spark, folder).agg(F.sum("length"), F.count("*")).first()
    assert tuple(found.agg(F.sum("length"), F.count("*"), F.sum("row_count")).first()) == (*listed, 1000)


def test_dynamic_overwrite_leaves_other_partitions(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    io.write_partitioned(df, folder, ["p"])
    io.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), folder, ["p"])
    assert {tuple(r) for r in spark.read.parquet(folder).collect()} == {(1, "a"), (9, "b")}


def test_zorder_of_mixed_types_with_heavy_ties(spark):
    df = spark.range(4000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("name"), (F.col("id") % 50).cast("string"))).alias("s"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("d"),
        F.when(F.col("id") % 2 == 0, F.lit(7.0)).otherwise(F.col("id") / 3).alias("x"),
    )
    placed = layout.zorder(df, ["s", "d", "x"], 8)
    assert placed.columns == df.columns and same_rows(placed, df)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500
    with pytest.raises(ValueError):
        layout.zorder(df, list("abcde"), 8)


def test_zorder_separates_text_with_a_common_head(spark, folder):
    """Names that differ in their last characters only, and names that go on past the compared characters."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 100 > 0, F.concat(F.lit("Customer#of the house "), F.lpad(F.col("id").cast("string"), 9, "0"))).alias("n"),
        F.pmod(F.hash("id"), F.lit(1000)).alias("v"),
        F.concat(F.lit("x" * 30), F.col("id").cast("string")).alias("long"),
    )
    layout.zorder(df, ["n", "v"], 16).write.parquet(folder)
    found = spark.read.parquet(folder)
    assert same_rows(found, df)
    asked = {"n": (F.lit("Customer#of the house 000000501"), F.lit("Customer#of the house 000000520"))}
    assert layout.skipping_report(found, ["n"], asked).filter("must_read").count() <= 6
    assert same_rows(layout.zorder(df, ["long"], 4, text_chars=20), df)
    assert layout.zorder(df.filter("false"), ["n", "v"], 4).count() == 0
    assert layout.zorder(df.filter("n is null"), ["n"], 4).count() == 40


def test_bounds_of_text():
    values = sorted(f"name{i:04d}\u00e9" for i in range(1000))
    cuts = layout.separators(values, 8)
    assert cuts == sorted(set(cuts)) and len(cuts) == 7 and max(map(len, cuts)) <= 8
    sizes = [sum(a <= v < b for v in values) for a, b in zip(["", *cuts], [*cuts, "~"])]
    assert max(sizes) - min(sizes) <= 1
    assert layout.separators([], 8) == [] and layout.separators(["a"] * 50, 8) == ["a"]
    assert layout.separators(["", "a", "ab", "ab\n\"c"], 16) == ["a", "ab", "ab\n"]
    assert layout.curve_bits(16, 2) == 6 and all(layout.curve_bits(1 << 40, n) * n <= 62 for n in (1, 2, 3, 4))


def test_equal_rows_do_not_end_in_one_file(spark):
    df = spark.range(0, 8000, 1, 16).select(F.lit(1).alias("a"), F.lit(2).alias("b"))
    for placed in (layout.zorder(df, ["a", "b"], 8), layout.cluster(df, ["a", "b"], 8)):
        assert placed.groupBy(F.spark_partition_id()).count().count() >= 6


def test_health_thresholds(spark):
    small = [("many", f"f{i}", 1000) for i in range(1001)]
    fine = [("large", f"g{i}", 134_217_728) for i in range(1001)] + [("few", "h", 10)]
    files = spark.createDataFrame(small + fine, "table_name string, path string, length bigint")
    found = {r.table_name: r.status for r in layout.file_health(files).collect()}
    assert found == {"many": "NEEDS_OPTIMIZE", "large": "OK", "few": "OK"}


def test_partition_advice(spark):
    df = spark.range(1000).select(
        "id", (F.col("id") % 5).alias("even"), F.when(F.col("id") < 960, F.lit("big")).otherwise((F.col("id") % 7).cast("string")).alias("odd")
    )
    found = {r.column_name: r.advice for r in layout.partition_advice(df, ["id", "even", "odd"], max_values=100).collect()}
    assert found == {"id": "TOO_MANY_VALUES", "even": "OK", "odd": "SKEWED"}

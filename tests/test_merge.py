import pytest
from pyspark.sql import functions as F

from tablewright.operators.merge import DELETE, delete_where, merge, update_where


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "id int, v string")


def test_upsert_keeps_null_keys_apart(spark, target):
    source = spark.createDataFrame([(2, "B"), (9, "z"), (None, "N")], "id int, v string")
    merged = {(r.id, r.v) for r in merge(target, source, ["id"]).collect()}
    assert merged == {(1, "a"), (2, "B"), (3, None), (None, "n"), (9, "z"), (None, "N")}


def test_merge_twice_is_merge_once(spark):
    target = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    source = spark.createDataFrame([(i, f"w{i}") for i in range(25, 75)], "id int, v string")
    once = merge(target, source, ["id"])
    assert rows(merge(once, source, ["id"])) == rows(once)


def test_first_true_clause_wins(spark, target):
    source = spark.createDataFrame([(1, "x", 5), (2, "y", 50), (3, "z", 500)], "id int, v string, n int")
    clauses = [("s.n > 100", DELETE), ("s.n > 10", {"v": "concat(t.v, '+', s.v)"}), ("s.n > 0", {"v": F.lit("small")})]
    merged = {r.id: r.v for r in merge(target, source, ["id"], matched=clauses, not_matched=[]).collect()}
    assert merged == {1: "small", 2: "b+y", None: "n"}


def test_unknown_condition_is_not_true(spark, target):
    source = spark.createDataFrame([(3, "x")], "id int, v string")
    merged = merge(target, source, ["id"], matched=[("t.v = 'q'", DELETE)], not_matched=[])
    assert merged.count() == 4


def test_two_source_rows_for_one_target_row_are_an_error(spark, target):
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    for clauses in ([(None, "*")], [(None, DELETE)], [("s.v = 'x'", {"v": "s.v"})]):
        with pytest.raises(Exception, match="several source rows"):
            merge(target, source, ["id"], matched=clauses).collect()


def test_unmatched_duplicates_are_inserted(spark, target):
    source = spark.createDataFrame([(7, "x"), (7, "y")], "id int, v string")
    assert merge(target, source, ["id"]).filter("id = 7").count() == 2


def test_duplicate_target_rows_are_all_updated(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    source = spark.createDataFrame([(1, "x")], "id int, v string")
    assert rows(merge(target, source, ["id"])) == [(1, "x"), (1, "x")]


def test_composite_keys_and_evolution(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, l int, v string")
    source = spark.createDataFrame([(1, 2, 7.5), (2, 2, 8.5)], "k int, l int, extra double")
    merged = merge(target, source, ["k", "l"], evolve=True)
    assert merged.columns == ["k", "l", "v", "extra"]
    assert {tuple(r) for r in merged.collect()} == {(1, 1, "a", None), (1, 2, "b", 7.5), (2, 2, None, 8.5)}


def test_delete_and_update_with_unknown_predicates(spark, target):
    assert delete_where(target, "v = 'a'").count() == 3
    updated = {r.id: r.v for r in update_where(target, "v = 'a'", {"v": F.lit("A")}).collect()}
    assert updated == {1: "A", 2: "b", 3: None, None: "n"}


def test_update_sees_old_values(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(update_where(df, "true", {"a": "b", "b": "a"})) == [(2, 1)]


def test_columns_named_like_the_sides(spark):
    target = spark.createDataFrame([(1, "a", 1)], "t int, s string, `a b` int")
    source = spark.createDataFrame([(1, "b", 2), (2, "c", 3)], "t int, s string, `a b` int")
    assert rows(merge(target, source, ["t"])) == [(1, "b", 2), (2, "c", 3)]


def test_the_rest_of_an_on_clause(spark):
    target = spark.createDataFrame([(1, "old", False), (1, "new", True), (2, "gone", False), (None, "n", True)], "id int, v string, current boolean")
    source = spark.createDataFrame([(1, "A", None), (2, "B", None), (3, "C", None), (None, "N", None)], "id int, v string, current boolean")
    close = {"current": F.lit(False)}
    merged = merge(target, source, ["id"], [("t.v <> s.v", close)], [(None, {"id": "s.id", "v": "s.v", "current": F.lit(True)})], condition="t.current")
    assert {tuple(r) for r in merged.collect()} == {
        (1, "old", False), (1, "new", False), (2, "gone", False), (None, "n", True), (2, "B", True), (3, "C", True), (None, "N", True),
    }
    only = merge(target, source, ["id"], [(None, DELETE)], [], condition=F.col("t.current") & (F.col("s.v") == "A"))
    assert {r.v for r in only.collect()} == {"old", "gone", "n"}


def test_source_rows_that_a_condition_tells_apart_do_not_clash(spark):
    target = spark.createDataFrame([(1, 5), (1, 15)], "id int, n int")
    source = spark.createDataFrame([(1, 10), (1, 20)], "id int, n int")
    near = F.abs(F.col("s.n") - F.col("t.n")) == 5
    one = merge(target.filter("n = 5"), source, ["id"], [(None, "*")], [], condition=near)
    assert [tuple(r) for r in one.collect()] == [(1, 10)]
    with pytest.raises(Exception, match="several source rows"):
        merge(target, source, ["id"], [(None, "*")], [], condition=near).collect()


def test_scans_of_the_target(spark, folder):
    """One scan of whole rows and one of the keys; whether a source key occurs twice takes none."""
    spark.range(1000).select("id", F.lit("old").alias("v")).write.parquet(f"{folder}/target")
    spark.range(990, 1010).select(F.col("id").cast("int"), F.lit("new").alias("v")).write.parquet(f"{folder}/source")
    target, source = spark.read.parquet(f"{folder}/target"), spark.read.parquet(f"{folder}/source")

    def scans(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in text.splitlines() if "FileScan" in line and "ReadSchema: struct<id:bigint" in line]

    merged = merge(target, source, ["id"])
    found = scans(merged)
    assert len(found) == 2 and sum("ReadSchema: struct<id:bigint>" in line for line in found) == 1
    assert len(scans(merge(target, source, ["id"], not_matched=[]))) == 1
    assert merged.groupBy("v").count().orderBy("v").collect() == [("new", 20), ("old", 990)]


def test_copies_in_the_source_matter_only_where_they_match(spark, target):
    """Repeated keys, NULL ones too, are inserted when the target lacks them and refused when it has them."""
    source = spark.createDataFrame([(8, "x"), (8, "x"), (None, "p"), (None, "q"), (1, "A")], "id int, v string")
    merged = sorted((repr(r.id), r.v) for r in merge(target, source, ["id"]).collect() if r.id in (8, None, 1))
    assert merged == [("1", "A"), ("8", "x"), ("8", "x"), ("None", "n"), ("None", "p"), ("None", "q")]
    for matched in ([(None, DELETE)], [("false", "*")], [(None, "*")]):
        with pytest.raises(Exception, match="several source rows"):
            merge(target, source.unionByName(source.filter("id = 1")), ["id"], matched=matched).collect()

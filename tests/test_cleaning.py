from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewright.functions import columns as fn
from tablewright.functions import masks
from tablewright.operators.clean import assign_identity, clean, dedup, with_defaults, with_generated
from tablewright.operators.profile import ndv_counts, null_counts, numeric_columns, profile, quantiles, top_values
from tablewright.operators.quality import QualityError, assert_quality, not_null, quality_report, quality_split


def test_bad_text_gives_null(spark):
    df = spark.createDataFrame([("12", "2024-02-30"), ("x", "2024-02-29"), (None, None)], "n string, d string")
    found = df.select(fn.safe_cast("n", "int").alias("n"), fn.safe_date("d").alias("d")).collect()
    assert [tuple(r) for r in found] == [(12, None), (None, date(2024, 2, 29)), (None, None)]


def test_fill_by_column_wins_when_it_comes_first(spark):
    df = spark.createDataFrame([(1, None, None)], "id int, country string, city string")
    found = clean(df, fills={"country": "Unknown"}, text_fill="N/A").first()
    assert (found.country, found.city) == ("Unknown", "N/A")
    late = df.fillna("N/A").na.fill({"country": "Unknown"}).first()
    assert late.country == "N/A"


def test_first_row_needs_an_order(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, v string").repartition(3)
    assert {tuple(r) for r in dedup(df, ["id"], ["v"]).collect()} == {(1, "a"), (2, "c")}
    assert dedup(df, ["id"], ["v"]).columns == ["id", "v"]


def test_trim_takes_spaces_only(spark):
    assert spark.createDataFrame([("  a\t ",)], "s string").select(F.trim("s")).first()[0] == "a\t"


def test_defaults(spark):
    df = spark.createDataFrame([(1, None)], "id int, c string")
    assert with_defaults(df, {"c": "UNK", "d": 5}).first().asDict() == {"id": 1, "c": None, "d": 5}
    assert with_defaults(df, {"c": "UNK"}, fill_nulls=True).first().c == "UNK"


def test_generated_columns_are_checked(spark):
    df = spark.createDataFrame([(2, 4)], "a int, b int")
    assert with_generated(df, {"b": "a * 2", "c": "a + 1"}).first().asDict() == {"a": 2, "b": 4, "c": 3}
    with pytest.raises(Exception, match="differs from its generation"):
        with_generated(df, {"b": "a * 3"}).collect()


def test_identity(spark):
    df = assign_identity(spark.range(100).repartition(7), "new", 1000)
    first, second = ([r.new for r in df.collect()] for _ in range(2))
    assert first == second and len(set(first)) == 100 and min(first) >= 1000


def test_quality(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (3, None)], "id int, amount double")
    rules = {"id_present": not_null("id"), "non_negative": "amount >= 0"}
    valid, quarantined = quality_split(df, rules)
    assert [r.id for r in valid.collect()] == [1, 3]
    assert [r._failed_rules for r in quarantined.collect()] == [["id_present", "non_negative"]]
    report = quality_report(df, rules)
    assert {r.rule_name: (r.checked, r.failed) for r in report.collect()} == {"id_present": (3, 1), "non_negative": (3, 1)}
    assert_quality(report, 0.5)
    with pytest.raises(QualityError, match="non_negative"):
        assert_quality(report, 0.1)
    assert quality_report(df.limit(0), rules).first().failure_rate == 0.0


def test_profile_knows_every_numeric_type(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(18,2)) a, CAST(1 AS SMALLINT) b, CAST(1 AS TINYINT) c, 1.5F d, 'x' e, true f")
    assert numeric_columns(df) == ["a", "b", "c", "d"]
    found = {r.column_name: r for r in profile(df).collect()}
    assert found["a"].median == "1.0" and found["e"].median is None and found["f"].ndv == 1


def test_profile_against_exact_values(spark):
    df = spark.range(10_000).select("id", (F.col("id") % 97).alias("m"), F.when(F.col("id") % 4 > 0, F.lit("x")).alias("t"))
    found = {r.column_name: r for r in profile(df).collect()}
    assert abs(found["id"].ndv - 10_000) < 1000 and abs(found["m"].ndv - 97) < 10
    assert abs(float(found["id"].median) - 5000) <= 100
    assert {r.column_name: r.nulls for r in null_counts(df).collect()} == {"id": 0, "m": 0, "t": 2500}
    assert {r.column_name for r in ndv_counts(df).collect()} == {"id", "m", "t"}
    ends = {(r.column_name, r.probability): r.value for r in quantiles(df, ["id"]).collect()}
    assert ends[("id", 0.0)] == 0 and ends[("id", 1.0)] == 9999


def test_top_values_of_text_and_booleans(spark):
    df = spark.range(1000).select((F.col("id") % 30).cast("string").alias("t"), (F.col("id") < 10).alias("b"), "id")
    found = top_values(df, n=2).collect()
    assert {(r.column_name, r.value, r.row_count, r.position) for r in found} == {
        ("t", "0", 34, 1), ("t", "1", 34, 2), ("b", "false", 990, 1), ("b", "true", 10, 2),
    }


def test_masks(spark):
    df = spark.createDataFrame([("a@b.com", 150000.0), ("nodomain", 10.0), (None, None)], "e string, s double")

    def emails(groups):
        return [r[0] for r in df.select(masks.mask_email(F.col("e"), groups)).collect()]

    assert emails({masks.CUSTOMER_SERVICE, masks.ANALYSTS}) == ["a@b.com", "nodomain", None]
    assert emails({masks.ANALYSTS}) == ["***@b.com", "***@***.com", None]
    assert emails(set()) == ["***@***.com"] * 3
    capped = df.select(masks.mask_salary(F.col("s"), {masks.MANAGERS}).alias("s"))
    assert [None if r.s is None else str(r.s) for r in capped.collect()] == ["100000.00", "10.00", None]
    assert dict(capped.dtypes)["s"] == "decimal(10,2)"


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame([(1, {"k": 1}), (None, None)], "`a.b` int, m map<string,int>")
    assert {r["column_name"]: r["nulls"] for r in null_counts(df).collect()} == {"a.b": 1, "m": 1}
    found = {r["column_name"]: r for r in profile(df, ["a.b"]).collect()}
    assert (found["a.b"]["min"], found["a.b"]["max"]) == ("1", "1")

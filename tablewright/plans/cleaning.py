"""Cleaning, quality rules, the write contract, and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.operators import clean as ops
from tablewright.operators import profile as profiling
from tablewright.operators import quality
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables

# The spellings mapped to one.
COUNTRY_NAMES = {"US": "USA", "U.S.": "USA"}


@query(
    f"""WITH {inputs.PEOPLE} SELECT "userId", coalesce(country, 'Unknown') AS country, coalesce(price, 0) AS price FROM people"""
)
def fill_by_column(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", "country", "price").na.fill({"country": "Unknown", "price": 0})


@query(
    f"""WITH {inputs.PEOPLE} SELECT "userId", coalesce(country, 'N/A') AS country, coalesce(age, 'N/A') AS age, price FROM people"""
)
def fill_all_strings(t: Tables) -> DataFrame:
    """Only text columns are filled; the price keeps its NULLs."""
    return inputs.people(t).select("userId", "country", "age", "price").fillna("N/A")


@query(f'WITH {inputs.PEOPLE} SELECT "userId", country FROM people WHERE country IS NOT NULL')
def drop_null_key(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", "country").dropna(how="any", subset=["country"])


@query(
    f"""WITH {inputs.PEOPLE} SELECT "userId", CASE WHEN country IN ('US', 'U.S.') THEN 'USA' ELSE country END AS country
    FROM people"""
)
def replace_values(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", "country").replace(COUNTRY_NAMES, subset=["country"])


@query(
    f"""WITH {inputs.PEOPLE},
    typed AS (
      SELECT "userId" AS user_id,
        CASE WHEN country IN ('US', 'U.S.') THEN 'USA' ELSE coalesce(country, 'Unknown') END AS country,
        TRY_CAST(coalesce(age, '0') AS INTEGER) AS age, date_str,
        CAST(try_strptime(date_str, '%Y-%m-%d') AS DATE) AS dt, lower(gender) AS gender, trim(email) AS email,
        regexp_replace(phone, '\\D', '', 'g') AS phone, regexp_replace(name, '\\s+', ' ', 'g') AS name, price
      FROM people)
    SELECT * FROM typed WHERE age >= 0 AND age <= 120 AND price IS NOT NULL"""
)
def clean_pipeline(t: Tables) -> DataFrame:
    """All cleaning steps on untidy person records that were delivered twice."""
    people = inputs.people(t)
    return ops.clean(
        people.unionByName(people),
        fills={"country": "Unknown", "age": "0"},
        text_fill="N/A",
        required=["userId"],
        unique_by=["userId"],
        unique_order=["name"],
        casts={"age": "int"},
        dates={"dt": ("date_str", "yyyy-MM-dd")},
        replacements={"country": COUNTRY_NAMES},
        lower=["gender"],
        trim=["email"],
        digits=["phone"],
        squeeze=["name"],
        keep=["age >= 0 AND age <= 120", "price IS NOT NULL"],
        drop=["temp_flag"],
        rename={"userId": "user_id"},
    )


def _rules() -> dict:
    return {
        "country_present": quality.not_null("country"),
        "amount_below_limit": F.col("amount") < 400_000,
        "not_before_1996": "ts >= TIMESTAMP_NTZ '1996-01-01'",
    }


_FAILURES = """concat_ws(',', CASE WHEN country IS NULL THEN 'country_present' END,
      CASE WHEN NOT coalesce(amount < 400000, TRUE) THEN 'amount_below_limit' END,
      CASE WHEN NOT coalesce(ts >= TIMESTAMP '1996-01-01', TRUE) THEN 'not_before_1996' END)"""


@query(f"WITH {inputs.SALES} SELECT id, {_FAILURES} = '' AS valid, {_FAILURES} AS failed_rules FROM sales")
def quality_rules(t: Tables) -> DataFrame:
    """Each row with its verdict and the names of the rules it breaks, in one pass."""
    checked = quality.with_failures(inputs.sales(t), _rules())
    return checked.select(
        "id", (F.size(quality.FAILED) == 0).alias("valid"), F.concat_ws(",", quality.FAILED).alias("failed_rules")
    )


@query(
    f"""WITH {inputs.SALES}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE country IS NULL) AS a,
      count(*) FILTER (WHERE amount >= 400000) AS b, count(*) FILTER (WHERE ts < TIMESTAMP '1996-01-01') AS d FROM sales)
    SELECT 'country_present' AS rule_name, n AS checked, a AS failed, a / n AS failure_rate FROM c
    UNION ALL SELECT 'amount_below_limit', n, b, b / n FROM c
    UNION ALL SELECT 'not_before_1996', n, d, d / n FROM c"""
)
def quality_report(t: Tables) -> DataFrame:
    return quality.quality_report(inputs.sales(t), _rules())


@query(
    f"""WITH {inputs.SALES} SELECT id, ts, coalesce(country, 'UNK') AS country, amount, 'web' AS channel FROM sales"""
)
def write_defaults(t: Tables) -> DataFrame:
    """A missing column gets its default, and on demand NULLs do."""
    return ops.with_defaults(inputs.sales(t), {"country": "UNK", "channel": "web"}, fill_nulls=True)


@query(f"WITH {inputs.SALES} SELECT id, ts, CAST(ts AS DATE) AS dt FROM sales")
def write_generated(t: Tables) -> DataFrame:
    """Derived once, and once more as a check of the supplied value."""
    dated = ops.with_generated(inputs.sales(t).select("id", "ts"), {"dt": "CAST(ts AS DATE)"})
    return ops.with_generated(dated, {"dt": "CAST(ts AS DATE)"})


@query(
    """SELECT count(*) AS row_count, count(*) AS numbered, TRUE AS beyond_existing FROM customer"""
)
def assign_identity(t: Tables) -> DataFrame:
    """Customers numbered upwards from the largest supplier key."""
    largest = t.supplier.agg(F.coalesce(F.max("s_suppkey"), F.lit(0))).first()[0]
    numbered = ops.assign_identity(t.customer, "id", largest + 1)
    return numbered.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("id").alias("numbered"),
        (F.min("id") > largest).alias("beyond_existing"),
    )


@query(
    f"""SELECT column_name, count(*) AS row_count, count(*) - count(v) AS nulls, min(v) AS min_value, max(v) AS max_value,
      min(s) AS min_text, max(s) AS max_text, TRUE AS ndv_plausible, TRUE AS median_inside
    FROM (SELECT 'o_orderkey' AS column_name, CAST(o_orderkey AS DOUBLE) AS v, NULL AS s FROM orders
          UNION ALL SELECT 'o_custkey', CAST(o_custkey AS DOUBLE), NULL FROM orders
          UNION ALL SELECT 'o_totalprice', o_totalprice, NULL FROM orders) GROUP BY column_name
    UNION ALL
    SELECT column_name, count(*), count(*) - count(s), NULL, NULL, min(s), max(s), TRUE, NULL
    FROM (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS s FROM orders
          UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
          UNION ALL SELECT 'o_orderdate', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') FROM orders) GROUP BY column_name"""
)
def profile_table(t: Tables) -> DataFrame:
    """Rows, NULLs, distinct values, minimum, median and maximum in one pass."""
    measured = profiling.profile(t.orders)
    numeric = F.col("column_name").isin(profiling.numeric_columns(t.orders))
    low, middle, high = (F.when(numeric, F.col(c).try_cast("double")) for c in ("min", "median", "max"))
    filled = F.col("row_count") - F.col("nulls")
    return measured.select(
        "column_name",
        "row_count",
        "nulls",
        low.alias("min_value"),
        high.alias("max_value"),
        F.when(~numeric, F.col("min")).alias("min_text"),
        F.when(~numeric, F.col("max")).alias("max_text"),
        # The estimate is off by a few percent at most, and never beyond the filled rows by more.
        ((F.col("ndv") >= 1) & (F.col("ndv") <= filled * 1.2)).alias("ndv_plausible"),
        ((low <= middle) & (middle <= high)).alias("median_inside"),
    )


@query(
    """SELECT column_name, probability, TRUE AS close FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey'), ('l_linenumber'),
        ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) c(column_name),
      (VALUES (CAST(0 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(1 AS DOUBLE))) p(probability)"""
)
def quantiles(t: Tables) -> DataFrame:
    """Minimum, median and maximum; the rank each estimate has is checked in one more pass."""
    columns = profiling.numeric_columns(t.lineitem)
    found = profiling.quantiles(t.lineitem)
    values = found.groupBy().pivot("column_name", columns).agg(F.sort_array(F.collect_list(F.struct("probability", "value"))))
    # One row with three numbers a column beside the table.
    ranks = values.select(*[F.col(f"{c}.value").alias(f"q_{c}") for c in columns])
    points = {c: ranks.select(f"q_{c}").scalar() for c in columns}
    counted = t.lineitem.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.struct(F.count_if(F.col(c) < points[c][i]).alias("below"), F.count_if(F.col(c) <= points[c][i]).alias("upto")).alias(
                f"{c}_{i}"
            )
            for c in columns
            for i in range(3)
        ],
    )
    names = [f"{c}_{i}" for c in columns for i in range(3)]
    long = counted.unpivot("n", names, "name", "r")
    probability = F.element_at(F.split("name", "_"), -1).cast("double") / 2
    off = F.greatest(F.col("r.below") / F.col("n") - probability, probability - F.col("r.upto") / F.col("n"))
    return long.select(
        F.regexp_extract("name", r"^(.*)_\d$", 1).alias("column_name"),
        probability.alias("probability"),
        (off <= 0.01).alias("close"),
    )


@query(
    """WITH long AS (
      SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
      UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
      UNION ALL SELECT 'o_month', strftime(o_orderdate, '%Y-%m') FROM orders)
    SELECT * FROM (SELECT column_name, value, count(*) AS row_count,
      row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS position
    FROM long GROUP BY column_name, value) WHERE position <= 20"""
)
def top_values(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("o_month", F.date_format("o_orderdate", "yyyy-MM"))
    return profiling.top_values(orders, ["o_orderstatus", "o_orderpriority", "o_month"])

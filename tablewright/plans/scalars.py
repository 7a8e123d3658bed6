"""Scalar functions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tablewright.functions import columns as fn
from tablewright.operators.scd import OPEN_END
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables


@query(f"WITH {inputs.PEOPLE} SELECT \"userId\", concat_ws(', ', name, country, age) AS full_address FROM people")
def str_concat_ws(t: Tables) -> DataFrame:
    """NULLs are skipped, separator and all."""
    return inputs.people(t).select("userId", F.concat_ws(", ", "name", "country", "age").alias("full_address"))


@query(f"WITH {inputs.PEOPLE} SELECT \"userId\", name || '/' || country AS label FROM people")
def str_concat(t: Tables) -> DataFrame:
    """One NULL makes the whole NULL."""
    return inputs.people(t).select("userId", F.concat("name", F.lit("/"), "country").alias("label"))


@query("SELECT p_partkey, regexp_extract(p_brand || p_type, '([A-Z]+)', 1) AS product_code, "
       "regexp_extract(p_name, '([A-Z]+)', 1) AS no_code FROM part")
def str_regexp_extract(t: Tables) -> DataFrame:
    """The first run of capitals; text without one gives an empty string."""
    label = F.concat("p_brand", "p_type")
    return t.part.select(
        "p_partkey",
        F.regexp_extract(label, r"([A-Z]+)", 1).alias("product_code"),
        F.regexp_extract("p_name", r"([A-Z]+)", 1).alias("no_code"),
    )


@query("""SELECT doc_id, len(string_split(text, ',')) AS pieces, string_split(text, ',')[1] AS first_piece
    FROM documents""")
def str_split(t: Tables) -> DataFrame:
    pieces = F.split("text", ",")
    return t.documents.select(
        "doc_id", F.size(pieces).cast("bigint").alias("pieces"), pieces[0].alias("first_piece")
    )


@query(f"WITH {inputs.STAFF} SELECT customer_id, string_split(email, '@')[2] AS domain FROM staff")
def str_element(t: Tables) -> DataFrame:
    """The second piece, NULL where there is none."""
    return inputs.staff(t).select("customer_id", fn.second_piece(F.col("email"), "@").alias("domain"))


@query(f'WITH {inputs.PEOPLE} SELECT "userId", lower(gender) AS gender FROM people')
def str_lower(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", F.lower("gender").alias("gender"))


@query(f'WITH {inputs.PEOPLE} SELECT "userId", trim(email) AS email FROM people')
def str_trim(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", F.trim("email").alias("email"))


@query(f"""WITH {inputs.PEOPLE} SELECT "userId", regexp_replace(phone, '\\D', '', 'g') AS phone FROM people""")
def str_digits_only(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", fn.digits_only("phone").alias("phone"))


@query(f"""WITH {inputs.PEOPLE} SELECT "userId", regexp_replace(name, '\\s+', ' ', 'g') AS name FROM people""")
def str_collapse_space(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", fn.collapse_space("name").alias("name"))


def row_hash_sql(*columns: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


@query(f"""WITH {inputs.PEOPLE} SELECT "userId", {row_hash_sql('"userId"', "name", "country", "age")} AS record_hash FROM people""")
def row_hash(t: Tables) -> DataFrame:
    return inputs.people(t).select("userId", fn.row_hash("userId", "name", "country", "age").alias("record_hash"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def date_year(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_ship
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def date_datediff(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.datediff("l_shipdate", "o_orderdate")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days_to_ship"))


@query("SELECT event_id, strftime(ts, '%H') AS order_hour FROM events")
def date_hour(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.date_format("ts", "HH").alias("order_hour"))


@query(f"""WITH {inputs.PEOPLE} SELECT "userId", CAST(try_strptime(date_str, '%Y-%m-%d') AS DATE) AS dt FROM people""")
def date_parse(t: Tables) -> DataFrame:
    """Text in another format gives NULL instead of an error."""
    return inputs.people(t).select("userId", fn.safe_date("date_str").alias("dt"))


@query("SELECT event_id, CAST(ts AS DATE) AS dt FROM events")
def date_cast(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.to_date("ts").alias("dt"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 365 AS DATE) AS a_year_before FROM orders")
def date_sub_days(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.date_sub("o_orderdate", 365).alias("a_year_before"))


@query(
    """SELECT event_id, ts - INTERVAL 7 DAY AS week_before, ts - INTERVAL 24 HOUR AS day_before,
      ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR AS is_recent FROM events"""
)
def interval_sub(t: Tables) -> DataFrame:
    start = fn.moment(inputs.AUDIT_NOW - timedelta(hours=24))
    return t.events.select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 7 DAYS")).alias("week_before"),
        (F.col("ts") - F.expr("INTERVAL 24 HOURS")).alias("day_before"),
        (F.col("ts") >= start).alias("is_recent"),
    )


@query("SELECT o_orderkey, TIMESTAMP '2999-12-31 00:00:00' AS effective_end FROM orders")
def ts_literal(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.lit(OPEN_END).cast("timestamp_ntz").alias("effective_end"))


@query(
    """SELECT o_orderkey, TIMESTAMP '2024-01-30 12:00:00' AS loaded_at, DATE '2024-01-30' AS loaded_on FROM orders"""
)
def now_stamp(t: Tables) -> DataFrame:
    """The time of a run as an argument: a repeated run gives the same rows."""
    now: datetime = inputs.AUDIT_NOW
    return t.orders.select(
        "o_orderkey", fn.moment(now).alias("loaded_at"), F.lit(now.date()).alias("loaded_on")
    )


@query(
    f"""WITH {inputs.PEOPLE} SELECT "userId", TRY_CAST(age AS INTEGER) AS age,
      TRY_CAST(price AS DECIMAL(18,2)) AS price FROM people"""
)
def safe_cast(t: Tables) -> DataFrame:
    return inputs.people(t).select(
        "userId", fn.safe_cast("age", "int").alias("age"), fn.safe_cast("price", "decimal(18,2)").alias("price")
    )


@query("SELECT user_id, CAST(sum(CAST(value > 20 AS INTEGER)) AS BIGINT) AS n_large FROM events GROUP BY user_id")
def bool_to_int(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.sum((F.col("value") > 20).cast("int")).alias("n_large"))


@query(f'WITH {inputs.STAFF} SELECT customer_id AS id, email AS mail, department FROM staff')
def nest_struct(t: Tables) -> DataFrame:
    """Columns put into a struct, and its fields read back."""
    nested = inputs.staff(t).withColumn("customer_details", F.struct("customer_id", "email"))
    return nested.select(
        F.col("customer_details.customer_id").alias("id"), F.col("customer_details.email").alias("mail"), "department"
    )


@query(f"WITH {inputs.STAFF} SELECT customer_id AS order_id, customer_id, email FROM staff")
def flatten_struct(t: Tables) -> DataFrame:
    """A struct spread into columns; all others are left out."""
    nested = inputs.staff(t).select(
        F.col("customer_id").alias("order_id"), "department", F.struct("customer_id", "email").alias("customer_details")
    )
    return nested.select("order_id", "customer_details.*")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS product_item FROM part")
def explode_array(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("product_item"))


@query(
    """SELECT user_id, max(CAST(ts AS DATE)) AS last_day,
      arg_max_null(event_id, (CAST(ts AS DATE), event_id)) AS last_event,
      arg_max_null(event_type, (CAST(ts AS DATE), event_id)) AS last_type
    FROM events GROUP BY user_id"""
)
def struct_compare(t: Tables) -> DataFrame:
    """Pairs of day and id compared from left to right."""
    place = F.struct(F.to_date("ts").alias("day"), "event_id")
    last = t.events.groupBy("user_id").agg(F.max(F.struct(place.alias("at"), "event_type")).alias("m"))
    return last.select(
        "user_id",
        F.col("m.at.day").alias("last_day"),
        F.col("m.at.event_id").alias("last_event"),
        F.col("m.event_type").alias("last_type"),
    )


@query("SELECT c_custkey, c_acctbal / NULLIF(c_nationkey, 0) AS per_nation FROM customer")
def safe_divide(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", fn.safe_divide(F.col("c_acctbal"), F.col("c_nationkey")).alias("per_nation"))

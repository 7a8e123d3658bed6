"""Row filters, column masks and access-log reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tablewright.functions import masks
from tablewright.operators import audit
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables


@query(
    f"""WITH {inputs.STAFF}
    SELECT customer_id, department, 'finance' AS caller FROM staff
    UNION ALL SELECT customer_id, department, 'sales' FROM staff WHERE department = 'Sales'
    UNION ALL SELECT customer_id, department, 'marketing' FROM staff WHERE department IN ('Sales', 'Marketing')"""
)
def row_filter(t: Tables) -> DataFrame:
    """What callers of each group see; one without a group sees nothing."""
    callers = {
        "finance": {masks.FINANCE, masks.SALES},
        "sales": {masks.SALES, masks.MARKETING},
        "marketing": {masks.MARKETING},
        "nobody": set(),
    }
    rows = inputs.staff(t).select("customer_id", "department")
    seen = [
        audit.row_filter(rows, masks.department_policy(F.col("department"), groups)).withColumn("caller", F.lit(name))
        for name, groups in callers.items()
    ]
    return reduce(DataFrame.unionByName, seen)


@query(
    f"""WITH {inputs.STAFF}
    SELECT customer_id, email AS for_service,
      CASE WHEN email IS NULL THEN NULL WHEN position('@' IN email) = 0 THEN '***@***.com'
           ELSE '***@' || split_part(email, '@', 2) END AS for_analysts,
      '***@***.com' AS for_others FROM staff"""
)
def mask_email(t: Tables) -> DataFrame:
    email = F.col("email")
    return inputs.staff(t).select(
        "customer_id",
        masks.mask_email(email, {masks.CUSTOMER_SERVICE}).alias("for_service"),
        masks.mask_email(email, {masks.ANALYSTS}).alias("for_analysts"),
        masks.mask_email(email, set()).alias("for_others"),
    )


@query(
    f"""WITH {inputs.STAFF}
    SELECT customer_id, CAST(salary AS DOUBLE) AS for_hr,
      CAST(CASE WHEN salary > 100000 THEN 100000.00 ELSE salary END AS DOUBLE) AS for_managers,
      CAST(NULL AS DOUBLE) AS for_others FROM staff"""
)
def mask_salary(t: Tables) -> DataFrame:
    salary = F.col("salary")
    return inputs.staff(t).select(
        "customer_id",
        masks.mask_salary(salary, {masks.HR}).cast("double").alias("for_hr"),
        masks.mask_salary(salary, {masks.MANAGERS}).cast("double").alias("for_managers"),
        masks.mask_salary(salary, set()).cast("double").alias("for_others"),
    )


@query(
    f"""WITH {inputs.STAFF}
    SELECT customer_id, department, CAST(NULL AS VARCHAR) AS email_masked, 'anyone' AS caller FROM staff
    UNION ALL SELECT customer_id, department, email, 'reader' FROM staff"""
)
def secure_view(t: Tables) -> DataFrame:
    """A fixed list of columns; personal data only for its readers."""

    def view(name: str, groups: set[str]) -> DataFrame:
        return inputs.staff(t).select(
            "customer_id",
            "department",
            masks.only_for(F.col("email"), masks.PII_READERS, groups).alias("email_masked"),
            F.lit(name).alias("caller"),
        )

    return view("anyone", set()).unionByName(view("reader", {masks.PII_READERS}))


@query(
    f"""WITH {inputs.AUDIT}
    SELECT event_time, email AS user_email, action_name, resource AS object_name, source_ip_address FROM audit
    WHERE action_name IN {inputs.AUDIT_ACTIONS_SQL} AND resource LIKE 'production_data%'
      AND event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY
    ORDER BY event_time DESC, user_email, action_name, object_name, source_ip_address LIMIT 100"""
)
def audit_recent(t: Tables) -> DataFrame:
    return audit.audit_recent(inputs.audit_log(t), inputs.AUDIT_ACTIONS, "production_data", inputs.AUDIT_NOW)


@query(
    f"""WITH {inputs.AUDIT}
    SELECT email, count(*) AS action_count, count(DISTINCT resource) AS unique_resources, max(event_time) AS last_activity
    FROM audit WHERE action_name IN {inputs.AUDIT_ACTIONS_SQL}
      AND event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 240 HOUR
    GROUP BY email HAVING count(*) > 20"""
)
def audit_active_users(t: Tables) -> DataFrame:
    """Users with more than 20 actions in ten days."""
    return audit.audit_active_users(inputs.audit_log(t), inputs.AUDIT_ACTIONS, inputs.AUDIT_NOW, 240, 20)

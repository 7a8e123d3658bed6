"""Row filters and column masks. The caller's groups are an argument, never looked up."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, functions as F

from tablewright.functions.columns import second_piece

# Group names, visible departments, masks and the salary cap.
FINANCE = "finance-team@company.com"
SALES = "sales-team@company.com"
MARKETING = "marketing-team@company.com"
CUSTOMER_SERVICE = "customer-service@company.com"
ANALYSTS = "analysts@company.com"
HR = "hr-team@company.com"
MANAGERS = "managers@company.com"
PII_READERS = "pii_readers"
SALES_DEPARTMENT = "Sales"
MARKETING_DEPARTMENT = "Marketing"
MASKED_USER = "***@"
MASKED_EMAIL = "***@***.com"
SALARY_CAP = "100000.00"
SALARY_TYPE = "decimal(10,2)"


def department_policy(department: Column, groups: Collection[str]) -> Column:
    """Which departments the caller sees; the widest right is looked at first."""
    if FINANCE in groups:
        return F.lit(True)
    visible = {SALES: [SALES_DEPARTMENT], MARKETING: [SALES_DEPARTMENT, MARKETING_DEPARTMENT]}
    for group, departments in visible.items():
        if group in groups:
            return department.isin(departments)
    return F.lit(False)


def mask_email(email: Column, groups: Collection[str]) -> Column:
    """Full, domain only, or nothing; an address without a domain is masked entirely."""
    if CUSTOMER_SERVICE in groups:
        return email
    if ANALYSTS in groups:
        domain = F.concat(F.lit(MASKED_USER), second_piece(email, "@"))
        return F.when(email.isNotNull(), F.coalesce(domain, F.lit(MASKED_EMAIL)))
    return F.lit(MASKED_EMAIL)


def mask_salary(salary: Column, groups: Collection[str]) -> Column:
    salary = salary.cast(SALARY_TYPE)
    if HR in groups:
        return salary
    if MANAGERS in groups:
        cap = F.lit(SALARY_CAP).cast(SALARY_TYPE)
        return F.when(salary > cap, cap).otherwise(salary)
    return F.lit(None).cast(SALARY_TYPE)


def only_for(column: Column, group: str, groups: Collection[str]) -> Column:
    """The value for members of the group, a NULL of the same type for all others."""
    return F.when(F.lit(group in groups), column)

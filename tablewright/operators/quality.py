"""Quality rules: valid and quarantined rows, failure rates, and a circuit breaker."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.columns import as_column

FAILED = "_failed_rules"

Rules = Mapping[str, "Column | str"]


class QualityError(Exception):
    """More rows break a rule than the caller tolerates."""


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def _passes(rule: Column | str) -> Column:
    """A check passes where it is unknown, as in SQL; ``not_null`` is a rule of its own."""
    return F.coalesce(as_column(rule), F.lit(True))


def with_failures(df: DataFrame, rules: Rules) -> DataFrame:
    """Add the names of the rules each row breaks."""
    names = [F.when(~_passes(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(FAILED, F.array_compact(F.array(*names)))


def quality_split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with the names of the broken rules)."""
    checked = with_failures(df, rules)
    return (
        checked.filter(F.size(FAILED) == 0).drop(FAILED),
        checked.filter(F.size(FAILED) > 0),
    )


def quality_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Per rule: rows checked, rows failed, rate. One pass over the table."""
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(~_passes(rule)).alias(n) for n, rule in rules.items()]
    )
    return counts.unpivot("__rows", names, "rule_name", "failed").select(
        "rule_name",
        F.col("__rows").alias("checked"),
        "failed",
        F.coalesce(F.try_divide("failed", "__rows"), F.lit(0.0)).alias("failure_rate"),
    )


def assert_quality(report: DataFrame, max_rate: float) -> None:
    """Raise when a rule fails for more than ``max_rate`` of the rows."""
    broken = report.filter(F.col("failure_rate") > max_rate).collect()  # one row per rule
    if broken:
        raise QualityError(", ".join(f"{r['rule_name']}: {r['failure_rate']:.4f}" for r in broken))

"""Data-quality expectations (CHECK / NOT NULL constraints as Spark jobs).

A rule is violated when its condition is FALSE; NULL passes, as in SQL
CHECK constraints. Use ``F.col(c).isNotNull()`` for a NOT NULL rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatt import constants as K


class ExpectationFailed(ValueError):
    pass


def silver_rules() -> dict[str, Column]:
    """The silver table's constraints."""
    return {
        "chk_production_positive": F.col("production_kwh").isNull() | (F.col("production_kwh") >= 0),
        "chk_technology_valid": F.col("technology").isin(*K.TECHNOLOGIES),
    }


def _violated(cond: Column) -> Column:
    return ~F.coalesce(cond, F.lit(True))


def with_failed_rules(df: DataFrame, rules: dict[str, Column], column: str = "failed_rules") -> DataFrame:
    """Add a comma-separated list of the rules each row violates ('' if none)."""
    names = [F.when(_violated(c), F.lit(n)) for n, c in rules.items()]
    return df.withColumn(column, F.concat_ws(",", *names))


def violation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, violations — one global aggregate pass (partial per task)."""
    agg = df.agg(*[F.sum(F.when(_violated(c), 1).otherwise(0)).cast("bigint").alias(n)
                   for n, c in rules.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in rules)
    return agg.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, violations)")


def quarantine(df: DataFrame, rules: dict[str, Column], column: str = "failed_rules"
               ) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their failed rule names)."""
    tagged = with_failed_rules(df, rules, column)
    return (tagged.filter(F.col(column) == "").drop(column),
            tagged.filter(F.col(column) != ""))


def enforce(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with the constraints checked *inside* its own plan: the first
    violating row fails the job that consumes it (e.g. the write), so the
    check costs no extra pass over the data. Use with sinks that publish
    atomically (versioned tables), as a failed plain overwrite leaves its
    target emptied."""
    checks = [F.when(_violated(c), F.raise_error(F.lit(f"constraint {n} violated"))) for n, c in rules.items()]
    ok = F.coalesce(*checks, F.lit(True)) if checks else F.lit(True)
    return df.filter(ok.cast("boolean"))


def expect(df: DataFrame, rules: dict[str, Column], mode: str = "fail"):
    """Apply constraints. ``fail``: raise if any row violates (one aggregate
    job) and return ``df``; ``enforce``: the same check folded into ``df``'s
    plan (fails when it runs, no extra job); ``quarantine``: (valid,
    quarantined); ``report``: violation counts per rule."""
    if mode == "enforce":
        return enforce(df, rules)
    if mode == "report":
        return violation_report(df, rules)
    if mode == "quarantine":
        return quarantine(df, rules)
    if mode == "fail":
        counts = {r["rule"]: r["violations"] for r in violation_report(df, rules).collect()}
        bad = {k: v for k, v in counts.items() if v}
        if bad:
            raise ExpectationFailed(f"constraint violations: {bad}")
        return df
    raise ValueError(f"unknown mode {mode!r}")

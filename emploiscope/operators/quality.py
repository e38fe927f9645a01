"""Data-quality checks on DataFrames.

A check counts failures; the report has one row per check:
``(model, column, test, severity, failures)``. NULLs: ``not_null`` counts them;
``accepted_values``, ``unique`` and ``relationships`` ignore them. ``accepted_values`` counts
distinct wrong values, ``unique`` keys seen more than once, ``relationships`` child rows
without a parent. ``where`` restricts the rows checked; a row for which it is unknown is
left out, so ``not_null`` on a column with ``where`` "column NOT IN (...)" can never fail.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


class CheckFailed(Exception):
    """At least one check of severity ``error`` has failures."""


@dataclass(frozen=True)
class Check:
    columns: tuple[str, ...]
    test: str
    values: tuple = ()
    to: str = ""
    field: str = ""
    where: str = ""
    severity: str = ERROR

    @property
    def label(self) -> str:
        return ", ".join(self.columns)

    def rows(self, df: DataFrame) -> DataFrame:
        return df.filter(F.expr(self.where)) if self.where else df


def not_null(column: str, where: str = "", severity: str = ERROR) -> Check:
    return Check((column,), "not_null", where=where, severity=severity)


def unique(column: str, where: str = "", severity: str = ERROR) -> Check:
    return Check((column,), "unique", where=where, severity=severity)


def accepted_values(column: str, values: Sequence, where: str = "", severity: str = ERROR) -> Check:
    return Check((column,), "accepted_values", values=tuple(values), where=where, severity=severity)


def relationships(column: str, to: str, field: str, where: str = "", severity: str = ERROR) -> Check:
    return Check((column,), "relationships", to=to, field=field, where=where, severity=severity)


def unique_combination(*columns: str, where: str = "", severity: str = ERROR) -> Check:
    return Check(columns, "unique_combination_of_columns", where=where, severity=severity)


def run_checks(df: DataFrame, model: str, checks: Sequence[Check], parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The report of all ``checks`` on ``df``; ``parents`` holds the tables relationships point to.

    All ``not_null`` and ``accepted_values`` checks share one scan. Each key check adds one
    aggregation on its key columns.
    """
    row_checks = [c for c in checks if c.test in ("not_null", "accepted_values")]
    reports = [_row_report(df, model, row_checks)] if row_checks else []
    for check in checks:
        if check.test in ("unique", "unique_combination_of_columns"):
            reports.append(_one_row(repeated_keys(df, check).agg(F.count("*").alias("n")), model, check))
        elif check.test == "relationships":
            orphans = orphan_keys(df, (parents or {})[check.to], check)
            reports.append(_one_row(orphans.agg(F.sum("n").alias("n")), model, check))
    return reduce(DataFrame.unionByName, reports)


def wrong(check: Check) -> Column:
    """Whether a row fails a ``not_null`` or ``accepted_values`` check."""
    column = F.col(check.columns[0])
    failed = column.isNull() if check.test == "not_null" else ~column.isin(*check.values)
    return (F.expr(check.where) & failed) if check.where else failed


def _row_report(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    # Each failure becomes one (check, value) pair, counted per pair before the report line
    # adds them up. The outer form keeps Spark from pushing a copy of every check, and of
    # the expressions behind the checked columns, below the projection that computes them.
    marks = [
        F.when(wrong(check), F.struct(F.lit(i).alias("i"), F.col(check.columns[0]).cast("string").alias("value")))
        for i, check in enumerate(checks)
    ]
    # Marks of checks that passed are left out first: a good row stays one row.
    failed = df.select(F.inline_outer(F.filter(F.array(*marks), lambda mark: mark.isNotNull()))).filter(F.col("i").isNotNull())
    pairs = failed.groupBy("i", "value").agg(F.count("*").alias("n"))
    sums = [
        (F.sum(F.when(F.col("i") == i, F.col("n") if check.test == "not_null" else F.lit(1)))).alias(f"n{i}")
        for i, check in enumerate(checks)
    ]
    lines = F.array(*(_line(model, check, F.col(f"n{i}")) for i, check in enumerate(checks)))
    return pairs.agg(*sums).select(F.inline(lines))


def _line(model: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check.label).alias("column"),
        F.lit(check.test).alias("test"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(failures.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
    )


def _one_row(counted: DataFrame, model: str, check: Check) -> DataFrame:
    return counted.select(F.inline(F.array(_line(model, check, F.col("n")))))


def repeated_keys(df: DataFrame, check: Check) -> DataFrame:
    """Keys seen more than once, with the number of ``_rows`` of each; a single NULL key is ignored."""
    rows = check.rows(df)
    if check.test == "unique":
        rows = rows.filter(F.col(check.columns[0]).isNotNull())
    return rows.groupBy(*check.columns).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1)


def orphan_keys(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child keys without a parent row, with the ``n`` child rows of each.

    Child rows are counted per key first, so a frequent key is one row in the join.
    """
    child = check.columns[0]
    keys = check.rows(df).filter(F.col(child).isNotNull()).groupBy(F.col(child).alias("key")).agg(F.count("*").alias("n"))
    return keys.join(parent.select(F.col(check.field).alias("key")), "key", "left_anti")


def enforce(report: DataFrame | Sequence[Row]) -> None:
    """Raise ``CheckFailed`` naming the failed checks of severity ``error``; ``warn`` never raises.

    The report, or its rows, holds one row per declared check, so reading it here is bounded.
    """
    rows = report.collect() if isinstance(report, DataFrame) else report
    failed = [r for r in rows if r["failures"] > 0 and r["severity"] == ERROR]
    if failed:
        raise CheckFailed("; ".join(f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed))

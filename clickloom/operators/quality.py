"""Data-quality checks. A check is a query for the rows that break a rule; none means it passed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.lookup import Dimension, without_parent

ERROR = "error"
WARN = "warn"


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with the number of their rows."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def missing(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Rows (of those that satisfy ``where``) without a value."""
    bad = F.col(column).isNull()
    return df.where(bad if where is None else where & bad)


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with the number of their rows; null is not a value."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphaned(child: DataFrame, column: str, parent: Dimension) -> DataFrame:
    """Values without a parent row, with the number of child rows.

    The child is counted per value before the join, so a value in a third of all rows travels as one
    row per map task.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return without_parent(counted, column, parent)


def violating(df: DataFrame, rule_broken: Column) -> DataFrame:
    """Rows for which the predicate is true."""
    return df.where(rule_broken)


@dataclass(frozen=True)
class RowCheck:
    """A rule on single rows: all row checks of a table are counted in one pass over it."""

    name: str
    rule_broken: Column
    severity: str = ERROR


@dataclass(frozen=True)
class QueryCheck:
    """A rule that needs its own grouping or join; ``failures`` holds one row per violation."""

    name: str
    failures: DataFrame
    severity: str = ERROR


@dataclass(frozen=True)
class CountCheck:
    """A rule whose violations are counted together with others: a column of a one-row frame."""

    name: str
    failures: Column
    severity: str = ERROR


def not_null(name: str, column: str, where: Column | None = None, severity: str = ERROR) -> RowCheck:
    bad = F.col(column).isNull()
    return RowCheck(name, bad if where is None else where & bad, severity)


def unique(name: str, df: DataFrame, column: str, severity: str = ERROR) -> QueryCheck:
    return QueryCheck(name, duplicated(df, column), severity)


def accepted_values(
    name: str, df: DataFrame, column: str, values: Sequence[str], severity: str = ERROR
) -> QueryCheck:
    return QueryCheck(name, unaccepted(df, column, values), severity)


def relationships(
    name: str, child: DataFrame, column: str, parent: Dimension, severity: str = ERROR
) -> QueryCheck:
    return QueryCheck(name, orphaned(child, column, parent), severity)


def _count_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counted = df.agg(*[F.count_if(check.rule_broken).alias(f"c{i}") for i, check in enumerate(checks)])
    return _in_rows(counted, [CountCheck(c.name, F.col(f"c{i}"), c.severity) for i, c in enumerate(checks)])


def _in_rows(counted: DataFrame, checks: Sequence[CountCheck]) -> DataFrame:
    """One row per check from one row of counts."""
    results = F.array(
        *[
            F.struct(
                F.lit(check.name).alias("check"),
                F.lit(check.severity).alias("severity"),
                F.coalesce(check.failures, F.lit(0)).cast("bigint").alias("failures"),
            )
            for check in checks
        ]
    )
    return counted.select(F.inline(results))


def _count_query(check: QueryCheck) -> DataFrame:
    return check.failures.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"), "failures"
    )


def run_checks(
    row_checks: Sequence[tuple[DataFrame, Sequence[RowCheck]]],
    query_checks: Sequence[QueryCheck],
    count_checks: Sequence[tuple[DataFrame, Sequence[CountCheck]]] = (),
) -> DataFrame:
    """(check, severity, failures, passed), one row per check."""
    parts = [_count_rows(df, checks) for df, checks in row_checks if checks]
    parts += [_in_rows(counted, checks) for counted, checks in count_checks]
    parts += [_count_query(check) for check in query_checks]
    result = reduce(DataFrame.unionByName, parts)
    return result.withColumn("passed", F.col("failures") == 0)


class QualityError(RuntimeError):
    """At least one check of severity ``error`` failed."""


def require_passed(results: DataFrame) -> None:
    """Stop the job when a check of severity ``error`` failed. The result has one row per check."""
    failed = results.where(~F.col("passed") & (F.col("severity") == ERROR)).collect()
    if failed:
        raise QualityError("; ".join(f"{row['check']}: {row['failures']} failures" for row in failed))

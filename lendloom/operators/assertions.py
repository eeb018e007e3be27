"""Declarative data tests: each gives the rows that fail it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls aside, and how often."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list; nulls pass."""
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value no parent has; nulls pass."""
    keys = parent.select(F.col(parent_column).alias("_parent")).where("_parent is not null")
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def expression_is_true(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    """Rows for which the expression isn't true, null included."""
    rows = df.where(where) if where else df
    return rows.where(~F.coalesce(F.expr(expression), F.lit(False)))


def failing_counts(not_null: tuple[str, ...] = (), accepted: dict[str, tuple] | None = None, true: dict[str, str | None] | None = None) -> dict[tuple[str, str], Column]:
    """What the tests above that look at rows alone would find, as aggregates of one scan, by kind and what is tested."""
    out = {("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null}
    for c, values in (accepted or {}).items():
        out["accepted", c] = F.count_distinct(F.when(~F.col(c).isin(list(values)), F.col(c)))
    for expression, where in (true or {}).items():
        fails = ~F.coalesce(F.expr(expression), F.lit(False))
        out["true", expression] = F.count_if(fails & F.coalesce(F.expr(where), F.lit(False)) if where else fails)
    return out


def failures(tests: dict[str, DataFrame]) -> dict[str, int]:
    """Number of failing rows of each test, in one job."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("test"), "n") for name, df in tests.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return {r.test: r.n for r in out.collect()}

"""Data-quality checks: each returns the failing rows or counts them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import duplicate_keys
from .joins import orphans


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    return duplicate_keys(df, col)


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    return orphans(child, fk, parent, pk)


def predicate_text(expression: str, column: str | None = None) -> str:
    """Expression with the column put in front when it does not mention it."""
    if column is not None and column not in expression:
        return f"{column} {expression}"
    return expression


def expression_is_true(
    df: DataFrame, expression: str, column: str | None = None, *, full_rows: bool = True
) -> DataFrame:
    """Rows that break a SQL predicate; a NULL outcome passes.

    With ``full_rows=False`` each failing row is just the marker 1.
    """
    failing = df.filter(~F.expr(predicate_text(expression, column)))
    return failing if full_rows else failing.select(F.lit(1).alias("failing"))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(*values))


def out_of_bounds(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.filter(~F.col(col).between(low, high))


def order_violations(df: DataFrame, smaller: str, greater: str) -> DataFrame:
    return df.filter(~(F.col(greater) >= F.col(smaller)))


@dataclass(frozen=True)
class Check:
    """One rule on one column. ``kind`` picks which of the other fields count."""

    table: str
    column: str
    kind: str  # not_null | unique | relationships | expression
    expression: str | None = None
    parent: str | None = None
    parent_key: str | None = None

    @property
    def label(self) -> str:
        return self.kind if self.expression is None else self.expression

    def violated(self) -> Column:
        """Row-level violation; NULL counts as passed."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        return ~F.expr(predicate_text(self.expression, self.column))


def _row_checks(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in a single aggregation."""
    counted = df.agg(*[F.count_if(c.violated()).alias(f"c{i}") for i, c in enumerate(checks)])
    lines = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(c.column).alias("column"),
            F.lit(c.label).alias("check"),
            F.col(f"c{i}").alias("failing"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*lines)))


def _key_check(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    df = tables[check.table]
    if check.kind == "unique":
        failing = unique(df, check.column).agg(F.count("*").alias("failing"))
    else:
        # repeated keys collapse first, so a hot key costs one row in the join
        keys = df.groupBy(check.column).agg(F.count("*").alias("n"))
        missing = orphans(keys, check.column, tables[check.parent], check.parent_key)
        failing = missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing"))
    return failing.select(
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.label).alias("check"),
        "failing",
    )


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(table, column, check, failing)`` for every check."""
    results = []
    for table, df in tables.items():
        own = [c for c in checks if c.table == table]
        by_row = [c for c in own if c.kind in ("not_null", "expression")]
        if by_row:
            results.append(_row_checks(table, df, by_row))
        results += [_key_check(tables, c) for c in own if c.kind in ("unique", "relationships")]
    return reduce(DataFrame.unionByName, results)

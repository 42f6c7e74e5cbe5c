"""Derived columns: each is a function of one row, so a record derives the same alone or in a portfolio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column, ratio


def affordability(df: DataFrame, names: dict[str, str], income: str) -> DataFrame:
    """Ratios to income: output name -> numerator column. NULL when income is unknown."""
    return df.withColumns({out: ratio(num, income) for out, num in names.items()})


def per_year(n: str | Column, age: str | Column, base: int = 18) -> Column:
    """Count per year past the base age, NULL at exactly the base age."""
    return ratio(n, as_column(age) - F.lit(base))


def positive_flag(c: str | Column) -> Column:
    return as_column(c) > 0


def missing_flags(df: DataFrame, cols: Sequence[str], prefix: str = "missing_") -> DataFrame:
    return df.withColumns({f"{prefix}{c}": F.col(c).isNull() for c in cols})


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}*{b}": F.col(a).cast("double") * F.col(b).cast("double") for a, b in pairs})


def ablate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def months_between_labels(earlier: str | Column, later: str | Column) -> Column:
    """Whole months from one yyyy-MM label to another."""
    def serial(c):
        v = as_column(c)
        return F.substring(v, 1, 4).cast("int") * 12 + F.substring(v, 6, 2).cast("int")
    return serial(later) - serial(earlier)


def term_elapsed(df: DataFrame, month: str, term: str, end: str) -> DataFrame:
    """Share of records per month whose whole term fits before the end month (yyyy-MM)."""
    age = months_between_labels(F.col(month), F.lit(end))
    return df.groupBy(month).agg(
        F.max(age).alias("age"), F.avg((age >= F.col(term)).cast("double")).alias("share_term_elapsed")
    )


def complete_cases(df: DataFrame, cols: Sequence[str], condition: Column | None = None) -> DataFrame:
    kept = df.dropna(subset=list(cols))
    return kept.where(condition) if condition is not None else kept

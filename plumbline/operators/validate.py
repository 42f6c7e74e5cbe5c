"""Contracts over tables: rules per column and row, uniqueness, schema checks, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnRule:
    """What one column promises. Bounds and vocabulary ignore NULL; `nullable` decides about it."""

    name: str
    type: T.DataType | None = None
    nullable: bool = False
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    isin: tuple | None = None
    pattern: str | None = None

    def checks(self) -> dict[str, Column]:
        """Rule name -> condition that marks a bad row."""
        c = F.col(self.name)
        bad: dict[str, Column] = {}
        if not self.nullable:
            bad["not_null"] = c.isNull()
        if self.ge is not None:
            bad["ge"] = c < F.lit(self.ge)
        if self.gt is not None:
            bad["gt"] = c <= F.lit(self.gt)
        if self.le is not None:
            bad["le"] = c > F.lit(self.le)
        if self.isin is not None:
            bad["isin"] = ~c.isin(list(self.isin))
        if self.pattern is not None:
            bad["pattern"] = ~c.rlike(self.pattern)
        return {k: F.coalesce(v, F.lit(False)) for k, v in bad.items()}


@dataclass(frozen=True)
class Contract:
    columns: tuple[ColumnRule, ...]
    # Row rules: name -> condition that must hold; an unknown result passes.
    row_rules: dict[str, Column] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    strict: bool = True

    def bad_conditions(self) -> dict[tuple[str, str], Column]:
        out = {(r.name, k): cond for r in self.columns for k, cond in r.checks().items()}
        for name, ok in self.row_rules.items():
            out[("*", name)] = ~F.coalesce(ok, F.lit(True))
        return out


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """(column, rule, n_bad) for every rule, from one scan."""
    bad = contract.bad_conditions()
    wide = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(bad.values())])
    long = F.array(*[
        F.struct(F.lit(col).alias("column"), F.lit(rule).alias("rule"), F.col(f"c{i}").alias("n_bad"))
        for i, (col, rule) in enumerate(bad)
    ])
    return wide.select(F.inline(long))


def schema_faults(df: DataFrame, contract: Contract) -> list[str]:
    """Declared columns that are missing or of another type and, in a strict contract, columns that it does not declare."""
    have = {f.name: f.dataType for f in df.schema}
    names = {r.name for r in contract.columns}
    out = [f"{r.name}: missing" for r in contract.columns if r.name not in have]
    out += [f"{r.name}: {have[r.name].simpleString()} instead of {r.type.simpleString()}" for r in contract.columns if r.type is not None and r.name in have and have[r.name] != r.type]
    return out + ([f"{c}: unexpected" for c in have if c not in names] if contract.strict else [])


def assert_valid(df: DataFrame, contract: Contract) -> DataFrame:
    """Refuses a table whose columns or types are not the declared ones or whose key repeats (one aggregation on the key), and fails the
    job at the first row that breaks a rule; otherwise the same rows pass through."""
    faults = schema_faults(df, contract)
    if not faults and contract.key:
        faults = [f"key repeats: {tuple(r)[:-1]} {r['n']} times" for r in duplicate_keys(df, contract.key).limit(3).collect()]
    if faults:
        raise ValueError("contract broken: " + "; ".join(faults))
    broken = F.array_compact(F.array(*[
        F.when(cond, F.lit(f"{c}:{r}")) for (c, r), cond in contract.bad_conditions().items()
    ]))
    ok = F.assert_true(F.size(broken) == 0, F.concat(F.lit("contract broken: "), F.array_join(broken, ", ")))
    return df.where(ok.isNull())


def split_valid(df: DataFrame, contract: Contract, name: str = "broken_rules") -> DataFrame:
    """Adds the list of rules each row broke; an empty list is a valid row, the rest is quarantine."""
    broken = F.array_compact(F.array(*[
        F.when(cond, F.lit(f"{c}:{r}")) for (c, r), cond in contract.bad_conditions().items()
    ]))
    return df.withColumn(name, broken)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def unique_check(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys repeated, rows in excess."""
    per = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"),
    )


def strict_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rejects missing and unexpected columns, then casts to the declared types in the declared order."""
    have, want = set(df.columns), [f.name for f in schema]
    missing, extra = [c for c in want if c not in have], sorted(have - set(want))
    if missing or extra:
        raise ValueError(f"schema mismatch: missing {missing}, unexpected {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def stale_fields(registered: T.StructType, df: DataFrame) -> list[str]:
    """Registered fields whose stored type differs or that are missing."""
    stored = {f.name: f.dataType for f in df.schema}
    return sorted(f.name for f in registered if stored.get(f.name) != f.dataType)


# The only types a stored feature may have.
STORABLE = (T.LongType, T.DoubleType, T.BooleanType, T.StringType, T.TimestampType)


def check_storable(df: DataFrame) -> DataFrame:
    bad = {f.name: f.dataType.simpleString() for f in df.schema if not isinstance(f.dataType, STORABLE)}
    if bad:
        raise TypeError(f"feature types that cannot be stored: {bad}")
    return df


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )

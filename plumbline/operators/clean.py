"""Row-wise cleaning over any table, and the counts that describe what it changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import as_column, canon_code, ordered_rank

# The texts read as a boolean outcome, and the texts counted as missing markers.
BOOLEAN_TEXT = {"1": True, "0": False, "true": True, "false": False}
NULL_MARKERS = ["", "NaT", "nan", "NaN", "NULL", "null", "None", "N/A", "#N/A", "-", "?"]


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Names that are absent are ignored."""
    return df.drop(*cols)


def parse_bool_strict(c: str | Column, name: str = "value") -> Column:
    """A boolean read from text, numbers or booleans; a value that cannot be read fails the job."""
    text = F.lower(F.trim(as_column(c).cast("string")))
    key = F.regexp_replace(text, r"\.0+$", "")
    out = F.when(key.isin([k for k, v in BOOLEAN_TEXT.items() if v]), F.lit(True))
    out = out.when(key.isin([k for k, v in BOOLEAN_TEXT.items() if not v]), F.lit(False))
    message = F.concat(F.lit(f"{name} holds a value that is not a boolean: "), F.coalesce(text, F.lit("NULL")))
    return out.otherwise(F.raise_error(message).cast("boolean"))


def unreadable_bools(df: DataFrame, col: str) -> DataFrame:
    """The distinct values parse_bool_strict would refuse, with their counts."""
    key = F.regexp_replace(F.lower(F.trim(F.col(col).cast("string"))), r"\.0+$", "")
    return (
        df.where(~F.coalesce(key.isin(list(BOOLEAN_TEXT)), F.lit(False)))
        .groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("n"))
    )


def categorise(df: DataFrame, col: str, vocabulary: Sequence[str], ordered: bool = False) -> DataFrame:
    """Out-of-vocabulary values become NULL; an ordered vocabulary also gets a <col>_rank."""
    kept = F.when(F.col(col).isin(list(vocabulary)), F.col(col))
    out = {col: kept}
    if ordered:
        out[f"{col}_rank"] = ordered_rank(col, vocabulary)
    return df.withColumns(out)


def scale_columns(df: DataFrame, cols: Sequence[str], factor) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: F.col(c) * F.lit(factor) for c in cols if c in present})


def group_rare(c: str | Column, keep: Sequence[str], other: str) -> Column:
    """Listed codes are kept, every other one becomes the residual label: never decided per batch."""
    known = F.create_map(*[F.lit(v) for k in keep for v in (k, k)])
    # a lookup names the code once, so its text is worked out once per row
    return F.coalesce(F.try_element_at(known, canon_code(c)), F.lit(other))


def sentinel_report(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL counts per column before and after a cleaning step."""
    from plumbline.operators.ranking import merge_rows

    def counts(df: DataFrame, side: str) -> DataFrame:
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        return wide.unpivot([], list(cols), "column", side)

    both = merge_rows([counts(before, "before"), counts(after, "after")], ["column"])
    return both.withColumn("converted", F.col("after") - F.col("before"))


def count_conditions(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """How many rows meet each named condition, in one scan."""
    wide = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(n) for n, cond in conditions.items()])
    return wide.unpivot([], list(conditions), "condition", "rows")


def marker_counts(df: DataFrame, markers: Sequence[str] = NULL_MARKERS, cols: Sequence[str] | None = None) -> DataFrame:
    """Occurrences of texts that stand for a missing value over all text columns."""
    names = list(cols) if cols else [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    cells = df.select(F.explode(F.array(*[F.col(c) for c in names])).alias("marker"))
    return cells.where(F.col("marker").isin(list(markers))).groupBy("marker").agg(F.count("*").alias("occurrences"))


def bools_to_double(df: DataFrame) -> DataFrame:
    """Booleans with gaps as 1.0 / 0.0 / NULL, for numeric consumers."""
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int").cast("double") for c in flags})


def bool_text_to_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The same repair after a CSV round trip, where the booleans came back as text."""
    def read(c):
        return F.when(F.lower(F.col(c)) == "true", 1.0).when(F.lower(F.col(c)) == "false", 0.0)
    return df.withColumns({c: read(c) for c in cols})

"""A rule table that says how each column should be transformed before modelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.profile import iqr_outliers, modes, moments
from plumbline.operators.ranking import merge_rows


def transform_plan(
    df: DataFrame, numeric: Sequence[str], roles: dict[str, str] | None = None,
    redundant: DataFrame | None = None, ordered: Sequence[str] = (),
) -> DataFrame:
    """(column, action, nulls, impute): roles first, then redundancy, type and measured shape.

    `roles` maps a column to a fixed action (excluded, target, month control). `redundant` is the
    output of redundant_pairs.
    """
    roles = roles or {}
    types = {f.name: f.dataType for f in df.schema}
    kinds = []
    for c in df.columns:
        if c in roles:
            kind = roles[c]
        elif isinstance(types[c], T.BooleanType):
            kind = "keep: already binary"
        elif c in numeric:
            kind = None
        else:
            kind = "encode: ordinal" if c in ordered else "encode: one-hot"
        kinds.append(F.struct(F.lit(c).alias("column"), F.lit(kind).cast("string").alias("_fixed"), F.lit(c in roles).alias("_role")))
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    names = counts.select(F.inline(F.array(*kinds)))
    nulls = counts.unpivot([], df.columns, "column", "nulls")
    measured = merge_rows(
        [moments(df, numeric).select("column", "skew"), modes(df, numeric).select("column", "mode_share"),
         iqr_outliers(df, numeric).select("column", "max_over_p99", "p99")], ["column"],
    )
    parts = [names, nulls, measured]
    if redundant is not None:
        parts.append(redundant.select(F.col("drop").alias("column"), F.lit(True).alias("_redundant")).dropDuplicates())
    out = merge_rows(parts, ["column"])
    dropped = F.coalesce("_redundant", F.lit(False)) if redundant is not None else F.lit(False)
    tail = F.when(F.col("p99") > 0, F.col("max_over_p99")).otherwise(F.lit(float("inf")))
    action = (
        F.when(F.col("_role"), F.col("_fixed"))
        .when(dropped, "drop: redundant")
        .when(F.col("_fixed").isNotNull(), F.col("_fixed"))
        .when(F.col("mode_share") > 0.90, "binarise: above zero")
        .when((F.col("skew") > 2) & (tail > 10), "winsorise p99, then log1p")
        .when(F.col("skew") > 2, "log1p")
        .when(F.abs("skew") <= 2, "scale only")
    )
    return out.select(
        "column", action.alias("action"), "nulls",
        F.when(F.col("nulls") > 0, "flag the gap and impute").otherwise("").alias("impute"),
    )

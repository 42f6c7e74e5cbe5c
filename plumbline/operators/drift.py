"""Distribution drift between a reference and a current table, column by column, in two jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import finite
from plumbline.functions.pvalues import p_chi2, p_ks_two_sample
from plumbline.operators import ranking
from plumbline.operators.ranking import null_safe_join


@dataclass(frozen=True)
class DriftSpec:
    # The published monitoring limits.
    drift_share_threshold: float = 0.30
    flagged_share_threshold: float = 0.25
    numeric_sample_size_cutoff: int = 1000
    alpha: float = 0.05
    min_current_rows: int = 30
    distance_threshold: float | None = None  # limit of the distance method, alpha when unset

    @property
    def distance_limit(self) -> float:
        return self.alpha if self.distance_threshold is None else self.distance_threshold


def shared_columns(reference: DataFrame, current: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns both sides have; the kind is the reference's, booleans are numeric."""
    have = set(current.columns) - set(exclude)
    numeric, categorical = [], []
    for f in reference.schema:
        if f.name in have:
            (numeric if isinstance(f.dataType, (T.NumericType, T.BooleanType)) else categorical).append(f.name)
    return numeric, categorical


def _number(df: DataFrame, c: str):
    kind = df.schema[c].dataType
    if isinstance(kind, T.BooleanType):
        return F.col(c).cast("int").cast("double")
    return finite(c) if isinstance(kind, T.NumericType) else finite(F.col(c).try_cast("double"))


def _stack(df: DataFrame, cols: Sequence[str], side: int, numeric: bool) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), (_number(df, c) if numeric else F.col(c).cast("string")).alias("value")) for c in cols
    ])
    return df.select(F.lit(side).alias("side"), F.explode(cells).alias("_c")).select("side", "_c.column", "_c.value").where("value is not null")


def numeric_drift_stats(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """KS distance and area between the CDFs over the reference deviation, per column.

    A column without values on either side is left out.
    """
    both = _stack(reference, cols, 1, True).unionByName(_stack(current, cols, 0, True))
    ks = ranking.ks_two_sample(both, "value", "side", ["column"]).where("n1 > 0 and n0 > 0")
    sd = both.where("side = 1").groupBy("column").agg(F.stddev_samp("value").alias("_sd"))
    out = null_safe_join(ks, sd, ["column"])
    scale = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0))
    return out.select("column", F.col("n1").alias("n_reference"), F.col("n0").alias("n_current"), "ks", (F.col("area") / scale).alias("distance"))


def categorical_drift_stats(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square of the current level counts against the reference scaled to the current size, per column.

    A level the reference never saw counts as expected 0.5 before scaling, so that it adds a finite term.
    """
    both = _stack(reference, cols, 1, False).unionByName(_stack(current, cols, 0, False))
    counts = both.groupBy("column", "value").agg(F.count_if(F.col("side") == 1).alias("r"), F.count_if(F.col("side") == 0).alias("c"))
    totals = counts.groupBy("column").agg(F.sum("r").alias("_r"), F.sum("c").alias("_c"), F.count("*").alias("_k"))
    j = null_safe_join(counts, totals, ["column"]).where("_r > 0 and _c > 0")
    expected = F.when(F.col("r") > 0, F.col("r").cast("double")).otherwise(F.lit(0.5)) * F.col("_c") / F.col("_r")
    g = j.groupBy("column").agg(
        F.max("_r").alias("n_reference"), F.max("_c").alias("n_current"),
        F.sum(F.pow(F.col("c") - expected, 2) / expected).alias("chi2"), F.max(F.col("_k") - 1).alias("dof"),
    )
    return g


def drift_report(reference: DataFrame, current: DataFrame, spec: DriftSpec = DriftSpec(), exclude: Sequence[str] = (), numeric_test: str = "by_size") -> DataFrame:
    """(column, method, value, threshold, drifted) for every shared column that can be tested.

    Numeric columns use the named test: ks (its p-value is exact for samples of up to KS_EXACT values), wasserstein (the normalised distance),
    or by_size, KS below the sample-size cutoff of the reference table and the distance from it on. Categorical ones use chi-square.
    """
    if numeric_test not in ("by_size", "ks", "wasserstein"):
        raise ValueError(f"unknown numeric test {numeric_test!r}")
    numeric, categorical = shared_columns(reference, current, exclude)
    parts = []
    if numeric:
        st = numeric_drift_stats(reference, current, numeric)
        if numeric_test == "by_size":
            small = reference.agg(F.count("*").alias("n")).scalar() < spec.numeric_sample_size_cutoff
        else:
            small = F.lit(numeric_test == "ks")
        p = p_ks_two_sample(F.col("ks"), F.col("n_reference"), F.col("n_current"))
        parts.append(
            st.withColumn("_p", p).withColumn("_small", small).select(
                "column", F.when(F.col("_small"), "ks").otherwise("wasserstein").alias("method"),
                F.when(F.col("_small"), F.col("_p")).otherwise(F.col("distance")).alias("value"),
                F.when(F.col("_small"), spec.alpha).otherwise(spec.distance_limit).alias("threshold"),
            )
        )
    if categorical:
        st = categorical_drift_stats(reference, current, categorical)
        value = F.when(F.col("dof") > 0, p_chi2("chi2", F.col("dof").cast("double"))).otherwise(F.lit(1.0))
        parts.append(st.select("column", F.lit("chisquare").alias("method"), value.alias("value"), F.lit(spec.alpha).alias("threshold")))
    if not parts:
        raise ValueError("reference and current share no column")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    over = F.when(F.col("method") == "wasserstein", F.col("value") >= F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    return out.withColumn("drifted", over)


def drift_summary(report: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """One row: columns tested, share drifted, dataset verdict, sorted names of the drifted columns."""
    share = F.coalesce(F.try_divide(F.count_if("drifted").cast("double"), F.count("*")), F.lit(0.0))
    return report.agg(
        F.count("*").alias("tested"), share.alias("drift_share"), (share > spec.drift_share_threshold).alias("dataset_drift"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_features"),
    )


def drift_magnitude(report: DataFrame, cap: float = 20.0) -> DataFrame:
    """How many times past its own threshold every column is, with the value capped, largest first."""
    times = F.when(F.col("method") == "wasserstein", F.col("value") / F.col("threshold")).otherwise(
        F.coalesce(F.try_divide(F.col("threshold"), F.col("value")), F.lit(float("inf")))
    )
    out = report.select("column", "method", "drifted", times.alias("_t"))
    return (
        out.select("column", "method", "drifted", F.least("_t", F.lit(cap)).alias("magnitude"), (F.col("_t") > cap).alias("capped"))
        .orderBy(F.desc("magnitude"), "column")
    )


def build_reference(scored: DataFrame, features: Sequence[str], score: str, threshold: float, y: str | None = None) -> DataFrame:
    """The table later drift checks compare with: features, probability, frozen flag and, if known, the label."""
    extra = [F.col(y)] if y else []
    return scored.select(*features, F.col(score).alias("probability_default"), (F.col(score) >= threshold).alias("review_flag"), *extra)


def live_check(
    reference: DataFrame, log: DataFrame, spec: DriftSpec = DriftSpec(), flag: str = "review_flag", flagged_share_at_fit: float | None = None
) -> DataFrame:
    """(alert, fired, value, threshold, detail) rows from the prediction log against the reference.

    Fewer than the minimum of logged rows gives one `insufficient_data` row and no verdict. The count is
    the only value read ahead; it stops at the minimum.
    """
    spark = log.sparkSession
    enough = log.limit(spec.min_current_rows).count()
    schema = "alert string, fired boolean, value double, threshold double, detail string"
    if enough < spec.min_current_rows:
        return spark.createDataFrame(
            [("insufficient_data", True, float(enough), float(spec.min_current_rows), "too few logged rows for a verdict")], schema
        )
    summary = drift_summary(drift_report(reference, log, spec, exclude=[flag]), spec)
    drift = summary.select(
        F.lit("dataset_drift").alias("alert"), F.col("dataset_drift").alias("fired"), F.col("drift_share").alias("value"),
        F.lit(spec.drift_share_threshold).alias("threshold"), F.array_join("drifted_features", ", ").alias("detail"),
    )
    share = F.avg(F.col(flag).cast("boolean").cast("int").cast("double"))
    flagged = log.agg(
        F.lit("flagged_share").alias("alert"), (share > spec.flagged_share_threshold).alias("fired"), share.alias("value"),
        F.lit(spec.flagged_share_threshold).alias("threshold"),
        F.lit("" if flagged_share_at_fit is None else f"at fit {flagged_share_at_fit}").alias("detail"),
    )
    return drift.unionByName(flagged)


def monitor(
    train: DataFrame, test: DataFrame, features: Sequence[str], score: str, y: str, threshold: float, spec: DriftSpec = DriftSpec()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(drift report, drift summary, quality by window): train against held-out, prediction included."""
    from plumbline.operators.evaluate import classification_summary

    report = drift_report(train.select(*features, score), test.select(*features, score), spec)
    both = train.select(score, y).withColumn("window", F.lit("train")).unionByName(test.select(score, y).withColumn("window", F.lit("test")))
    return report, drift_summary(report, spec), classification_summary(both, score, y, threshold, ["window"])

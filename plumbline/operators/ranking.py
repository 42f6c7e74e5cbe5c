"""Metrics that need a global order of scores, without a global sort in one task.

Rows first collapse to one row per distinct score (map-side combine), so ties are exact and a heavily
repeated score costs one row. The distinct scores are then cut into value buckets; running totals are
taken inside each (group, bucket) and completed with the totals of the lower buckets, which is a table
of at most groups x buckets rows. No task ever holds a whole group, however large one group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column
from plumbline.operators.quantiles import Buckets, quantile_buckets


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that matches NULL keys, keeping one copy of each key column (from the left)."""
    marked = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(F.col(f"_r_{c}"))
    return left.join(marked, cond, how).drop(*[f"_r_{c}" for c in on])


def merge_rows(parts: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Puts results that hold one row per group side by side: a union and one small aggregation, no join."""
    by = list(by)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.groupBy(*by).agg(*[F.max(c).alias(c) for c in out.columns if c not in by])


def score_counts(df: DataFrame, score: str | Column, y: str | Column | None, by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): n rows and pos positives. NULL and NaN scores are left out."""
    s = as_column(score).cast("double")
    label = F.lit(0) if y is None else as_column(y).cast("int")
    # -0.0 and 0.0 are one score. NULL and NaN drop out after the aggregation, where the condition is on
    # a count: a filter on the score itself would be pushed down and evaluate its expression twice.
    rows = df.select(*by, (s + F.lit(0.0)).alias("score"), label.alias("_y"))
    counts = rows.groupBy(*by, "score").agg(
        F.count_if(F.col("score") <= float("inf")).alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).cast("long").alias("pos")
    )
    return counts.where("n > 0")


def buckets_for(df: DataFrame, score: str | Column) -> Buckets:
    known = df.select(as_column(score).cast("double").alias("s")).select(F.nullif("s", F.lit(float("nan"))).alias("s"))
    return quantile_buckets(known, "s")


def _bucketed(df: DataFrame, counts: DataFrame, score, buckets: Buckets | None) -> DataFrame:
    return counts.withColumn("_b", (buckets or buckets_for(df, score)).index("score"))


def cumulative_counts(
    df: DataFrame,
    score: str | Column,
    y: str | Column | None = None,
    by: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """(group, score, n, pos, cum_n, cum_pos, tot_n, tot_pos, next_score), cumulative in ascending score."""
    by = list(by)
    t = _bucketed(df, score_counts(df, score, y, by), score, buckets)
    per_bucket = t.groupBy(*by, "_b").agg(
        F.sum("n").alias("_bn"), F.sum("pos").alias("_bp"), F.min("score").alias("_bmin")
    )
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *by, "_b",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"),
        F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_op"),
        F.sum("_bn").over(whole).alias("tot_n"),
        F.sum("_bp").over(whole).alias("tot_pos"),
        F.lead("_bmin").over(whole.orderBy("_b")).alias("_nmin"),
    )
    inner = Window.partitionBy(*by, "_b").orderBy("score")
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    local = t.select(
        *by, "_b", "score", "n", "pos",
        F.sum("n").over(upto).alias("_ln"),
        F.sum("pos").over(upto).alias("_lp"),
        F.lead("score").over(inner).alias("_lnext"),
    )
    return null_safe_join(local, offsets, [*by, "_b"]).select(
        *by, "score", "n", "pos",
        (F.col("_ln") + F.col("_on")).alias("cum_n"),
        (F.col("_lp") + F.col("_op")).alias("cum_pos"),
        "tot_n", "tot_pos",
        F.coalesce("_lnext", "_nmin").alias("next_score"),
    )


def auc(
    df: DataFrame,
    score: str | Column,
    y: str | Column,
    by: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """ROC-AUC with ties at half, Gini and the Mann-Whitney counts, one row per group.

    Pairs inside a bucket are settled there; pairs across buckets need only the bucket totals, so the
    distinct scores are never joined back. A single-class group gives NULL.
    """
    by = list(by)
    t = _bucketed(df, score_counts(df, score, y, by), score, buckets)
    below = Window.partitionBy(*by, "_b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    neg = (F.col("n") - F.col("pos")).cast("double")
    local = t.withColumn("_nb", F.coalesce(F.sum(neg).over(below), F.lit(0.0)))
    per_bucket = local.groupBy(*by, "_b").agg(
        F.sum(F.col("pos") * (F.col("_nb") + neg / 2)).alias("_u"),
        F.sum("pos").cast("double").alias("_p"),
        F.sum(neg).alias("_q"),
        F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("_ties"),
    )
    lower = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifted = per_bucket.withColumn("_off", F.coalesce(F.sum("_q").over(lower), F.lit(0.0)))
    total = shifted.groupBy(*by).agg(
        F.sum(F.col("_u") + F.col("_p") * F.col("_off")).alias("u"),
        F.sum("_p").cast("long").alias("n_pos"),
        F.sum("_q").cast("long").alias("n_neg"),
        F.sum("_ties").alias("ties"),
    )
    value = F.try_divide(F.col("u"), F.col("n_pos").cast("double") * F.col("n_neg"))
    return total.select(
        *by, "n_pos", "n_neg", "u", "ties", value.alias("auc"), (2 * value - 1).alias("gini")
    )


def average_precision(
    df: DataFrame, score: str | Column, y: str | Column, by: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """Sum over distinct thresholds of (recall step) x precision, one row per group."""
    return _average_precision_from(cumulative_counts(df, score, y, by, buckets), list(by))


def _average_precision_from(cum: DataFrame, by: list[str]) -> DataFrame:
    flagged = F.col("tot_n") - F.col("cum_n") + F.col("n")
    hits = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    step = F.col("pos") * (hits.cast("double") / flagged)
    return cum.groupBy(*by).agg(
        F.coalesce(F.try_divide(F.sum(step), F.max("tot_pos").cast("double")), F.lit(0.0)).alias("pr_auc")
    )


def curve_points(
    df: DataFrame, score: str | Column, y: str | Column, by: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """ROC and PR points, one per distinct threshold: flag when score >= threshold."""
    cum = cumulative_counts(df, score, y, by, buckets)
    flagged = (F.col("tot_n") - F.col("cum_n") + F.col("n")).cast("double")
    hits = (F.col("tot_pos") - F.col("cum_pos") + F.col("pos")).cast("double")
    negatives = (F.col("tot_n") - F.col("tot_pos")).cast("double")
    return cum.select(
        *by, F.col("score").alias("threshold"),
        F.try_divide(flagged - hits, negatives).alias("fpr"),
        F.try_divide(hits, F.col("tot_pos").cast("double")).alias("tpr"),
        (hits / flagged).alias("precision"),
    )


def ks_two_sample(
    df: DataFrame, value: str | Column, side: str | Column, by: Sequence[str] = (),
    buckets: Buckets | None = None, runs_up_to: int | None = None,
) -> DataFrame:
    """KS distance and area between the two empirical CDFs of side 1 and side 0, one row per group. With runs_up_to, groups of up to so many
    values a side also get `ends`: how many pooled values stand up to the end of each run of equal ones."""
    cum = cumulative_counts(df, value, side, by, buckets)
    ends = []
    if runs_up_to is not None:
        few = (F.col("tot_pos") <= runs_up_to) & (F.col("tot_n") - F.col("tot_pos") <= runs_up_to)
        ends = [F.collect_list(F.when(few, F.col("cum_n"))).alias("ends")]
    f1 = F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos").cast("double"))
    f0 = F.try_divide(
        (F.col("cum_n") - F.col("cum_pos")).cast("double"), (F.col("tot_n") - F.col("tot_pos")).cast("double")
    )
    gap = F.abs(f1 - f0)
    return cum.groupBy(*by).agg(
        F.max(gap).alias("ks"),
        F.sum(gap * F.coalesce(F.col("next_score") - F.col("score"), F.lit(0.0))).alias("area"),
        F.max("tot_pos").alias("n1"),
        F.max(F.col("tot_n") - F.col("tot_pos")).alias("n0"), *ends,
    )


def ecdf(
    df: DataFrame, value: str | Column, by: Sequence[str] = (), buckets: Buckets | None = None,
) -> DataFrame:
    """Empirical CDF: share of rows at or below each distinct value."""
    cum = cumulative_counts(df, value, None, by, buckets)
    return cum.select(
        *by, F.col("score").alias("value"), "n",
        (F.col("cum_n") / F.col("tot_n").cast("double")).alias("share"),
    )


def average_rank(cum: DataFrame) -> DataFrame:
    """Adds the shared rank of a distinct score: the mean of the positions its rows take."""
    return cum.withColumn("rank", (F.col("cum_n") - F.col("n")) + (F.col("n") + 1) / F.lit(2.0))


def rank_bands(
    df: DataFrame, score: str | Column, y: str | Column, bands: int = 10, by: Sequence[str] = (),
    extra: dict[str, Column] | None = None, buckets: Buckets | None = None,
) -> DataFrame:
    """Distinct scores with their equal-frequency band (0 = lowest).

    Bands are quantile intervals of the average ranks, right-closed, repeated edges merged: equal
    scores always share a band, so fewer than `bands` bands can come out.
    """
    by = list(by)
    ranked = average_rank(cumulative_counts(df, score, y, by, buckets))
    count = F.least(F.lit(bands).cast("long"), F.col("tot_n"))
    # Cut j is the rank at position (rows - 1) * j / bands; a distinct score answers for the positions
    # its own rows take, so each group yields 2 * bands + 2 small rows.
    wanted = F.transform(
        F.sequence(F.lit(0).cast("long"), count), lambda j: F.struct(j.alias("j"), ((F.col("tot_n") - 1) * j / count).alias("pos"))
    )

    def mine(at: Column) -> Column:
        return (at >= F.col("cum_n") - F.col("n")) & (at < F.col("cum_n"))

    hits = ranked.select(
        *by, "n", "cum_n", "rank", F.explode(F.filter(wanted, lambda w: mine(F.floor(w["pos"])) | mine(F.ceil(w["pos"])))).alias("_w")
    )
    at = F.col("_w.pos")
    ends = hits.groupBy(*by, at.alias("pos")).agg(
        F.max(F.when(mine(F.floor(at)), F.col("rank"))).alias("_a"), F.max(F.when(mine(F.ceil(at)), F.col("rank"))).alias("_z")
    )
    cut = F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("pos") - F.floor("pos"))
    state = ends.groupBy(*by).agg(F.array_sort(F.collect_set(cut)).alias("_cuts"))
    if not by:
        # One row of at most bands + 1 numbers: a scalar subquery instead of a join without a key.
        inner = F.slice(state.scalar(), 2, bands + 1)
        return ranked.withColumn("_c", inner).withColumn("band", F.size(F.filter("_c", lambda e: e < F.col("rank")))).drop("_c")
    joined = null_safe_join(ranked, state, by)
    # count of distinct upper cuts strictly below the rank; the first cut is the lowest rank itself
    inner = F.slice(F.col("_cuts"), 2, bands + 1)
    return joined.withColumn("band", F.size(F.filter(inner, lambda e: e < F.col("rank")))).drop("_cuts")


def band_rates(
    df: DataFrame, score: str | Column, y: str | Column, bands: int = 10, by: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> DataFrame:
    """Event rate by equal-frequency score band."""
    return (
        rank_bands(df, score, y, bands, by, buckets=buckets)
        .groupBy(*by, "band")
        .agg(
            F.sum("n").alias("n"), F.sum("pos").alias("cases"),
            (F.sum("pos") / F.sum("n").cast("double")).alias("rate"),
        )
    )


def decile_lift(
    df: DataFrame, score: str | Column, y: str | Column, bands: int = 10, minimum: int = 200,
    by: Sequence[str] = (), buckets: Buckets | None = None,
) -> DataFrame:
    """Rates of the riskiest and safest band and their ratio; NULL below `minimum` rows or on a clean safest band."""
    rates = band_rates(df, score, y, bands, by, buckets)
    g = rates.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.max_by("rate", "band").alias("_top"),
        F.min_by("rate", "band").alias("_bottom"),
    )
    enough = F.col("n") >= minimum
    return g.select(
        *by, "n",
        F.when(enough, F.col("_top")).alias("top_decile_rate"),
        F.when(enough, F.col("_bottom")).alias("bottom_decile_rate"),
        F.when(enough, F.try_divide("_top", "_bottom")).alias("decile_lift"),
    )

"""Evaluation of scores against labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column, bucket_index
from plumbline.operators import ranking
from plumbline.operators.quantiles import Buckets, exact_quantiles, grouped_quantiles
from plumbline.operators.ranking import merge_rows, null_safe_join


def _safe(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def freeze_threshold(df: DataFrame, score: str | Column, share: float) -> float:
    """The cut that sends the top `share` of these scores to review; frozen, never refitted per batch."""
    cut = exact_quantiles(df, {"score": as_column(score)}, [1 - share])["score"][0]
    if cut is None:
        raise ValueError("no scores to take a threshold from")
    return cut


def flag_top_share(df: DataFrame, score: str, share: float, name: str = "flagged") -> DataFrame:
    """Flag every score at or above the quantile; ties at the cut are all flagged."""
    return df.withColumn(name, F.col(score) >= F.lit(freeze_threshold(df, score, share)))


def confusion(
    df: DataFrame, score: str | Column, y: str | Column, threshold, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and thresholded rates at score >= threshold, in one pass."""
    s, label = as_column(score).cast("double"), as_column(y).cast("int")
    cut = threshold if isinstance(threshold, Column) else F.lit(threshold)
    rows = df.select(*by, s.alias("s"), label.alias("y"), (s >= cut).alias("f"))
    pos, flagged = F.col("y") == 1, F.coalesce(F.col("f"), F.lit(False))
    g = rows.groupBy(*by).agg(
        F.count_if(~flagged & ~pos).alias("tn"),
        F.count_if(flagged & ~pos).alias("fp"),
        F.count_if(~flagged & pos).alias("fn"),
        F.count_if(flagged & pos).alias("tp"),
        F.avg(F.pow(F.col("s") - F.col("y"), 2)).alias("brier"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return g.select(
        *by, "tn", "fp", "fn", "tp",
        _safe(tp, tp + fp).alias("precision"),
        _safe(tp, tp + fn).alias("recall"),
        _safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _safe(tp + tn, n).alias("accuracy"),
        _safe(tp + fp, n).alias("flagged_share"),
        "brier",
    )


def classification_summary(
    df: DataFrame, score: str | Column, y: str | Column, threshold, by: Sequence[str] = (),
    probabilistic: bool = True, buckets: Buckets | None = None,
) -> DataFrame:
    """PR-AUC, ROC-AUC, Gini, F1, precision, recall, Brier and the confusion counts, one row per group."""
    by = list(by)
    point = confusion(df, score, y, threshold, by)
    if not probabilistic:
        point = point.withColumn("brier", F.lit(None).cast("double"))
    cum = ranking.cumulative_counts(df, score, y, by, buckets)
    curve = _auc_and_ap(cum, by)
    return merge_rows([point, curve], by)


def _auc_and_ap(cum: DataFrame, by: list[str]) -> DataFrame:
    neg = (F.col("n") - F.col("pos")).cast("double")
    neg_below = (F.col("cum_n") - F.col("cum_pos")) - neg
    flagged = F.col("tot_n") - F.col("cum_n") + F.col("n")
    hits = (F.col("tot_pos") - F.col("cum_pos") + F.col("pos")).cast("double")
    g = cum.groupBy(*by).agg(
        F.sum(F.col("pos") * (neg_below + neg / 2)).alias("_u"),
        F.sum(F.col("pos") * (hits / flagged)).alias("_s"),
        F.max("tot_pos").cast("double").alias("_p"),
        F.max("tot_n").cast("double").alias("_n"),
    )
    roc = F.try_divide(F.col("_u"), F.col("_p") * (F.col("_n") - F.col("_p")))
    return g.select(
        *by,
        F.coalesce(F.try_divide("_s", "_p"), F.lit(0.0)).alias("pr_auc"),
        roc.alias("roc_auc"), (2 * roc - 1).alias("gini"),
    )


def precision_recall(df: DataFrame, score, y, threshold, by: Sequence[str] = ()) -> DataFrame:
    return confusion(df, score, y, threshold, by).select(*by, "precision", "recall", "flagged_share")


def evaluate_portfolio(
    df: DataFrame, score: str, y: str, threshold, bands: int = 10, minimum: int = 200, by: Sequence[str] = ()
) -> DataFrame:
    """AUC, Gini, decile rates and lift, precision, recall and flagged share, one row per group."""
    by = list(by)
    buckets = ranking.buckets_for(df, score)
    parts = [
        ranking.auc(df, score, y, by, buckets=buckets).select(*by, "auc", "gini"),
        ranking.decile_lift(df, score, y, bands, minimum, by, buckets=buckets),
        precision_recall(df, score, y, threshold, by),
    ]
    return merge_rows(parts, by)


def threshold_sweep(df: DataFrame, score: str, y: str, thresholds: Sequence[float]) -> DataFrame:
    """Thresholded metrics for every threshold in one scan.

    Each row falls into one of len(thresholds) + 1 intervals; the counts per interval are then summed
    upwards, so rows are never multiplied by the number of thresholds.
    """
    cuts = sorted(set(float(t) for t in thresholds))
    per = (
        df.select(bucket_index(F.col(score).cast("double"), cuts, side="right").alias("i"), F.col(y).cast("int").alias("y"))
        .where("i is not null")
        .groupBy("i")
        .agg(F.count("*").alias("n"), F.sum("y").alias("p"))
    )
    steps = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("k"), F.lit(c).alias("threshold")) for k, c in enumerate(cuts)]))
    wide = per.select(steps.alias("t"), "i", "n", "p")  # intervals x thresholds, independent of the rows
    above = F.col("i") >= F.col("t.k")
    g = wide.groupBy(F.col("t.threshold").alias("threshold")).agg(
        F.sum(F.when(above, F.col("p")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("n")).otherwise(0)).alias("flagged"),
        F.sum("p").alias("positives"),
        F.sum("n").alias("n"),
    )
    return g.select(
        "threshold", "tp", "flagged",
        _safe(F.col("tp"), F.col("flagged")).alias("precision"),
        _safe(F.col("tp"), F.col("positives")).alias("recall"),
        _safe(F.col("flagged"), F.col("n")).alias("flagged_share"),
    )


def trivial_baseline(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Metrics of predicting that nobody is positive."""
    return df.groupBy(*by).agg((1 - F.avg(F.col(y).cast("double"))).alias("accuracy")).select(
        *by, "accuracy", F.lit(0.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(0.0).alias("f1")
    )


def calibration_bands(df: DataFrame, p: str, y: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Observed rate against mean prediction in equal-frequency bands of the prediction itself.

    Edges are quantiles of p, right-closed, repeated edges merged.
    """
    by = list(by)
    named = {f"_e{j}": j / bins for j in range(1, bins)}
    if by:
        cuts = grouped_quantiles(df, by, p, named).select(*by, F.array(*named).alias("_cuts"))
        rows = null_safe_join(df.select(*by, p, y), cuts, by)
    else:
        got = exact_quantiles(df, [p], list(named.values()))[p]
        rows = df.select(p, y).withColumn("_cuts", F.array(*[F.lit(v) for v in got]))
    inner = F.array_distinct(F.col("_cuts"))
    banded = rows.where(F.col(p).isNotNull()).withColumn("band", F.size(F.filter(inner, lambda e: e < F.col(p))))
    return banded.groupBy(*by, "band").agg(
        F.count("*").alias("n"), F.avg(F.col(p)).alias("mean_pred"), F.avg(F.col(y).cast("double")).alias("observed")
    )


def ece(df: DataFrame, p: str, y: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Expected calibration error: rows-weighted gap between observed and predicted over the bands."""
    gap = F.sum(F.col("n") * F.abs(F.col("observed") - F.col("mean_pred"))) / F.sum("n").cast("double")
    return calibration_bands(df, p, y, bins, by).groupBy(*by).agg(gap.alias("ece"))


def calibration_table(df: DataFrame, p: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Brier against a constant prevalence, log-loss with the prediction clipped at 1e-6, means."""
    q = F.least(F.greatest(F.col(p).cast("double"), F.lit(1e-6)), F.lit(1 - 1e-6))
    t = F.col(y).cast("double")
    g = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.pow(F.col(p).cast("double") - t, 2)).alias("brier"),
        F.avg(-(t * F.log(q) + (1 - t) * F.log(1 - q))).alias("logloss"),
        F.avg(F.col(p).cast("double")).alias("mean_pred"),
        F.avg(t).alias("observed"),
    )
    return g.withColumn("brier_constant", F.col("observed") * (1 - F.col("observed")))


def flag_overlap(df: DataFrame, a: str, b: str, share: float) -> DataFrame:
    """Of the rows score a flags, the share score b flags too; and how many rows tie at b's cut."""
    q = exact_quantiles(df, [a, b], [1 - share])
    ca, cb = F.lit(q[a][0]), F.lit(q[b][0])
    fa, fb = F.col(a) >= ca, F.col(b) >= cb
    return df.agg(
        F.count_if(fa).alias("flagged_a"),
        F.count_if(fb).alias("flagged_b"),
        _safe(F.count_if(fa & fb), F.count_if(fa)).alias("overlap"),
        _safe(F.count_if(F.col(b) == cb), F.count("*")).alias("ties_share_at_cut"),
    )


def max_abs_diff(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Largest absolute difference of score columns that should agree."""
    return df.agg(*[F.max(F.abs(F.col(a) - F.col(b))).alias(n) for n, (a, b) in pairs.items()])


def normalise_metrics(long: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Each metric scaled to 0..1 across the models of a results table (model, metric, value)."""
    spans = long.groupBy(metric).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    out = null_safe_join(long, spans, [metric])
    scaled = F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return out.withColumn("scaled", scaled).drop("_lo", "_hi")


def fold_summary(folds: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of fold metrics, one row per metric."""
    long = folds.unpivot(list(by), list(metrics), "metric", "value") if by else folds.unpivot([], list(metrics), "metric", "value")
    return long.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )


def fold_verdict(df: DataFrame, diff: str, by: Sequence[str] = (), k: float = 2.0) -> DataFrame:
    """Real only when the mean gain beats k standard errors and every fold gains."""
    g = df.groupBy(*by).agg(
        F.avg(diff).alias("mean"), F.stddev_samp(diff).alias("sd"), F.count(diff).alias("folds"),
        F.count_if(F.col(diff) > 0).alias("wins"),
    )
    se = F.col("sd") / F.sqrt(F.col("folds").cast("double"))
    return g.select(
        *by, "mean", "sd", se.alias("se"), "wins", "folds",
        F.coalesce((F.col("mean") > k * se) & (F.col("wins") == F.col("folds")), F.lit(False)).alias("real"),
    )

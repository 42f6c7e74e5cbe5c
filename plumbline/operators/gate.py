"""The decision whether a candidate replaces the champion, as a table of checks."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import ranking
from plumbline.operators.resampling import paired_bootstrap
from plumbline.session import written


@dataclass(frozen=True)
class GateSpec:
    # The published promotion rules.
    min_pr_auc_gain: float = 0.005
    replicates: int = 1000
    confidence: float = 0.95
    seed: int = 0
    flagged_share_ratio: tuple[float, float] = (0.5, 2.0)


@dataclass(frozen=True)
class Entrant:
    """A score column with the metadata frozen at its fit."""

    score: str
    features: Sequence[str]
    threshold: float | None = None
    flagged_share_at_fit: float | None = None


def promotion_gate(df: DataFrame, candidate: Entrant, champion: Entrant, y: str, key: Sequence[str], spec: GateSpec = GateSpec()) -> DataFrame:
    """(check, passed, value, detail) rows plus a final `decision` row: promote only when every check passed.

    Metadata checks come first; scores are read only when they hold, and compared only when none is missing: a gain over the rows that
    happen to have a score would say nothing. The table is read many times, so it should be stored.
    """
    spark = df.sparkSession
    schema = "position int, check string, passed boolean, value double, detail string"
    meta = [
        (0, "meta_has_threshold", candidate.threshold is not None, None, "a threshold was frozen when the candidate was fitted"),
        (1, "same_features", list(candidate.features) == list(champion.features), None, "both score from one list of features"),
    ]
    checks = spark.createDataFrame(meta, schema)
    if all(m[2] for m in meta):
        checks = checks.unionByName(_score_checks(df, candidate, champion, y, key, spec))
    failed = F.count_if(~F.col("passed"))
    decision = checks.agg(
        F.lit(99).alias("position"), F.lit("decision").alias("check"), (failed == 0).alias("passed"), failed.cast("double").alias("value"),
        F.when(failed == 0, F.lit("promote: every check passed")).otherwise(
            F.concat(F.lit("keep: "), F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check")))), ", "))
        ).alias("detail"),
    )
    return checks.unionByName(decision)


def _score_checks(df: DataFrame, candidate: Entrant, champion: Entrant, y: str, key: Sequence[str], spec: GateSpec) -> DataFrame:
    a, b = F.col(candidate.score).cast("double"), F.col(champion.score).cast("double")
    bad = F.count_if(a.isNull() | F.isnan(a) | b.isNull() | F.isnan(b))
    share = F.avg(F.coalesce(a >= F.lit(candidate.threshold), F.lit(False)).cast("double"))
    fit = candidate.flagged_share_at_fit
    lo, hi = spec.flagged_share_ratio
    seen = df.agg(bad.alias("bad"), share.alias("share")).first()
    basic = df.sparkSession.createDataFrame([(seen.bad, seen.share)], "bad long, share double")
    in_band = F.lit(False) if fit is None else F.col("share").between(lo * fit, hi * fit)
    base = basic.select(F.inline(F.array(
        _row(2, "no_missing_scores", F.col("bad") == 0, F.col("bad"), "rows that lack a score of either model"),
        _row(3, "flagged_share_in_band", in_band, F.col("share"), f"flagged at the frozen threshold, allowed {lo} to {hi} times {fit}"),
    )))
    if seen.bad:
        return base
    # one model after the other: what the first shuffles is gone before the second begins
    ap = functools.reduce(DataFrame.unionByName, [
        written(ranking.average_precision(df.select(F.lit(m).alias("m"), y, s.alias("s")), "s", y, ["m"]), "gate") for m, s in (("a", a), ("b", b))
    ])
    gain = ap.agg((F.max(F.when(F.col("m") == "a", F.col("pr_auc"))) - F.max(F.when(F.col("m") == "b", F.col("pr_auc")))).alias("g"))
    gained = gain.select(F.inline(F.array(
        _row(4, "pr_auc_gain", F.col("g") >= spec.min_pr_auc_gain, F.col("g"), f"average precision above the champion's, at least {spec.min_pr_auc_gain}")
    )))
    ci = paired_bootstrap(df, candidate.score, champion.score, y, key, ("pr_auc",), spec.replicates, spec.seed, None, spec.confidence)
    excl = ci.select(F.inline(F.array(
        _row(5, "bootstrap_excludes_zero", F.col("lo") > 0, F.col("lo"), f"lower end of the paired {spec.confidence:.0%} interval of that gain, above 0")
    )))
    return base.unionByName(gained).unionByName(excl)


def _row(position: int, check: str, passed, value, detail: str):
    return F.struct(
        F.lit(position).alias("position"), F.lit(check).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
        value.cast("double").alias("value"), F.lit(detail).alias("detail"),
    )

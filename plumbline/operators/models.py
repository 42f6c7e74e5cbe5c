"""Candidate models on Spark ML: pipelines fitted per window or fold, calibration, search, selection."""

from __future__ import annotations

import functools
import math
import random
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from plumbline.operators import evaluate, isotonic
from plumbline.operators.engineer import EngineerState, ScalerState, apply_engineer, apply_scaler, fit_engineer, fit_scaler
from plumbline.operators.ranking import null_safe_join
from plumbline.session import written
from plumbline.spec import PortfolioSpec


@dataclass(frozen=True)
class Candidate:
    """One model family: `kind` is logistic, gbt or forest; `search` maps a parameter to its space."""

    name: str
    kind: str
    params: dict = field(default_factory=dict)
    scale: bool = False
    search: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Space:
    """A declared search space: float or int with bounds (log or step), or categorical choices."""

    type: str
    low: float | None = None
    high: float | None = None
    log: bool = False
    step: float | None = None
    choices: tuple = ()

    def __post_init__(self):
        if self.type == "categorical":
            if not self.choices:
                raise ValueError("a categorical space needs choices")
        elif self.low is None or self.high is None or self.low >= self.high:
            raise ValueError(f"a {self.type} space needs low < high")

    def draw(self, rng: random.Random):
        if self.type == "categorical":
            return rng.choice(list(self.choices))
        if self.log:
            v = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        else:
            v = rng.uniform(self.low, self.high)
        if self.step:
            v = self.low + round((v - self.low) / self.step) * self.step
        return int(round(v)) if self.type == "int" else min(max(v, self.low), self.high)


@dataclass
class FittedModel:
    """Engineer -> [scale] -> estimator, all learned from the rows given to fit_candidate."""

    candidate: Candidate
    engineer: EngineerState
    scaler: ScalerState | None
    model: object
    inputs: list[str]

    def score(self, df: DataFrame, name: str = "score", keep: Sequence[str] | None = None) -> DataFrame:
        """Adds the positive-class probability. Row-independent: a row scores the same in any batch."""
        keep = list(keep) if keep is not None else df.columns
        held = df.select("*", F.struct(*keep).alias("_keep"))
        z = apply_engineer(held, self.engineer, ["_keep"])
        if self.scaler:
            z = apply_scaler(z, self.scaler)
        if isinstance(self.model, LogisticRegressionModel):
            # a weighted sum stays in generated code; no vector is built
            margin = F.lit(float(self.model.intercept))
            for c, w in zip(self.inputs, self.model.coefficients.toArray()):
                if w:
                    margin = margin + F.lit(float(w)) * F.col(f"`{c}`")
            return z.select("_keep.*", (1 / (1 + F.exp(-margin))).alias(name))
        z = VectorAssembler(inputCols=self.inputs, outputCol="_x").transform(z)
        out = self.model.transform(z.select("_keep", "_x"))
        return out.select("_keep.*", vector_to_array("probability")[1].alias(name))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Feature importances, or absolute coefficients, largest first."""
        raw = self.model.featureImportances if hasattr(self.model, "featureImportances") else self.model.coefficients
        rows = [(n, abs(float(v))) for n, v in zip(self.inputs, raw.toArray())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def build_estimator(kind: str, params: dict, n: int, seed: int):
    """Spark ML estimator from familiar parameters.

    C multiplies the summed loss there, regParam the mean loss here, hence 1 / (C n); columns are scaled
    by our own population scaler, so ML's standardisation stays off.
    """
    p = dict(params)
    if kind == "logistic":
        return LogisticRegression(
            featuresCol="_x", labelCol="_y", weightCol="_w", maxIter=p.get("max_iter", 100), tol=1e-8, standardization=False,
            regParam=1.0 / (p.get("C", 1.0) * n), elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0,
        )
    if kind == "gbt":
        return GBTClassifier(
            featuresCol="_x", labelCol="_y", weightCol="_w", seed=seed, maxIter=p.get("n_estimators", 20),
            maxDepth=p.get("max_depth", 3), stepSize=p.get("learning_rate", 0.1), subsamplingRate=p.get("subsample", 1.0),
            minInstancesPerNode=p.get("min_child", 1), featureSubsetStrategy=str(p.get("colsample", "all")),
        )
    if kind == "forest":
        return RandomForestClassifier(
            featuresCol="_x", labelCol="_y", weightCol="_w", seed=seed, numTrees=p.get("n_estimators", 300),
            maxDepth=p.get("max_depth", 10), minInstancesPerNode=p.get("min_leaf", 50), featureSubsetStrategy="sqrt",
        )
    raise ValueError(f"unknown model kind {kind!r}")


def fit_candidate(train: DataFrame, candidate: Candidate, spec: PortfolioSpec, y: str, features: Sequence[str], seed: int = 0) -> FittedModel:
    """Learns every transform and the model from `train` only."""
    x = train.select(*features)
    engineer = fit_engineer(x, spec)
    z = apply_engineer(train, engineer, [y])
    scaler = fit_scaler(z, engineer.output) if candidate.scale else None
    if scaler:
        z = apply_scaler(z, scaler)
    counts = train.agg(F.count("*").alias("n"), F.sum(F.col(y).cast("int")).alias("p")).first()
    n, pos = counts["n"], counts["p"] or 0
    if not 0 < pos < n:
        raise ValueError("a model needs both classes in its training rows")
    weight = F.lit(1.0)
    if candidate.params.get("class_weight") == "balanced":
        weight = F.when(F.col("_y") == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos)))
    elif candidate.params.get("scale_pos_weight"):
        weight = F.when(F.col("_y") == 1, float(candidate.params["scale_pos_weight"])).otherwise(1.0)
    data = VectorAssembler(inputCols=engineer.output, outputCol="_x").transform(z).select("_x", F.col(y).cast("double").alias("_y"))
    data = data.withColumn("_w", weight)
    estimator = build_estimator(candidate.kind, candidate.params, n, seed)
    if candidate.kind == "logistic":
        # it reads the rows twice and keeps blocks of them for its iterations; vectors kept here as well would double that
        model = estimator.fit(data)
    else:
        # Every iteration reads the same vectors; they are computed once and released after the fit.
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = estimator.fit(data)
        finally:
            data.unpersist()
    if candidate.kind == "forest":
        # the training summary holds the session, which cannot travel to tasks once a query was observed
        model._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return FittedModel(candidate, engineer, scaler, model, engineer.output)


def score_folds(
    folded: DataFrame, fold_values: Sequence[int], fit: Callable[[DataFrame], FittedModel], y: str, key: Sequence[str],
    role: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(fold metrics, out-of-fold scores): one fit per fold on its training rows, nothing fitted globally.

    With `role` the frame has explicit train / validate rows per fold (time folds); otherwise a row
    validates in its own fold and trains in the others.
    """
    oof = None
    for k in fold_values:
        if role:
            train, held = folded.where((F.col("fold") == k) & (F.col(role) == "train")), folded.where((F.col("fold") == k) & (F.col(role) == "validate"))
        else:
            train, held = folded.where(F.col("fold") != k), folded.where(F.col("fold") == k)
        part = fit(train).score(held, "score", [*key, y]).withColumn("fold", F.lit(k))
        oof = part if oof is None else oof.unionByName(part)
    oof = written(oof, "folds")  # metrics read the scores several times
    metrics = evaluate.classification_summary(oof, "score", y, 0.5, ["fold"]).select("fold", "pr_auc", "roc_auc")
    return metrics, oof


def search(
    train: DataFrame, candidate: Candidate, spec: PortfolioSpec, y: str, features: Sequence[str], key: Sequence[str],
    n_trials: int = 25, folds: int = 5, seed: int = 0, metric: str = "pr_auc",
) -> tuple[DataFrame, dict]:
    """(trials table, best parameters): seeded random draws scored by cross-validation on hashed folds.

    The driver loop only starts jobs; each trial is `folds` distributed fits and one metric job.
    """
    from plumbline.operators.split import stratified_folds

    spark = train.sparkSession
    rng = random.Random(seed)
    folded = stratified_folds(train, y, key, folds, seed=seed).drop("repeat")
    rows, best = [], None
    for trial in range(n_trials):
        params = {**candidate.params, **{k: s.draw(rng) for k, s in candidate.search.items()}}
        tried = Candidate(candidate.name, candidate.kind, params, candidate.scale)
        metrics, _ = score_folds(folded, range(folds), lambda t, c=tried: fit_candidate(t, c, spec, y, features, seed), y, key)
        got = metrics.agg(F.avg(metric).alias("m"), F.stddev_pop(metric).alias("s")).first()
        rows.append((candidate.name, trial, str(params), got["m"], got["s"]))
        if best is None or got["m"] > best[0]:
            best = (got["m"], params)
    return spark.createDataFrame(rows, "model string, trial int, params string, cv_mean double, cv_std double"), best[1]


def evaluate_candidate(
    name: str, train: DataFrame, test: DataFrame, candidate: Candidate, spec: PortfolioSpec, y: str,
    features: Sequence[str], key: Sequence[str], share: float, seed: int = 0, cv: tuple[float, float] | None = None,
) -> tuple[DataFrame, FittedModel]:
    """Fit on the training window, read the held-out one once, threshold at the flagged share."""
    start = time.perf_counter()
    model = fit_candidate(train, candidate, spec, y, features, seed)
    fit_s = time.perf_counter() - start
    scored = model.score(test, "score", [*key, y])
    cut = evaluate.freeze_threshold(scored, "score", share)
    n = test.count()
    start = time.perf_counter()
    scored.agg(F.sum("score")).first()  # scores every row and nothing else
    ms = (time.perf_counter() - start) * 1e6 / max(n, 1)
    out = evaluate.classification_summary(scored, "score", y, cut)
    mean, std = cv or (None, None)
    return out.select(
        F.lit(name).alias("model"), F.lit(mean).cast("double").alias("cv_mean"), F.lit(std).cast("double").alias("cv_std"),
        *out.columns, F.lit(cut).alias("threshold"), F.lit(fit_s).alias("fit_s"), F.lit(ms).alias("predict_ms_1k"),
    ), model


def calibrate(df: DataFrame, score: str, y: str, key: Sequence[str], k: int = 5, method: str = "isotonic", seed: int = 0) -> Callable[[DataFrame], DataFrame]:
    """Learns k calibrators, each on the rows outside one hashed fold, and returns a function that adds
    `calibrated`: the mean of the k predictions."""
    fold = F.pmod(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), F.lit(k))
    if method == "isotonic":
        # a row teaches every fold's calibrator but its own
        others = df.select(F.col(score).cast("double").alias("_s"), F.col(y).cast("double").alias("_y"), fold.alias("_own"))
        others = others.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).where("fold <> _own")
        pools = isotonic.fit(others.groupBy("fold", "_s", "_y").agg(F.count("*").alias("_n")), "_s", "_y", ["fold"], weight="_n")
        return lambda frame, name="calibrated": _isotonic_mean(frame, score, pools, k, name)
    if method != "sigmoid":
        raise ValueError(f"unknown calibration method {method!r}")
    folded = df.withColumn("_f", fold)
    models = []
    for i in range(k):
        part = folded.where(F.col("_f") != i).select(F.col(score).cast("double").alias("_s"), F.col(y).cast("double").alias("_y"))
        data = VectorAssembler(inputCols=["_s"], outputCol="_x").transform(part)
        m = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=0.0, standardization=False).fit(data)
        models.append((float(m.coefficients[0]), float(m.intercept)))

    def apply(frame: DataFrame, name: str = "calibrated") -> DataFrame:
        s = F.col(score).cast("double")
        total = F.lit(0.0)
        for slope, level in models:
            total = total + 1 / (1 + F.exp(-(F.lit(slope) * s + F.lit(level))))
        return frame.withColumn(name, F.when(s.isNotNull(), total / k))

    return apply


def _isotonic_mean(frame: DataFrame, score: str, pools: DataFrame, k: int, name: str) -> DataFrame:
    """Adds the mean of what the k fits tell at each score. The fits are read once for each distinct score, and rows take it by their score."""
    s = F.col(score).cast("double") + 0.0
    asked = frame.select(s.alias("_s")).distinct().withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    told = isotonic.read_at(asked, "_s", pools, ["fold"], "_v").groupBy("_s").agg(F.avg("_v").alias(name))
    return frame.withColumn("_at", s).join(told, F.col("_at") == F.col("_s"), "left").drop("_at", "_s")


def score_with(df: DataFrame, fn: Callable, features: Sequence[str], name: str = "score") -> DataFrame:
    """Scores with a foreign model: fn(pandas frame of features) -> sequence, on Arrow batches."""
    @pandas_udf(T.DoubleType())
    def run(x: pd.DataFrame) -> pd.Series:
        return pd.Series(fn(x), dtype="float64")

    return df.withColumn(name, run(F.struct(*features)))


# --- Result tables: one row per (run..., model) ---


def select_champion(results: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metric rounded to four digits; ties go to the smaller cv_std, an unknown
    spread loses, a NULL or NaN metric never wins. Groups without a usable metric give no row."""
    m = F.col(metric)
    usable = results.where(m.isNotNull() & ~F.isnan(m))
    std = F.when(F.isnan("cv_std"), None).otherwise(F.col("cv_std"))
    order = F.struct(F.round(m, 4).alias("m"), F.coalesce(-std, F.lit(float("-inf"))).alias("s"))
    best = usable.groupBy(*by).agg(F.max_by(F.struct(*results.columns), order).alias("_b"))
    return best.select("_b.*").where(m.isNotNull())


def champion_or_fail(results: DataFrame, metric: str) -> dict:
    row = select_champion(results, metric).first()
    if row is None:
        raise ValueError(f"no candidate reports {metric!r}")
    return row.asDict()


def comparison_table(results: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Candidates by metric, with the gap to the next best of the same run. A run holds a few models."""
    w = Window.partitionBy(*by).orderBy(F.desc_nulls_last(metric), "model")
    return results.withColumns({
        "rank": F.row_number().over(w), "next_best": F.lead("model").over(w), "lead_over_next": F.col(metric) - F.lead(metric).over(w),
    })


def deltas(results: DataFrame, reference: str, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Each candidate's metrics minus those of the reference model of the same run."""
    ref = results.where(F.col("model") == reference)
    if by:
        base = ref.select(*by, *[F.col(m).alias(f"_{m}") for m in metrics])
        out = null_safe_join(results, base, list(by), "left")
        return out.select(*by, "model", *[(F.col(m) - F.col(f"_{m}")).alias(f"{m}_delta") for m in metrics])
    return results.select("model", *[(F.col(m) - ref.select(m).scalar()).alias(f"{m}_delta") for m in metrics])


def cv_gap(results: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """Cross-validated minus held-out metric; positive is optimism."""
    known = F.col("cv_mean").isNotNull() & ~F.isnan("cv_mean")
    return results.where(known).select("model", "cv_mean", "cv_std", metric, (F.col("cv_mean") - F.col(metric)).alias("gap"))


def metric_floors(metrics: DataFrame, minimums: dict[str, float]) -> DataFrame:
    """One row per required metric: missing, not a number, below its minimum, or passed. Input is (metric, value)."""
    floors = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(float(v)).alias("minimum")) for m, v in minimums.items()])
    wanted = metrics.sparkSession.range(1).select(F.inline(floors))
    j = wanted.join(metrics.select("metric", F.col("value").cast("double").alias("value")), "metric", "left")
    problem = (
        F.when(F.col("value").isNull() | F.isnan("value"), "missing or not a number")
        .when(F.col("value") < F.col("minimum"), "below the minimum")
    )
    return j.select("metric", "minimum", "value", problem.isNull().alias("passed"), F.coalesce(problem, F.lit("")).alias("problem"))


def metrics_table(
    preds: DataFrame, entries: Sequence[dict], y: str, key: Sequence[str], share: float, replicates: int = 1000, seed: int = 0,
    reference: str | None = None,
) -> DataFrame:
    """One row per declared model over a wide prediction table: point metrics at the flagged share, their
    intervals, and whether the model can be told from the reference. An optional model without a score
    column is listed as pending; a required one is an error.

    The predictions are read many times, so they should be stored. Models come one after the other, and what one
    shuffles is gone before the next. Where neither has gaps, a model and the reference are compared on the
    replicates they already have."""
    from plumbline.operators.quantiles import exact_quantiles
    from plumbline.operators.resampling import bootstrap_replicates, interval, paired_bootstrap, paired_interval

    spark = preds.sparkSession
    have = [e["id"] for e in entries if e["id"] in preds.columns]
    lacking = [e["id"] for e in entries if e["id"] not in preds.columns and not e.get("optional")]
    if lacking:
        raise KeyError(f"predictions missing for {lacking}")
    cuts = exact_quantiles(preds, have, [1 - share])
    def stacked(of: Callable[[DataFrame, str], DataFrame], kind: str) -> DataFrame:
        rows = {m: preds.select(F.lit(m).alias("id"), *key, y, F.col(m).cast("double").alias("score")) for m in have}
        return functools.reduce(DataFrame.unionByName, [written(of(rows[m], m), kind) for m in have])

    point = stacked(lambda rows, m: evaluate.classification_summary(rows, "score", y, cuts[m][0], ["id"]), "points")
    listed = spark.createDataFrame(
        [(e["id"], e.get("label", e["id"]), "ok" if e["id"] in have else "pending", bool(e.get("probabilistic"))) for e in entries],
        "id string, label string, status string, probabilistic boolean",
    )
    out = listed.join(point, "id", "left").withColumn("brier", F.when(F.col("probabilistic"), F.col("brier"))).drop("probabilistic")
    reps = stacked(lambda rows, m: bootstrap_replicates(rows, "score", y, key, replicates, seed, ["id"], share), "replicates")
    ci = interval(reps, ("pr_auc", "roc_auc", "gini", "f1"), ["id"])
    wide = ci.groupBy("id").pivot("metric", ["pr_auc", "roc_auc", "gini", "f1"]).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    out = out.join(wide, "id", "left")
    if reference:
        diffs = None
        gaps = preds.agg(*[F.count_if(F.col(m).isNull()).alias(m) for m in have]).first()
        for m in have:
            if m != reference:
                whole = reference in have and not gaps[m] and not gaps[reference]
                d = paired_interval(reps, "id", m, reference, ("pr_auc",)) if whole else paired_bootstrap(preds, m, reference, y, key, ("pr_auc",), replicates, seed, share)
                d = d.select(F.lit(m).alias("id"), F.col("lo").alias("diff_lo"), F.col("hi").alias("diff_hi"))
                diffs = d if diffs is None else diffs.unionByName(d)
        if diffs is not None:
            out = out.join(diffs, "id", "left").withColumn("distinguishable", ~((F.col("diff_lo") <= 0) & (F.col("diff_hi") >= 0)))
    return out

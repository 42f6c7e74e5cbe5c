import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import encode, engineer, gate, models, resampling
from plumbline.operators.smote import nearest_points, smote
from plumbline.spec import PortfolioSpec
from tests.test_ranking import brute_ap, brute_auc

SPEC = PortfolioSpec(entity_key="k", event_timestamp="t", target="y", categoricals={"c": ("u", "v")}, heavy_tailed=("a",), log_scale=("a",), winsor_quantile=0.9)


@pytest.fixture
def train(frame):
    rows = [(float(i), float(i % 5) if i % 4 else None, "u" if i % 2 else None, bool(i % 3), None) for i in range(101)]
    return frame(rows, "a double, b double, c string, f boolean, gone double")


def test_state_comes_from_training_rows_and_is_applied_in_order(frame, train):
    st = engineer.fit_engineer(train, SPEC)
    assert st.caps == {"a": pytest.approx(90.0)} and st.medians["a"] == 50.0 and st.medians["gone"] == 0.0
    rows = [(1e9, None, "u", True, None), (float("inf"), float("inf"), "w", None, 1.0), (float("nan"), 2.0, None, False, None), (-5.0, 1.0, "v", True, None), (float("-inf"), 0.0, "v", True, None)]
    out = engineer.apply_engineer(frame(rows, "a double, b double, c string, f boolean, gone double", 1), st).collect()
    assert [r.a for r in out] == pytest.approx([math.log1p(90), math.log1p(90), math.log1p(50), 0.0, math.log1p(50)])
    assert out[0].b == st.medians["b"] and out[1].b == st.medians["b"] and out[1].f == st.medians["f"]
    assert [(r.c_u, r.c_v) for r in out] == [(1, 0), (0, 0), (0, 0), (0, 1), (0, 1)]
    assert list(out[0].asDict()) == st.output
    with pytest.raises(ValueError, match="numeric or declared"):
        engineer.fit_engineer(train.withColumn("text", F.lit("x")), SPEC)


def test_imputation_ignores_test_rows(frame):
    rows = [(1.0, "x", "TRAIN"), (3.0, None, "TRAIN"), (None, "y", "TEST"), (1000.0, None, "TEST")]
    out = engineer.impute_from_train(frame(rows, "n double, c string, s string"), ["n"], ["c"], "s", "TRAIN")
    assert sorted((r.n, r.c) for r in out.collect()) == [(1.0, "x"), (2.0, "y"), (3.0, "missing"), (1000.0, "missing")]


def test_scaler_uses_the_population_deviation(frame):
    st = engineer.fit_scaler(frame([(1.0, 5.0), (3.0, 5.0)], "a double, b double"), ["a", "b"])
    assert (st.mean["a"], st.scale["a"], st.scale["b"]) == (2.0, 1.0, 1.0)


def test_woe_matches_numpy(frame):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=600), rng.integers(0, 2, 600)
    df = frame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    st = encode.fit_woe(df, ["x"], "y", 5)
    edges = np.quantile(x, [0.2, 0.4, 0.6, 0.8])
    b = np.searchsorted(edges, x, side="right")
    want = [math.log(((y[b == k].sum() + 0.5) / y.sum()) / (((b == k).sum() - y[b == k].sum() + 0.5) / (600 - y.sum()))) for k in range(5)]
    assert st.edges["x"] == pytest.approx(list(edges)) and st.woe["x"] == pytest.approx(want)
    assert encode.apply_woe(df, st, keep_original=False).columns == ["y", "x_woe"]


def test_target_encoding_never_sees_its_own_fold(frame):
    rows = [(i, "abc"[i % 3], int(i % 3 == 0 or i % 7 == 0)) for i in range(900)]
    df = frame(rows, "id int, c string, y int")
    out = encode.target_encode(df, ["c"], "y", ["id"], 5, smooth=0.0).withColumn("f", F.pmod(F.xxhash64("id", F.lit(0)), F.lit(5)))
    got = {(r.c, r.f): r.c_te for r in out.collect()}
    folds = {r.id: r.f for r in out.collect()}
    for (c, f), enc in got.items():
        other = [y for i, cc, y in rows if cc == c and folds[i] != f]
        assert enc == pytest.approx(np.mean(other))
    state = encode.fit_target_encoding(df, ["c"], "y")
    fresh = encode.apply_target_encoding(frame([("a",), ("never",)], "c string"), state, ["c"], 0.25)
    assert {r.c: r.c_te for r in fresh.collect()}["never"] == 0.25


def scored(frame, n=400, seed=0, decimals=2):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(rng.normal(y * 0.5, 1), decimals)
    return frame([(i, float(a), float(a), float(-a), int(b)) for i, (a, b) in enumerate(zip(s, y))], "id int, s double, same double, neg double, y int"), s, y


def test_bootstrap_against_direct_weighting(frame):
    df, s, y = scored(frame, 200)
    want = {}
    key = {r.id: r.h for r in df.select("id", F.xxhash64("id").alias("h")).collect()}
    w = resampling.poisson_counts(np.array([key[i] for i in range(200)]), np.arange(4), 0)
    for r in range(4):
        ss, yy = np.repeat(s, w[:, r]), np.repeat(y, w[:, r])
        cut = np.quantile(ss, 1 - 0.2)
        f = ss >= cut
        want[r] = (brute_auc(ss, yy), brute_ap(ss, yy), 2 * (f & (yy == 1)).sum() / (f.sum() + yy.sum()))
    assert (w[:, 0] == 1).all()
    for hot in (10**9, 3):
        got = {r.rep: (r.roc_auc, r.pr_auc, r.f1) for r in resampling.bootstrap_replicates(df, "s", "y", ["id"], 3, 0, share=0.2, hot_rows=hot).collect()}
        for r in range(4):
            assert got[r] == pytest.approx(want[r])


def test_counts_are_poisson_one():
    w = resampling.poisson_counts(np.arange(50_000), np.arange(1, 4), 5)
    assert w.mean() == pytest.approx(1, abs=0.02) and w.var() == pytest.approx(1, abs=0.03)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.02


def test_identical_scores_differ_by_nothing(frame):
    df, _, _ = scored(frame)
    same = resampling.paired_bootstrap(df, "s", "same", "y", ["id"], ("pr_auc", "roc_auc"), 20)
    assert all((r.point, r.lo, r.hi) == (0.0, 0.0, 0.0) for r in same.collect())
    ci = resampling.bootstrap_ci(df, "s", "y", ["id"], ("roc_auc",), 200).first()
    assert ci.lo < ci.point < ci.hi and 0.01 < ci.hi - ci.lo < 0.25


def test_champion_rules(spark):
    schema = "model string, pr_auc double, cv_std double"
    pick = lambda rows: models.select_champion(spark.createDataFrame(rows, schema), "pr_auc").collect()
    assert pick([("a", 0.5, 0.1), ("b", 0.6, 0.9)])[0].model == "b"
    assert pick([("a", 0.50001, 0.2), ("b", 0.50003, 0.1)])[0].model == "b"
    assert pick([("a", 0.5, None), ("b", 0.5, 0.9)])[0].model == "b"
    assert pick([("a", float("nan"), 0.1), ("b", 0.1, 0.1)])[0].model == "b"
    assert pick([("a", None, 0.1)]) == []
    with pytest.raises(ValueError, match="pr_auc"):
        models.champion_or_fail(spark.createDataFrame([("a", None, 0.1)], schema), "pr_auc")


def test_metric_floors_list_every_problem(spark):
    m = spark.createDataFrame([("gini", 0.4), ("pr_auc", float("nan")), ("f1", 0.1)], "metric string, value double")
    got = {r.metric: r.problem for r in models.metric_floors(m, {"gini": 0.3, "pr_auc": 0.1, "f1": 0.2, "recall": 0.2}).collect()}
    assert got == {"gini": "", "pr_auc": "missing or not a number", "f1": "below the minimum", "recall": "missing or not a number"}


def test_gate_promotes_and_keeps_with_reasons(frame):
    df, _, _ = scored(frame)
    spec = gate.GateSpec(replicates=30)
    good, champ = gate.Entrant("s", ["x"], 0.9, 0.3), gate.Entrant("neg", ["x"])
    rows = {r.check: r for r in gate.promotion_gate(df, good, champ, "y", ["id"], spec).collect()}
    assert rows["decision"].passed and rows["pr_auc_gain"].value > 0.05
    keep = {r.check: r for r in gate.promotion_gate(df, champ.__class__("neg", ["x"], 0.9, 0.01), gate.Entrant("s", ["x"]), "y", ["id"], spec).collect()}
    assert keep["decision"].detail == "keep: bootstrap_excludes_zero, flagged_share_in_band, pr_auc_gain"
    early = {r.check: r for r in gate.promotion_gate(df, gate.Entrant("s", ["x", "z"]), champ, "y", ["id"], spec).collect()}
    assert set(early) == {"meta_has_threshold", "same_features", "decision"} and not early["decision"].passed
    for lack in (F.lit(None), F.lit(float("nan"))):
        some = df.withColumn("neg", F.when(F.col("id") != df.first().id, F.col("neg")).otherwise(lack))
        gaps = {r.check: r for r in gate.promotion_gate(some, good, champ, "y", ["id"], spec).collect()}
        assert set(gaps) == {"meta_has_threshold", "same_features", "no_missing_scores", "flagged_share_in_band", "decision"}
        assert gaps["no_missing_scores"].value == 1 and gaps["decision"].detail == "keep: no_missing_scores"


def test_logistic_recovers_the_signal_and_scores_rows_alone(frame):
    rng = np.random.default_rng(1)
    x = rng.normal(size=600)
    y = (rng.random(600) < 1 / (1 + np.exp(-(0.3 + 1.5 * x)))).astype(int)
    spec = PortfolioSpec(entity_key="k", event_timestamp="t", target="y")
    df = frame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y int")
    m = models.fit_candidate(df, models.Candidate("l", "logistic", {"C": 1e6}, True), spec, "y", ["x"])
    assert m.model.coefficients[0] / x.std() == pytest.approx(1.5, abs=0.35)
    whole = {r.id: r.score for r in m.score(df, "score", ["id"]).collect()}
    assert m.score(df.where("id = 7"), "score", ["id"]).first().score == whole[7]
    assert 0 < min(whole.values()) and max(whole.values()) < 1
    iso = models.calibrate(m.score(df, "score", ["id", "y"]), "score", "y", ["id"], 3)
    cal = iso(m.score(df, "score", ["id", "y"])).orderBy("score").collect()
    assert all(a.calibrated <= b.calibrated + 1e-9 for a, b in zip(cal, cal[1:])) and np.mean([r.calibrated for r in cal]) == pytest.approx(y.mean(), abs=0.03)
    with pytest.raises(ValueError, match="both classes"):
        models.fit_candidate(df.where("y = 1"), models.Candidate("l", "logistic"), spec, "y", ["x"])


def test_search_space_draws_stay_inside():
    import random

    rng = random.Random(0)
    assert all(0.001 <= models.Space("float", 0.001, 100, log=True).draw(rng) <= 100 for _ in range(50))
    assert {models.Space("int", 100, 200, step=50).draw(rng) for _ in range(80)} == {100, 150, 200}
    with pytest.raises(ValueError):
        models.Space("float", 2, 1)


def test_nearest_points_are_exact_with_copies(frame):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(300, 2)), 1)
    df = frame([tuple(map(float, r)) for r in x], "a double, b double").groupBy("a", "b").agg(F.count("*").alias("w"))
    got = {(r.a, r.b): [n.distance for n in r.near] for r in nearest_points(df, ["a", "b"], "w", 4, box_points=25).collect()}
    u = np.unique(x, axis=0) + 0.0
    d = np.sort(np.sqrt(((u[:, None] - u[None]) ** 2).sum(2)), axis=1)
    assert len(got) == len(u)
    for i, p in enumerate(u):
        assert got[tuple(p)] == pytest.approx(list(d[i, 1:5]))


def test_smote_reaches_the_ratio_between_positives(frame):
    rows = [(i, float(i % 50), float(i % 7), int(i % 10 == 0)) for i in range(1000)]
    out = smote(frame(rows, "id int, a double, b double, y int"), "y", ["a", "b"], ["id"], 5, 0.5)
    c = {(r.y, r.synthetic): r["count"] for r in out.groupBy("y", "synthetic").count().collect()}
    assert c[(0, False)] == 900 and c[(1, False)] == 100 and c[(1, True)] == pytest.approx(350, rel=0.1)
    made = out.where("synthetic").agg(F.min("a"), F.max("a"), F.max("b")).first()
    assert made[0] >= 0 and made[1] <= 40 and made[2] <= 6

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import evaluate, ranking
from plumbline.operators.quantiles import Buckets, exact_quantiles, grouped_quantiles, quantile_buckets


def brute_auc(s, y):
    p, q = s[y == 1], s[y == 0]
    return ((p[:, None] > q[None]).sum() + 0.5 * (p[:, None] == q[None]).sum()) / (len(p) * len(q))


def brute_ap(s, y):
    total = 0.0
    for t in np.unique(s):
        total += y[s == t].sum() / y.sum() * y[s >= t].mean()
    return total


def table(frame, s, y, by=None):
    rows = [(float(a), int(b), str(c)) for a, b, c in zip(s, y, by if by is not None else ["g"] * len(s))]
    return frame(rows, "s double, y int, g string")


@pytest.mark.parametrize("scores,expected", [(lambda i: i, 1.0), (lambda i: -i, 0.0), (lambda i: 7, 0.5)])
def test_closed_forms(frame, scores, expected):
    y = np.r_[np.zeros(50), np.ones(50)]
    df = table(frame, [scores(i) for i in range(100)], y)
    got = ranking.auc(df, "s", "y").first()
    assert got.auc == expected and got.gini == 2 * expected - 1


def test_constant_score_has_the_base_rate_as_precision(frame):
    y = [1] * 5 + [0] * 95
    assert ranking.average_precision(table(frame, [0.3] * 100, y), "s", "y").first().pr_auc == pytest.approx(0.05)


def test_single_class_and_missing_scores(frame):
    df = frame([(1.0, 0, "a"), (2.0, 0, "a"), (None, 1, "a"), (float("nan"), 1, "a")], "s double, y int, g string")
    got = ranking.auc(df, "s", "y").first()
    assert (got.n_pos, got.n_neg, got.auc) == (0, 2, None)


@pytest.mark.parametrize("seed", range(3))
def test_metrics_match_brute_force_for_any_buckets(frame, seed):
    rng = np.random.default_rng(seed)
    s = np.round(rng.normal(size=300), 1 if seed else 6)
    y = rng.integers(0, 2, 300)
    df = table(frame, s, y)
    for b in (Buckets(()), Buckets((0.0,)), Buckets((-1.0, 0.0, 0.5), -4.0, 4.0, 5), None):
        assert ranking.auc(df, "s", "y", buckets=b).first().auc == pytest.approx(brute_auc(s, y))
        assert ranking.average_precision(df, "s", "y", buckets=b).first().pr_auc == pytest.approx(brute_ap(s, y))


def test_groups_with_null_keys_keep_their_own_metric(frame):
    rows = [(float(i), i % 2, None if i % 3 else "a") for i in range(60)]
    got = {r.g: r.auc for r in ranking.auc(frame(rows, "s double, y int, g string"), "s", "y", ["g"]).collect()}
    for g in (None, "a"):
        mine = [(s, y) for s, y, k in rows if k == g]
        assert got[g] == pytest.approx(brute_auc(np.array([m[0] for m in mine]), np.array([m[1] for m in mine])))


def test_buckets_are_monotone_and_complete(frame):
    rng = np.random.default_rng(1)
    v = np.sort(rng.lognormal(size=2000))
    df = frame([(float(x),) for x in v], "v double")
    for b in (quantile_buckets(df, "v", rows_per_bucket=10, max_edges=512), quantile_buckets(df, "v", rows_per_bucket=1, max_edges=512), quantile_buckets(df, "v")):
        out = df.select("v", b.index("v").alias("b")).orderBy("v").collect()
        idx = [r.b for r in out]
        assert None not in idx and idx == sorted(idx) and len(set(idx)) > 8


def test_decile_bands_share_ties(frame):
    import pandas as pd

    rng = np.random.default_rng(3)
    s = rng.integers(0, 21, 400).astype(float)
    y = (np.arange(400) % 7 == 0).astype(int)
    bands = pd.qcut(pd.Series(s).rank(method="average"), 10, labels=False, duplicates="drop")
    want = pd.Series(y).groupby(bands).mean()
    got = {r.band: r.rate for r in ranking.band_rates(table(frame, s, y), "s", "y", 10).collect()}
    assert got == pytest.approx(dict(enumerate(want)))


def test_one_tied_score_is_one_band_and_lift_guards(frame):
    df = table(frame, [1.0] * 300, [i % 2 for i in range(300)])
    assert ranking.band_rates(df, "s", "y").count() == 1
    few = ranking.decile_lift(table(frame, range(150), [i % 2 for i in range(150)]), "s", "y").first()
    assert few.decile_lift is None and few.top_decile_rate is None
    clean = ranking.decile_lift(table(frame, range(300), [int(i > 200) for i in range(300)]), "s", "y").first()
    assert clean.top_decile_rate == 1.0 and clean.bottom_decile_rate == 0.0 and clean.decile_lift is None


def test_ks_and_area_match_numpy(frame):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=120), rng.normal(0.7, 1, size=90)
    df = table(frame, np.r_[a, b], np.r_[np.ones(120), np.zeros(90)])
    grid = np.sort(np.r_[a, b])
    fa, fb = np.searchsorted(np.sort(a), grid, "right") / 120, np.searchsorted(np.sort(b), grid, "right") / 90
    got = ranking.ks_two_sample(df, "s", "y").first()
    assert got.ks == pytest.approx(np.abs(fa - fb).max())
    assert got.area == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(grid)).sum())


def test_classification_summary_and_sweep(frame):
    rng = np.random.default_rng(0)
    y = np.r_[np.ones(50), np.zeros(950)].astype(int)
    s = np.clip(rng.normal(0.3 + 0.2 * y, 0.1), 0, 1)
    df = table(frame, s, y)
    r = evaluate.classification_summary(df, "s", "y", 0.4).first()
    f = s >= 0.4
    tp, fp, fn = (f & (y == 1)).sum(), (f & (y == 0)).sum(), (~f & (y == 1)).sum()
    assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, 1000 - tp - fp - fn)
    assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn)) and r.brier == pytest.approx(((s - y) ** 2).mean())
    assert r.pr_auc == pytest.approx(brute_ap(s, y)) and r.roc_auc == pytest.approx(brute_auc(s, y))
    sweep = {x.threshold: x for x in evaluate.threshold_sweep(df, "s", "y", [0.2, 0.4, 2.0]).collect()}
    assert sweep[0.4].tp == tp and sweep[0.4].flagged == tp + fp and sweep[2.0].precision == 0.0
    none = evaluate.classification_summary(df, "s", "y", 2.0, probabilistic=False).first()
    assert none.precision == 0.0 and none.f1 == 0.0 and none.brier is None


def test_threshold_is_a_quantile_and_flags_ties(frame):
    s = [0.1] * 50 + [0.9] * 50
    df = table(frame, s, [0] * 100)
    cut = evaluate.freeze_threshold(df, "s", 0.157)
    assert cut == pytest.approx(np.quantile(s, 1 - 0.157))
    assert evaluate.flag_top_share(df, "s", 0.157).where("flagged").count() == 50


@pytest.mark.parametrize("accuracy", [200, 10_000])
def test_exact_quantiles(frame, accuracy):
    rng = np.random.default_rng(2)
    x = rng.lognormal(size=5000)
    x[:50] = np.nan
    x[50:60] = np.inf
    rows = [(float(v), None if i % 4 else float(i), str(i % 3)) for i, v in enumerate(x)]
    df = frame(rows, "x double, z double, g string")
    probs = [0.0, 0.01, 0.25, 0.5, 0.501, 0.99, 1.0]
    got = exact_quantiles(df, ["x", "z"], probs, accuracy)
    assert exact_quantiles(df, ["x", "z"], probs, accuracy=200, bracket_rows=5) == got  # brackets are sketched again inside
    fin = x[np.isfinite(x)]
    assert got["x"] == pytest.approx(list(np.quantile(fin, probs)))
    assert got["z"] == pytest.approx(list(np.quantile(np.arange(0, 5000, 4), probs)))
    assert exact_quantiles(df.where("g = 'none'"), ["x"], [0.5]) == {"x": [None]}
    groups = grouped_quantiles(df, ["g"], "x", {"hi": 0.95, "lo": 0.05, "mid": 0.5}, accuracy=accuracy).collect()
    for r in groups:
        mine = np.array([v for v, _, k in rows if k == r.g and np.isfinite(v)])
        assert [r.lo, r.mid, r.hi] == pytest.approx(list(np.quantile(mine, [0.05, 0.5, 0.95])))


@pytest.mark.parametrize("n", [1, 2, 7, 3000])
def test_exact_quantiles_of_small_skewed_and_repeated_values(frame, n):
    rng = np.random.default_rng(n)
    columns = [rng.pareto(0.5, n), np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 100), rng.integers(0, 3, n).astype(float)]
    df = frame([tuple(map(float, r)) for r in zip(*columns)], "a double, b double, c double")
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1.0]
    for rows in (2, 10**6):
        got = exact_quantiles(df, ["a", "b", "c"], probs, accuracy=500, bracket_rows=rows)
        for name, x in zip("abc", columns):
            assert got[name] == pytest.approx(list(np.quantile(x, probs)))
            row = grouped_quantiles(df, [], name, {f"p{i}": p for i, p in enumerate(probs)}, accuracy=500).first() if rows == 2 else None
            assert row is None or list(row) == pytest.approx(list(np.quantile(x, probs)))


def test_no_stage_gathers_the_rows_in_one_task(frame):
    df = table(frame, range(100), [i % 2 for i in range(100)])
    plan = ranking.cumulative_counts(df, "s", "y")._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchange is the one over bucket totals
    before = plan.split("SinglePartition")
    assert len(before) == 2 and "_b#" in before[1].split("\n")[1]
    assert evaluate.ece(df.withColumn("p", F.col("s") / 100), "p", "y", 5).first().ece == pytest.approx(
        np.mean([abs(np.mean([i % 2 for i in range(a, a + 20)]) - np.mean([i / 100 for i in range(a, a + 20)])) for a in range(0, 100, 20)]))

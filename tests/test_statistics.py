import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions import pvalues as pv
from plumbline.operators import association, evaluate, planning, profile


def test_tail_probabilities_against_closed_forms():
    assert pv.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert pv.chi2_sf(5.0, 2) == pytest.approx(math.exp(-2.5)) and pv.chi2_sf(40.0, 2) == pytest.approx(math.exp(-20))
    assert pv.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05) and pv.chi2_sf(7.0, 4) == pytest.approx(math.exp(-3.5) * 4.5)
    assert pv.kolmogorov_sf(1.3580986393225505) == pytest.approx(0.05, abs=1e-6) and pv.kolmogorov_sf(0.99) == pytest.approx(pv.kolmogorov_sf(1.01), abs=0.03)
    assert pv.binomial_upper(7, 8) == pytest.approx(9 / 256) and pv.binomial_upper(0, 5) == 1.0
    assert pv.student_t_two_sided(1.0, 1) == pytest.approx(0.5) and pv.student_t_two_sided(2.0, 2) == pytest.approx(1 - 2 / math.sqrt(6))


@pytest.fixture
def data(frame):
    rng = np.random.default_rng(0)
    x = rng.lognormal(size=400)
    y = (rng.random(400) < 0.3 + 0.2 * (x > 1)).astype(int)
    z = np.where(rng.random(400) < 0.2, np.nan, np.round(x * 3) + rng.integers(0, 3, 400))
    pdf = pd.DataFrame({"x": x, "z": z, "w": rng.integers(0, 5, 400).astype(float), "g": rng.choice(list("abc"), 400), "y": y})
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else (v.item() if hasattr(v, "item") else v) for v in r) for r in pdf.itertuples(index=False)]
    return frame(rows, "x double, z double, w double, g string, y int"), pdf


def test_describe_matches_pandas(data):
    df, pdf = data
    for r in profile.describe(df, ["x", "z"]).collect():
        s = pdf[r["column"]].dropna()
        want = [len(s), s.mean(), s.median(), s.mode().iloc[0], s.quantile(0.25), s.quantile(0.75), s.var(), s.std() / s.mean(), s.skew(), s.kurt()]
        assert [r.n, r.mean, r.median, r["mode"], r.q1, r.q3, r.variance, r.cv, r.skew, r.kurtosis] == pytest.approx(want)


def test_spearman_is_pairwise_complete(data):
    df, pdf = data
    got = {(r.a, r.b): r.rho for r in association.spearman(df, ["x", "w", "z"]).collect()}
    want = {}
    for (a, b) in got:
        both = pdf[[a, b]].dropna().rank()
        want[(a, b)] = both[a].corr(both[b])
    assert len(got) == 3 and got == pytest.approx(want)


def test_spearman_over_many_gaps_ties_and_repeated_rows(frame):
    rng = np.random.default_rng(5)
    base = np.round(rng.normal(size=(300, 1)) + rng.normal(size=(300, 5)), 1)
    base[rng.random(base.shape) < 0.25] = np.nan
    base[:, 4] = np.round(rng.normal(size=300))
    base[100:200] = base[100]  # a third of all rows are one row
    base[0, 0], base[1, 0], base[2, 1] = 0.0, -0.0, np.nan
    names = list("abcde")
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in base] + [(None,) * 5, (None, 1.5, None, None, None), (1.5, None, None, None, None)]
    pdf = pd.DataFrame(rows, columns=names, dtype=float)
    got = {(r.a, r.b): (r.rho, r.n) for r in association.spearman(frame(rows, ", ".join(f"{c} double" for c in names)), names).collect()}
    assert len(got) == 10
    for (a, b), (rho, n) in got.items():
        both = pdf[[a, b]].dropna()
        assert n == len(both) and rho == pytest.approx(both[a].rank().corr(both[b].rank()), abs=1e-12)


def test_spearman_of_constants_absent_columns_and_no_rows(frame, spark):
    df = frame([(1.0, float(i), None) for i in range(5)], "k double, v double, z double")
    assert {(r.a, r.b): (r.rho, r.n) for r in association.spearman(df, ["k", "v", "z"]).collect()} == {("k", "v"): (None, 5)}
    assert association.spearman(df.limit(0), ["k", "v", "z"]).collect() == []


def test_mann_whitney_and_chi_square(data):
    df, pdf = data
    r = association.mann_whitney(df, ["w"], "y").first()
    a, b = pdf.w[pdf.y == 1].to_numpy(), pdf.w[pdf.y == 0].to_numpy()
    u = (a[:, None] > b[None]).sum() + 0.5 * (a[:, None] == b[None]).sum()
    ties = (pdf.w.value_counts() ** 3 - pdf.w.value_counts()).sum()
    sd = math.sqrt(len(a) * len(b) / 12 * (401 - ties / (400 * 399)))
    assert r.u == u and r.z == pytest.approx((abs(u - len(a) * len(b) / 2) - 0.5) / sd) and r.p_value == pytest.approx(math.erfc(r.z / math.sqrt(2)))
    two = df.withColumn("h", F.when(F.col("g") == "a", "a").otherwise("b"))
    got = {c.column: c for c in association.chi_square(two, ["g", "h"], "y").collect()}
    t = pd.crosstab(np.where(pdf.g == "a", "a", "b"), pdf.y).to_numpy().astype(float)
    e = t.sum(1, keepdims=True) * t.sum(0) / t.sum()
    gap = np.abs(t - e)
    assert got["h"].chi2 == pytest.approx((np.maximum(gap - 0.5, 0) ** 2 / e).sum()) and got["h"].dof == 1
    t = pd.crosstab(pdf.g, pdf.y).to_numpy().astype(float)
    e = t.sum(1, keepdims=True) * t.sum(0) / t.sum()
    assert got["g"].chi2 == pytest.approx(((t - e) ** 2 / e).sum()) and got["g"].cramers_v == pytest.approx(math.sqrt(got["g"].chi2 / 400))
    assert got["g"].p_value == pytest.approx(math.exp(-got["g"].chi2 / 2))


def test_wilson_bounds_and_bands(frame):
    r = profile.group_rate(frame([("a", int(i < 10)) for i in range(100)], "g string, y int"), ["g"], "y").first()
    assert (r.n, r.cases, r.rate) == (100, 10, 0.1) and (r.lo, r.hi) == pytest.approx((0.0552, 0.1744), abs=1e-3)
    df = frame([(float(v),) for v in [0, 1, 1, 1, 2, 3, 4, 5, 9, None] if v is not None] + [(None,)], "v double")
    want = pd.qcut(pd.Series([0, 1, 1, 1, 2, 3, 4, 5, 9.0]), 4, labels=False, duplicates="drop").value_counts().to_dict()
    assert {r.b: r["count"] for r in profile.qcut(df, "v", 4, name="b").where("b is not null").groupBy("b").count().collect()} == want


@pytest.mark.parametrize("diffs,real", [([0.041, 0.052, 0.047], True), ([0.06, -0.05, 0.01, 0.004, -0.02], False), ([-0.01, -0.02, -0.015], False)])
def test_fold_verdict(frame, diffs, real):
    assert evaluate.fold_verdict(frame([(d,) for d in diffs], "d double"), "d").first().real is real


def test_missing_effect_trend_and_slope(frame):
    rows = [(None if i % 4 == 0 else 1.0, int(i % 4 == 0 and i % 8 == 0 or i % 10 == 0), f"2025-{i % 6 + 1:02d}", i % 6) for i in range(600)]
    df = frame(rows, "v double, y int, m string, t int")
    r = association.missing_effect(df, ["v"], "y").first()
    a = [y for v, y, *_ in rows if v is None]
    assert r.n_absent == 150 and r.rate_absent == pytest.approx(np.mean(a)) and r.rate_present < r.rate_absent and r.p_value < 0.01
    tr = association.vintage_trend(df.where("m < '2025-06'").unionByName(df.where("m = '2025-06'").limit(10)), "m", "y", 90).orderBy("m").collect()
    assert [x.mature for x in tr] == [True] * 5 + [False] and [x.position for x in tr] == list(range(6))
    grown = frame([(t, int(i < 10 + 10 * t)) for t in range(5) for i in range(100)], "t int, y int")
    p = np.array([0.1, 0.2, 0.3, 0.4, 0.5])
    b = np.zeros(2)
    X = np.c_[np.ones(5), np.arange(5)]
    for _ in range(30):
        q = 1 / (1 + np.exp(-X @ b))
        b += np.linalg.solve((X * (100 * q * (1 - q))[:, None]).T @ X, X.T @ (100 * (p - q)))
    assert association.month_slope(grown, "t", "y").first().slope == pytest.approx(b[1])


def test_shapes_and_plan(frame):
    rng = np.random.default_rng(0)
    rows = [(float(a), float(b), 0.0 if i else 3.0, bool(i % 2), "k", int(i % 2)) for i, (a, b) in enumerate(zip(rng.normal(size=500), np.exp(2.5 * rng.normal(size=500))))]
    df = frame(rows, "n double, l double, q double, f boolean, c string, y int")
    shapes = {r.column: r["shape"] for r in profile.shape_class(df, ["n", "l", "q"]).collect()}
    assert shapes == {"n": "symmetric", "l": "right-skewed, log fixes", "q": "quasi-constant"}
    plan = {r.column: r.action for r in planning.transform_plan(df, ["n", "l", "q"], {"y": "target"}).collect()}
    assert plan == {"n": "scale only", "l": plan["l"], "q": "binarise: above zero", "f": "keep: already binary", "c": "encode: one-hot", "y": "target"}
    assert plan["l"] in ("log1p", "winsorise p99, then log1p")
    assert profile.normality(df, ["n"]).first().p_value > 0.01 > profile.normality(df, ["l"]).first().p_value

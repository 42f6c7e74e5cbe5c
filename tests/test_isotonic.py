import random

import numpy as np
import pytest

from plumbline.operators import isotonic, models


def sequential(rows):
    """Pool adjacent violators over distinct scores, one after the other: (lo, hi, mean)."""
    points = {}
    for s, y in rows:
        if s is not None and s == s and y is not None:
            t, w = points.get(s + 0.0, (0.0, 0.0))
            points[s + 0.0] = (t + y, w + 1)
    out = []
    for s in sorted(points):
        out.append([s, s, *points[s]])
        while len(out) > 1 and out[-2][2] / out[-2][3] >= out[-1][2] / out[-1][3] - 1e-15:
            lo, hi, t, w = out.pop()
            out[-1] = [out[-1][0], hi, out[-1][2] + t, out[-1][3] + w]
    return [(lo, hi, t / w) for lo, hi, t, w in out]


def tables():
    rng = random.Random(3)
    yield [(float(rng.randrange(40)), int(rng.random() < 0.4)) for _ in range(400)]  # ties everywhere
    yield [(float(i), int(rng.random() < i / 300)) for i in range(300)]
    yield [(float(-i), float(i)) for i in range(200)]  # falls: one pool over all ranges
    yield [(float(i), float(i * i)) for i in range(200)]  # rises: nothing to pool
    yield [(1.0, 0), (1.0, 1), (None, 1), (float("nan"), 1), (2.0, None), (-0.0, 1), (0.0, 0)]
    yield []


@pytest.mark.parametrize("size", [7, 100_000])
def test_pools_are_those_of_the_sequential_fit(frame, monkeypatch, size):
    monkeypatch.setattr(isotonic, "RANGE_ROWS", size)
    parts = list(tables())
    df = frame([(g, s, None if y is None else float(y)) for g, rows in enumerate(parts) for s, y in rows], "g int, s double, y double", 5)
    pools = isotonic.fit(df, "s", "y", ["g"])
    got = {}
    for r in sorted(pools.collect(), key=lambda r: (r.g, r.lo)):
        got.setdefault(r.g, []).append(r)
    for g, rows in enumerate(parts):
        want = sequential(rows)
        assert [(r.lo, r.hi) for r in got.get(g, [])] == [w[:2] for w in want]
        assert [r.mean for r in got.get(g, [])] == pytest.approx([w[2] for w in want])
        assert [r.next_lo for r in got.get(g, [])] == [w[0] for w in want[1:]] + [None] * bool(want)


def test_reading_between_and_beyond_pools(frame):
    rows = list(tables())[1]
    want = sequential(rows)
    xs, ys = [v for lo, hi, _ in want for v in (lo, hi)], [m for *_, m in want for _ in (0, 1)]
    asked = [-5.0, 0.0, 0.5, 12.25, 77.7, 150.0, 299.0, 400.0, 12.25, None, float("nan")]
    pools = isotonic.fit(frame([(s, float(y)) for s, y in rows], "s double, y double"), "s", "y")
    got = {r.s: r.calibrated for r in isotonic.read_at(frame([(v,) for v in asked], "s double"), "s", pools).collect()}
    known = sorted({v for v in asked if v is not None and v == v})
    assert sorted(got) == known
    assert [got[v] for v in known] == pytest.approx(np.interp(known, xs, ys).tolist())


def test_calibrated_scores_are_the_mean_of_the_folds(frame):
    rng = random.Random(1)
    rows = [(i, float(rng.randrange(30)), 0) for i in range(600)]
    rows = [(i, s, int(rng.random() < s / 40)) for i, s, _ in rows] + [(900, None, 1)]
    df = frame(rows, "k long, score double, y int")
    z = models.calibrate(df, "score", "y", ["k"], 3)(df)
    got = {r.k: r.calibrated for r in z.collect()}
    assert len(got) == len(rows) and got[900] is None
    from pyspark.sql import functions as F

    own = {r.k: r.f for r in df.select("k", F.pmod(F.xxhash64("k", F.lit(0)), F.lit(3)).alias("f")).collect()}
    fits = [sequential([(s, y) for k, s, y in rows if own[k] != f]) for f in range(3)]
    for k, s, _ in rows[:50]:
        want = [np.interp(s, [v for lo, hi, _ in fit for v in (lo, hi)], [m for *_, m in fit for _ in (0, 1)]) for fit in fits]
        assert got[k] == pytest.approx(float(np.mean(want)))
    with pytest.raises(ValueError, match="method"):
        models.calibrate(df, "score", "y", ["k"], 3, "other")

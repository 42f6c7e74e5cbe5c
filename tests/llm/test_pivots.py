import hashlib
import math
import random

import numpy as np
import pytest

from plumbline.llm import pivots


def brute(rows, k=40, rounds=5, dim=64):
    kept = [(i, [math.floor(256 * np.float64(x)) for x in v]) for i, v in rows if i is not None and v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        who = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, who) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    who = assign()
    inertia = {n: sum(d for d, c in who if c == n) for n in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, who))


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], "vec_id long, embedding array<double>, cluster int, to_pivots string").repartition(3)
    return sorted(tuple(r) for r in pivots.clustered(df, **more).collect())


def test_equal_to_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(150)]
    rows += [(i, [0.5] * 64) for i in range(200, 230)]  # ties and equal centroids
    rows += [(3, rows[3][1]), (7, [1.0] * 64), (300, None), (301, [1.0] * 63), (302, [float("nan")] + [0.0] * 63), (303, [float("-inf")] + [0.0] * 63), (304, [None] + [0.0] * 63), (None, [0.0] * 64), (305, [])]
    assert run(spark, rows) == brute(rows)


def test_few_vectors_none_and_too_large(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (9, [-3.7, 2.2])]
    assert run(spark, rows, dim=2) == brute(rows, dim=2)
    assert run(spark, [], dim=2) == [] and run(spark, [(1, None)], dim=2) == []
    large = [(1, [5e5, 1.0]), (2, [-5e5, 1.0]), (3, [5e5, 1.1])]  # beyond what products in a double hold
    assert run(spark, large, dim=2, k=2) == brute(large, k=2, dim=2)
    with pytest.raises(Exception, match="no exact distance"):
        run(spark, [(1, [1e9, 0.0])], dim=2)


@pytest.mark.parametrize("scale", [3, 1000, 5_000_000])
def test_bounds_hide_no_centroid_and_spare_distances(scale):
    rng = np.random.default_rng(0)
    homes = rng.integers(-scale, scale + 1, (30, 6))
    v = homes[rng.integers(0, 30, 500)] + rng.integers(-1, 2, (500, 6))
    table = pivots.spread(homes, 6)
    far = np.sqrt(((v[:, None] - table[None]) ** 2).sum(2).astype(float))
    who, best, told = pivots.nearest(v, far, homes, table)
    exact = ((v[:, None] - homes[None]) ** 2).sum(2)
    assert (who == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert told < len(v) * len(homes) * (0.3 if scale > 3 else 1.01)

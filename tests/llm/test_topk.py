import math
import random

import numpy as np
import pytest

from plumbline.llm import topk


def brute(rows, k):
    good = [(i, [math.floor(256 * np.float64(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -m) for r, (m, i) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [8, 1024])
def test_equal_to_brute_force(spark, monkeypatch, block):
    rng = random.Random(4)
    rows = [(i, [np.float32(rng.gauss(0, 0.2)).item() for _ in range(6)]) for i in range(400)]
    rows += [(i, [0.5] * 6) for i in range(400, 440)]  # ties
    rows += [(50, [0.25] * 6), (77, rows[77][1]), (500, None), (550, [1.0, None]), (600, [float("nan")] * 6), (601, [float("inf")] * 6), (None, [1.0] * 6), (700, [1.0, 2.0]), (701, [3.0, -1.0]), (750, [])]
    monkeypatch.setattr(topk, "BLOCK", block)
    df = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], "vec_id long, embedding array<double>, r string, score int").repartition(4)
    got = sorted(tuple(r) for r in topk.top_k(df, lambda i: i % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, 5)


def test_pruning_skips_blocks_and_keeps_results():
    rng = np.random.default_rng(0)
    v = np.concatenate([np.abs(rng.integers(0, 5, (500, 8))) + 20 * (i == 3) for i in range(10)]).astype(float)
    ids = np.arange(len(v))
    seen = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(other.shape[1])
            return np.asarray(self) @ other

    q = np.ones((3, 8)).view(Counting)
    best, who = topk.search_range(np.array([-1, -2, -3]), q, ids, v, 5, block=500)
    want = np.lexsort((ids, -v.sum(1)))[:5]
    assert (who == want).all() and (best == v.sum(1)[want]).all()
    assert 500 in seen and sum(s == 500 for s in seen) == 1


def test_no_vectors_and_no_queries(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, lambda i: i % 50 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"), lambda i: i % 50 == 0).collect() == []
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"), lambda i: i % 50 == 0).collect() == []

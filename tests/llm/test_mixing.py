import re
from collections import Counter, defaultdict

import numpy as np

from plumbline.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """By repeated resharing, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        w = sum(weight[s] for s in free)
        level = (total - sum(fixed.values())) / w if w else 0
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_targets_and_limits(edges, edge_rows):
    got = mixing.mix(edges, block_words=8, shard_words=500).collect()
    assert len(got) == len(edge_rows)
    sizes = Counter()
    for r in edge_rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want, taken = targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.1 * want[s] + 60, s
    again = mixing.mix(edges.repartition(5), block_words=8, shard_words=500).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_no_documents_and_no_words(spark, no_docs):
    assert mixing.mix(no_docs).collect() == []
    rows = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_excess_is_reshared_until_none_is_above(spark):
    sizes = [("a", 1), ("b", 1), ("c", 1), ("d", 1000), (None, 2)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    want = targets(dict(sizes))
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want) and abs(sum(got.values()) - 1005) < 1e-6


def test_quotas_go_to_the_highest_quotients():
    wanted, blocks = np.array([10.0, 53, 24, 0]), np.array([50, 50, 4, 9])
    got = mixing.quotas(wanted, blocks, 30)
    held = [0, 0, 0, 0]
    for _ in range(30):
        best = max((s for s in range(4) if held[s] < 3 * blocks[s]), key=lambda s: (wanted[s] / (2 * held[s] + 1), -s))
        held[best] += 1
    assert got.tolist() == held


def test_documents_stand_as_often_as_they_are_taken(edges, edge_rows):
    out = mixing.mixed_documents(edges, block_words=8, shard_words=500)
    assert out.columns == edges.columns
    rows = out.collect()
    assert {(r.doc_id, r.text) for r in rows} <= {r[:2] for r in edge_rows}
    n, times = Counter((r.doc_id, r.text) for r in rows), defaultdict(int)
    for r in mixing.mix(edges, block_words=8, shard_words=500).collect():
        times[r.doc_id, r.size] += round(r.taken / r.size) if r.size else 1
    for (i, t), k in n.items():
        assert k <= 3 * sum(r[:2] == (i, t) for r in edge_rows)
    assert abs(sum(n.values()) - sum(times.values())) <= 2


def test_small_sources_meet_their_targets_over_many_shards(spark):
    rows = [(i, " ".join(["w"] * 200), "abcd"[i % 4] + "-large") for i in range(400)]
    # one short text to a shard, and sources smaller than a block
    rows += [(1000 + i, " ".join(["s"] * 10), "small") for i in range(60)] + [(2000, "t " * 10, "tiny"), (2001, "u " * 20, "ultra"), (2002, "v " * 40, "very")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_words=2000).collect()
    target, taken = {r.source: r.target for r in got}, Counter()
    for r in got:
        taken[r.source] += r.taken
    assert len({r.shard for r in got}) > 20
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in ("small", "tiny", "ultra", "very")), (taken, target)
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in target)

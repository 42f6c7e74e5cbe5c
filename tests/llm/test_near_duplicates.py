import random
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import chosenpath, common


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    s = [sets(t) if i is not None else set() for i, t in rows]
    linked = [[j for j in range(len(rows)) if j != i and s[i] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]) - 1e-9] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], min((rows[j][0] for j in seen if rows[j][0] is not None), default=None), len(linked[i])))
    return sorted(out, key=repr)


def near_copies(n, rng, words=60):
    base = ["w%d" % rng.randint(0, 9999) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        w[rng.randrange(words)] = "v%d" % rng.randint(0, 99999)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_classes_and_links_equal_brute_force(spark, edges, edge_rows, block):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in edge_rows]
    texts = near_copies(30, rng) + ["shared line of many documents " * 3 + " ".join("u%d" % rng.randint(0, 10**6) for _ in range(40)) for _ in range(30)]
    texts += [texts[0]] * 12 + [texts[1].replace(" ", "\n")]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in chosenpath.similar(docs, block=block).collect()), key=repr)
    want = brute(rows)
    assert [g for g in got if g[0] is not None] == [w for w in want if w[0] is not None]
    assert len(got) == len(rows)


def test_no_documents(no_docs):
    assert chosenpath.similar(no_docs).collect() == []
    assert chosenpath.deduplicated(no_docs).collect() == []


def test_one_document_of_each_class_stays(edges, edge_rows):
    out = chosenpath.deduplicated(edges)
    assert out.columns == edges.columns
    ids = sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id is not None)
    first = {}
    for i, c, _ in brute([(r[0], r[1]) for r in edge_rows]):
        first[i] = c
    assert (0, edge_rows[0][1]) in ids and not {1, 2, 14} & {i for i, _ in ids}
    assert [i for i, _ in ids].count(6) == 2 and (7, "one two three") in ids and 8 not in {i for i, _ in ids}
    assert sum(r.doc_id is None for r in out.collect()) == 1 and {3, 4, 5} <= {i for i, _ in ids}


def test_runs_reach_the_recall():
    f = 0.0
    for _ in range(50):
        f = (1 - 0.8 * (1 - f)) ** 2
    assert 1 - f ** chosenpath.runs_for(0.9995, 0.8) >= 0.9995


def test_forest_connects_what_is_linked():
    m = np.zeros((6, 6), bool)
    for a, b in [(0, 3), (3, 5), (0, 5), (1, 2)]:
        m[a, b] = m[b, a] = True
    edges = chosenpath._forest(m)
    assert len(edges) == 3 and {frozenset(e) for e in edges} <= {frozenset(e) for e in [(0, 3), (3, 5), (0, 5), (1, 2)]}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and len(got) == 71


def test_row_numbers_are_dense(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(c,) for c in "zebra"] + [(None,)], "source string")
    got = common.numbered(df, [F.col("source").asc_nulls_last()], "place").orderBy("place").collect()
    assert [(r.source, r.place) for r in got] == [("a", 1), ("b", 2), ("e", 3), ("r", 4), ("z", 5), (None, 6)]


def test_shingles_of_short_and_empty_texts():
    h, n = common.shingles(["", "a b", "a b c d e f", "A  B", " "])
    assert n.tolist() == [0, 1, 2, 1, 0] and h[0] == h[3]
    assert defaultdict(int, zip(h.tolist(), h.tolist()))[int(h[0])]


def test_joins_connect_what_blocks_leave_apart():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = 14
        m = np.triu(rng.random((n, n)) < 0.12, 1)
        m |= m.T
        own = rng.integers(0, 2, n)
        inside = m & (own[:, None] == own[None, :])
        edges = chosenpath._forest(inside) + chosenpath._joins(m, own)
        assert all(m[a, b] for a, b in edges) and len(edges) == len(chosenpath._forest(m))
        again = np.zeros_like(m)
        for a, b in edges:
            again[a, b] = again[b, a] = True
        assert len(chosenpath._forest(again)) == len(edges)

import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import fingerprint as fp


def test_edits_and_next_documents(edges, edge_rows):
    unique = {}
    for r in edge_rows:
        if r[0] is not None and r[0] != 6 or r[1] == "one":
            unique[r[0]] = r[1] or ""
    docs = edges.where("doc_id IS NOT NULL AND NOT (doc_id = 6 AND text <> 'one')").dropDuplicates(["doc_id"])
    for got in (fp.edited_fingerprints(docs).collect(), fp.edited_fingerprints(docs.repartition(7)).collect()):
        order = sorted(unique, reverse=True)
        assert sorted(r.doc_id for r in got) == sorted(unique)
        prints = {}
        for r in got:
            t, n = unique[r.doc_id], unique[order[(order.index(r.doc_id) + 1) % len(order)]]
            half = len(t) // 2
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()
            assert prints.setdefault(t, r.fingerprint) == r.fingerprint and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_ranges_follow_each_other(spark):
    docs = spark.createDataFrame([(i, "t%d" % i) for i in range(500)], "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.next_text for r in fp.with_next(docs, ["text"], range_chars=100).collect()}
    assert got == {i: "t%d" % ((i - 1) % 500) for i in range(500)}


def test_whole_table_with_odd_rows(edges, edge_rows, no_docs):
    assert fp.edited_fingerprints(edges).count() == len(edge_rows)
    assert fp.edited_fingerprints(no_docs).collect() == []


@pytest.mark.parametrize("shared,total", [(30, 60), (180, 200), (400, 500)])
def test_likeness_is_near_the_jaccard_similarity(spark, shared, total):
    """Mean over 40 pairs whose shingle sets share a known part."""
    rows = []
    for k in range(40):
        a = [f"a{k}x{i}" for i in range(total)]
        b = a[:shared] + [f"b{k}x{i}" for i in range(total - shared)]
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("x")).agg(F.avg("x")).first()[0]
    n, s = total - 4, shared - 4
    assert abs(got - s / (2 * n - s)) < 0.04


def test_texts_without_words_are_like_each_other_alone(spark):
    df = spark.createDataFrame([("", " "), ("", "a b"), ("a", "a")], "a string, b string")
    got = [r[0] for r in df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b")))).collect()]
    assert got == [1.0, 0.0, 1.0]


def test_bins_by_brute_force_and_named_once(spark):
    texts = ["", "one", "a b c d e f g", " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(2000))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    order = {(r.a, r.b): r.o for r in spark.range(128).select(F.col("id").alias("a")).crossJoin(spark.range(128).select(F.col("id").alias("b"))).select("a", "b", F.xxhash64("a", "b").alias("o")).collect()}
    for r in df.select(fp.shingle_hashes(F.col("text")).alias("hashes"), fp.fingerprint(F.col("text")).alias("got")).collect():
        least = {}
        for h in r.hashes:
            least.setdefault((h & (1 << 64) - 1) >> 57, h)
        codes = [least[b if b in least else min(least, key=lambda f: order[b, f])] & 255 for b in range(128)] if least else []
        assert r.got == "".join(f"{c:02x}" for c in codes)
    # twice to find the least of each bin, once for the bins that are full: not again for each bin that looks for its own
    assert df.select(fp.fingerprint(F.col("text")).alias("x"))._jdf.queryExecution().analyzed().toString().lower().count("shiftrightunsigned") == 3


def test_likeness_counts_equal_bins(spark):
    a = "".join(f"{i:02x}" for i in range(128))
    rows = [(a, "".join(f"{i if i % 4 else 255 - i:02x}" for i in range(128)), 96), (a, a[2:] + "ff", 0), (a, a[:-2] + "aa", 127), (a, "aa" + a[2:], 127)]
    got = spark.createDataFrame([r[:2] for r in rows], "a string, b string").select(fp.likeness(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == pytest.approx([max(0.0, (n / 128 - 1 / 256) / (1 - 1 / 256)) for _, _, n in rows])

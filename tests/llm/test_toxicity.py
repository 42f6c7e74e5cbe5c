import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import toxicity


def corpus(n, seed=1, rate=0.2):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeiournst") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        bad = rng.random() < rate
        if bad:
            for _ in range(max(2, len(w) // 40)):
                w.insert(rng.randrange(len(w)), rng.choice(["fiend", "wretch", "vermin", "grumpf" + rng.choice("abcdefgh") + rng.choice("xyz")]))
        docs.append((i, " ".join(w), "en", "s"))
        labels.append((i, 0, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(400)
    docs += [(1000, None, None, None), (1001, "", None, None), (None, "fiend wretch vermin", None, None), (1002, "calm " * 9000 + "fiend", None, None), docs[0]]
    known = [x for x in labels if x[0] % 3] + [(5000, 1, 1), (None, 0, 1), (7, 0, None)]
    return docs, dict((a, c) for a, _, c in labels), spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(3), spark.createDataFrame(known, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(tables):
    rows, truth, docs, labels = tables
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    seen = [(truth[r.doc_id], r.predicted) for r in got if r.doc_id in truth and (r.held_out or r.doc_id % 3 == 0)]
    assert sum(a == b for a, b in seen) >= 0.97 * len(seen)
    assert [r.predicted for r in got if r.doc_id is None] == [1]


def test_held_out_labels_are_never_read(spark, tables):
    _, _, docs, labels = tables
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id or -1, round(r.score, 9)) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_without_labels_of_both_classes(spark, tables):
    _, _, docs, labels = tables
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_clean_documents_stay(spark, tables):
    rows, truth, docs, labels = tables
    out = toxicity.clean_documents(docs, labels)
    assert out.columns == docs.columns
    ids = {r.doc_id for r in out.collect()}
    clean = {i for i, y in truth.items() if not y}
    assert len(clean & ids) >= 0.98 * len(clean) and len({i for i, y in truth.items() if y} & ids) <= 2 and {1000, 1001} <= ids


def plain_model(rows, everything):
    """P(word | class) and P(word | before, class), from dictionaries."""
    from collections import Counter

    def split(t):
        for c in toxicity.SEPARATORS[len("[\\x20\\x09-\\x0D"):-2].replace("\\", ""):
            t = t.replace(c, " ")
        return t.lower().split()

    def taken(n):
        return toxicity.DISCOUNTS[min(n, 3) - 1] if n else 0.0

    shared = Counter(w for t in everything for w in split(t or ""))
    total = sum(shared.values())
    models = []
    for y in (1, 0):
        pairs = Counter(p for t, label in rows if label == y for ws in [split(t)] for p in zip(["", *ws], ws))
        after, freed = Counter(), Counter()
        for (h, _), n in pairs.items():
            after[h] += n
            freed[h] += taken(n)
        cont = Counter(w for _, w in pairs)
        mass, left = sum(cont.values()), sum(map(taken, cont.values()))

        def one(w, cont=cont, mass=mass, left=left):
            return (cont[w] - taken(cont[w]) + left * shared[w] / total) / mass

        def two(h, w, pairs=pairs, after=after, freed=freed, one=one):
            n = pairs[h, w]
            return (n - taken(n) + freed[h] * one(w)) / after[h] if after[h] else one(w)

        models.append((one, two))
    return shared, models


@pytest.fixture(scope="module")
def phrases(spark):
    rng = random.Random(4)
    vocab = ["w%d" % i for i in range(60)]
    rows = [(" ".join([*(a := [rng.choice(vocab) for _ in range(30)])[:20], *(["Rotten,", "old", "grumbler!"] if i % 5 == 0 else ["an", "old", "house"]), *a[20:]]), int(i % 5 == 0), False) for i in range(120)]
    docs = spark.createDataFrame([(t,) for t, *_ in rows] + [("w1 unlabelled words (only) here", ), (None,), ("",)], "text string")
    pairs = toxicity.counted_pairs(spark.createDataFrame(rows, "text string, toxic int, inside boolean").repartition(3))
    return rows, [r.text for r in docs.collect()], toxicity.class_models(pairs, docs)


def test_class_probabilities_are_kneser_ney_and_sum_to_one(phrases):
    rows, texts, model = phrases
    shared, plain = plain_model([r[:2] for r in rows], texts)
    words = sorted(shared)
    hashed = toxicity.word_hashes(words)
    told = [w for w, known in zip(words, model.words.rows(hashed) < len(model.words.keys)) if known]
    for h in ["", "old", "rotten", "w1", "only", "never"]:
        before = np.full(len(words), toxicity.START if not h else toxicity.word_hashes([h])[0], np.uint64)
        one, two = model.probabilities(before, hashed)
        for k in (0, 1):
            assert abs(sum(plain[k][0](w) for w in words) - 1) < 1e-9 and abs(sum(plain[k][1](h, w) for w in words) - 1) < 1e-9
            for i, w in enumerate(words):
                if w in told:
                    assert one[i, k] == pytest.approx(plain[k][0](w)) and two[i, k] == pytest.approx(plain[k][1](h, w))
        for i, w in enumerate(words):  # a word without a row may have any shared count: the classes' ratio stays
            assert two[i, 0] / two[i, 1] == pytest.approx(plain[0][1](h, w) / plain[1][1](h, w))


def test_a_fixed_phrase_tells_the_classes_apart(phrases):
    _, _, model = phrases
    rotten, old, grumbler, an, house = toxicity.word_hashes(["rotten", "old", "grumbler", "an", "house"])
    _, two = model.probabilities(np.array([rotten, an], np.uint64), np.array([old, old], np.uint64))
    assert two[0, 0] > 5 * two[0, 1] and two[1, 1] > 5 * two[1, 0]


def test_smaller_model_backs_off_to_the_same_counts(spark, phrases):
    rows, texts, model = phrases
    marked = [(t, y, i % 3 == 0) for i, (t, y, _) in enumerate(rows)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    pairs = toxicity.counted_pairs(spark.createDataFrame(marked, "text string, toxic int, inside boolean"))
    final = toxicity.class_models(pairs, docs)
    alone = toxicity.class_models(toxicity.counted_pairs(spark.createDataFrame([m for m in marked if not m[2]], "text string, toxic int, inside boolean")), docs)
    for got, want in ((final, model), (toxicity.class_models(pairs, docs, final), alone)):
        assert got[3:] == want[3:] and all((a.keys == b.keys).all() and (a.values == b.values).all() for a, b in zip(got[:3], want[:3]))


def test_features_equal_sums_over_all_windows(phrases):
    rows, _, model = phrases
    texts = [rows[0][0], None, "", "old", rows[1][0] + " " + rows[5][0], " ,. "]
    got = toxicity.features(pa.array(texts, pa.string()), model)
    for t, f in zip(texts, got):
        codes, hashes, _ = toxicity.word_codes(pa.array([t], pa.string()))
        word = hashes[codes]
        p = model.probabilities(np.r_[toxicity.START, word[:-1]][:len(word)].astype(np.uint64), word)
        want = []
        for q in p:
            r = np.log(q[:, 0] / q[:, 1]).tolist()
            want += [max(sum(r[i:i + w]) for i in range(max(1, len(r) - w + 1))) / w if r else 0.0 for w in toxicity.WINDOWS] + [sum(r) / max(1, len(r))]
        assert f == pytest.approx([*want, np.log1p(len(word))])


def test_sample_is_bounded_and_weighted(spark, tables, monkeypatch):
    _, _, docs, labels = tables
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 60)
    rows, share = toxicity.sampled(docs, labels)
    got = rows.groupBy("toxic").agg({"weight": "sum", "*": "count"}).collect()
    assert 0.1 < share < 0.3 and all(r["count(1)"] <= 90 for r in got) and max(r["sum(weight)"] for r in got) > 100
    monkeypatch.setattr(toxicity, "LABELLED_CHARS", 2000)
    assert toxicity.sampled(docs, labels)[0].count() < 30


def test_odd_rows(spark, edges, edge_rows, no_docs):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(0, 12)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(edges, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    nothing = spark.createDataFrame([(i, None) for i in range(9)], "doc_id long, text string")
    assert len({r.score for r in toxicity.toxicity(nothing, labels).collect()}) == 1
    assert toxicity.clean_documents(no_docs, labels).collect() == [] and toxicity.clean_documents(edges, labels).columns == edges.columns

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]], len(words)


def brute(docs, target):
    parts = [(i, *plain_features(t)) for i, t in docs]
    s, t = Counter(b for _, f, _ in parts for b in f), Counter(b for x in target for b in plain_features(x)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, f, words in parts:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        rows.append((i, len(f), weight, score, words))
    drawn = sorted((r for r in rows if r[4] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0], -r[2], -r[1]))[:25 * sum(r[4] >= 20 for r in rows) // 100]
    ranks = {id(r): n for n, r in enumerate(drawn, 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=repr)


@pytest.mark.parametrize("size", [60, 8_000_000])
def test_features_of_odd_texts(monkeypatch, size):
    monkeypatch.setattr(importance, "BATCH_BYTES", size)
    rng = random.Random(0)
    texts = [None, "", "  ", "a", " A b", "É é İ z9", "x" * 5000] + ["".join(rng.choice(" abAÉ中\n.x9-") for _ in range(rng.randrange(40))) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    got = []
    for _, part in importance._parts(batch, 0):
        bucket, n, words = importance.features(part, 10_000)
        got += [(b.tolist(), int(w)) for b, w in zip(np.split(bucket, np.cumsum(n)[:-1]), words)]
    assert got == [plain_features(t) for t in texts]


def test_crc_of_joined_strings():
    rng = random.Random(1)
    left, right = ([rng.randbytes(rng.randrange(k)) for _ in range(300)] for k in (9, 70))
    got = importance.crc_joined(*(np.array([zlib.crc32(x) for x in side], np.uint32) for side in (left, right)), np.array([len(x) for x in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def test_equal_to_brute_force(spark, edges, edge_rows, no_docs):
    rng = random.Random(2)
    words = "the of and model data river stone kind light".split()
    more = [(100 + i, " ".join(rng.choice(words[:3 + i % 7]) for _ in range(rng.randrange(60)))) for i in range(120)]
    docs = spark.createDataFrame([(*x, None, None, None) for x in more], "doc_id long, text string, n_features int, rank int, bucket long").repartition(5)
    target = spark.createDataFrame([("model data light",), (None,), ("river stone " * 9,)], "text string")
    asked = [r["text"] for r in target.collect()]
    assert sorted((tuple(r) for r in importance.resampled(docs, target).collect()), key=repr) == brute(more, asked)
    assert sorted((tuple(r) for r in importance.resampled(edges, target).collect()), key=repr) == brute([r[:2] for r in edge_rows], asked)
    assert importance.resampled(no_docs, target).collect() == []
    assert sorted((tuple(r) for r in importance.resampled(docs, no_docs).collect()), key=repr) == brute(more, [])

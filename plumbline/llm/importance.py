"""Target-distribution importance resampling over hashed word features, counted and weighed by Arrow kernels."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import numbered, offsets, stored

#: Bytes of text that the kernels work on at once; a longer text is worked on alone.
BATCH_BYTES = 8_000_000
#: What separates words: ASCII other than letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@lru_cache(maxsize=256)
def _zeros(n: int) -> np.ndarray:
    """Four tables of 256 values: what n zero bytes after it make of each byte of a CRC register."""
    if n == 1:
        step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
        byte = np.arange(256, dtype=np.uint32)
        return np.stack([step, byte, byte << np.uint32(8), byte << np.uint32(16)])
    out = _zeros(n // 2)
    out = _moved(out, _zeros(n // 2))
    return _moved(out, _zeros(1)) if n % 2 else out


def _moved(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def crc_joined(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row, from those of each and the length of the right one: CRCs are linear, so the left one is
    carried over as many zero bytes and added."""
    out = np.empty(len(left), np.uint32)
    order = np.argsort(n, kind="stable")
    sizes, first = np.unique(n[order], return_index=True)
    for size, a, z in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(n)]):
        rows = order[a:z]
        out[rows] = (_moved(left[rows], _zeros(size)) if size else left[rows]) ^ right[rows]
    return out


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, features of each text, words of each text). A text's features are its words, then its runs of two words.

    Texts are lower-cased and split by kernels; the lists are flattened and the words dictionary-encoded. A run of two is a word's index
    with the next one's, unless a text ends between; the distinct pairs are found by a dictionary again, and only they get a CRC.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    flat = pc.list_flatten(lists)
    real = pc.not_equal(flat, "")  # a separator at either end leaves an empty word
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    before = offsets(real.to_numpy(zero_copy_only=False))
    at = before[bounds]  # the first word of each text
    words = np.diff(at)
    coded = flat.filter(real).dictionary_encode()
    codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    if not len(codes):
        return np.empty(0, np.int64), words, words
    crc = np.fromiter(map(zlib.crc32, distinct.cast(pa.binary()).to_pylist()), np.uint32, len(distinct))
    size = pc.binary_length(distinct).to_numpy().astype(np.int64)
    spaced = crc_joined(crc, np.full(len(crc), zlib.crc32(b" "), np.uint32), np.ones(len(crc), np.int64))
    inside = np.ones(len(codes), bool)
    inside[at[1:][words > 0] - 1] = False  # a text's last word has no next one
    left = np.flatnonzero(inside)
    pairs = pa.array(codes[left] << 32 | codes[left + 1]).dictionary_encode()
    pair = pairs.dictionary.to_numpy()
    a, b = pair >> 32, pair & 0xFFFFFFFF
    crc_pairs = crc_joined(spaced[a], crc[b], size[b])
    n = words + np.maximum(words - 1, 0)
    start = offsets(n)[:-1]
    out = np.empty(int(n.sum()), np.int64)
    place = np.arange(len(codes)) - np.repeat(at[:-1], words)  # of a word in its text
    of = np.repeat(np.arange(len(words)), words)
    out[start[of] + place] = (crc % np.uint32(buckets)).astype(np.int64).take(codes)
    out[(start + words)[of[left]] + place[left]] = (crc_pairs % np.uint32(buckets)).astype(np.int64).take(pairs.indices.to_numpy())
    return out, n, words


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of stretches of a batch with about BATCH_BYTES of text."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    a = 0
    while a < len(texts):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_BYTES, "right")))
        yield a, texts.slice(a, z - a)
        a = z


def bucket_counts(df: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket. A task sums its own texts before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _parts(batch, 0):
                counts += np.bincount(features(texts, buckets)[0], minlength=buckets)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["bucket", "n"])

    part = df.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(target: DataFrame, source: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source; a table of fixed size, one value a bucket."""
    t, s = ({r["bucket"]: r["n"] for r in df.collect()} for df in (target, source))
    all_t, all_s = sum(t.values()) + buckets, sum(s.values()) + buckets
    return np.array([math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, n_words, weight): the floored mean gain of a text's features, 0 without any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _parts(batch, 1):
                bucket, n, words = features(texts, len(gain))
                total = np.zeros(len(n), np.int64)
                some = n > 0
                if some.any():
                    total[some] = np.add.reduceat(gain.take(bucket), (np.cumsum(n) - n)[some])
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(words), pa.array(total // np.maximum(n, 1))], names=["doc_id", "n_features", "n_words", "weight"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


def resampled(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (25, 100), least_words: int = 20, seed: int = 7, buckets: int = 10_000,
              id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document: the given share of the documents of least_words words or more is drawn
    without replacement by weight plus seeded Gumbel noise, and ranked; others have no rank.

    Null and empty texts have no features and weight 0. A null doc_id has no noise, so its score is null and it is never drawn, though it
    counts among the documents; rows of one doc_id share their noise and are told apart by weight, then by the number of features. Without
    target texts all gains compare with an even spread; without documents there are no rows. Other columns are not read.
    """
    num, den = share
    gain = gains(bucket_counts(target, target_text, buckets), bucket_counts(docs, text_col, buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    # written first: dealing rows in ranges looks at them twice, texts are read once
    scored = stored(weighed(docs, gain, id_col, text_col), "weighed").withColumn("score", F.col("weight") + noise)
    enters = F.col("n_words") >= least_words
    # documents that may be drawn come first, so their number is their rank
    order = [(enters & F.col("score").isNotNull()).desc(), F.col("score").desc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    placed = numbered(scored, order, "rank")
    drawn = placed.where(enters).count() * num // den
    stays = enters & F.col("score").isNotNull() & (F.col("rank") <= drawn)
    return placed.select("doc_id", "n_features", "weight", "score", F.when(stays, F.col("rank")).cast("long").alias("rank"))

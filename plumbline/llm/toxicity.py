"""Toxicity by class-conditional Kneser-Ney models of word pairs that back off to counts shared by both classes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import checked_broadcast, columns_of, free_name, mixed, offsets, stored, word_hashes

#: What Kneser-Ney takes from a count of 1, of 2 and of 3 or more. A single count keeps nothing, so its whole mass backs off.
DISCOUNTS = (1.0, 1.5, 2.0)
#: The models are fitted on a sample of the labelled rows: about so many of each class at most, and so many characters of them.
LABELLED_ROWS, LABELLED_CHARS = 20_000, 32_000_000
#: Words of the windows whose strongest one is a feature, and the score from which a document counts as toxic.
WINDOWS, THRESHOLD = (1, 2, 8, 32), 0.3
#: Regularisation of the curve, of so many calibration rows' weight.
CURVE = 3.0
#: Bytes of text that the kernels work on at once.
BATCH_BYTES = 1_000_000
#: What separates words: white space and punctuation, which lower-cased words do not hold.
SEPARATORS = r"""[\x20\x09-\x0D.,;:!?"()\[\]|*]+"""
#: The history of a text's first word.
START = np.uint64(0)


def fold(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % 4).cast("int")


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code of every word, 64-bit hash of each code, words of each text) of lower-cased texts; a null text has no words."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    flat = pc.list_flatten(lists)
    real = pc.not_equal(flat, "")
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    counts = np.diff(offsets(real.to_numpy(zero_copy_only=False))[bounds])
    coded = flat.filter(real).dictionary_encode()
    hashes = word_hashes(coded.dictionary.to_pylist())
    return coded.indices.to_numpy().astype(np.int64), np.where(hashes == START, np.uint64(1), hashes), counts


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of stretches of a batch with about BATCH_BYTES of text."""
    texts = batch.column(batch.schema.get_field_index("text"))
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    a = 0
    while a < len(texts):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH_BYTES, "right")))
        yield a, texts.slice(a, z - a)
        a = z


def _before(codes: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    """The code before each word of several texts in a row, start for a first word."""
    out = np.r_[start, codes[:-1]] if len(codes) else codes
    out[(np.cumsum(counts) - counts)[counts > 0]] = start
    return out


def counted_pairs(labelled: DataFrame) -> DataFrame:
    """(before, word, t0, t1, o0, o1): how often each pair of words stands in toxic and ordinary rows, apart for rows outside (0) and inside
    (1) the calibration fold. One pass counts for both models; a task sums its stretches before the shuffle. Words are 64-bit hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = (batch.column("toxic").to_numpy() == 0) * 2 + batch.column("inside").to_numpy(zero_copy_only=False)
            for first, texts in _parts(batch):
                codes, hashes, counts = word_codes(texts)
                known = np.r_[hashes, START]
                key = _before(codes, counts, len(hashes)) << 32 | codes
                of = np.repeat(group[first:first + len(texts)], counts)
                for g in range(4):
                    pair, n = np.unique(key[of == g], return_counts=True)
                    cols = [known[pair >> 32].view(np.int64), known[pair & 0xFFFFFFFF].view(np.int64), np.full(len(pair), g, np.int32), n]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["before", "word", "g", "n"])

    part = labelled.select("text", "toxic", "inside").mapInArrow(rows, "before long, word long, g int, n long")
    sums = [F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(c) for g, c in enumerate(("t0", "t1", "o0", "o1"))]
    return stored(part.groupBy("before", "word").agg(*sums), "pairs")


class Table(NamedTuple):
    """Sorted 64-bit keys and a row of values for each, with a last row for keys outside."""

    keys: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, columns: list[np.ndarray], outside: list[float]) -> Table:
        order = np.argsort(keys)
        return Table(keys[order], np.vstack([np.stack(columns, 1)[order], outside]))

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, that of the last row for keys outside."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, len(self.keys))


class Kneser(NamedTuple):
    """What both class models need to score, toxic before ordinary in every pair of values.

    words: what is left of a word's continuation counts after the discount, and how often it stands in all documents.
    histories: how often a word stands before another, and the share of it that the discount took.
    pairs: what is left of a pair's counts, by pair_keys.
    continuations, freed: the sum of all continuation counts and of what the discount took from them. total: words of all documents.
    Words, histories and pairs from which the discount left nothing have no rows: their probability is that of the backoff.
    """

    words: Table
    histories: Table
    pairs: Table
    continuations: tuple[float, float]
    freed: tuple[float, float]
    total: float

    def probabilities(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(word | class), P(word | before, class)) of hashed words, a column for each class. Words that no row knows count as standing
        once in all documents; the ratio of the classes does not depend on it."""
        known = self.words.values[self.words.rows(word)]
        share = known[:, 2:] / self.total
        one = (known[:, :2] + np.array(self.freed) * share) / np.array(self.continuations)
        history = self.histories.values[self.histories.rows(before)]
        own = self.pairs.values[self.pairs.rows(pair_keys(before, word))]
        return one, own / history[:, :2] + history[:, 2:] * one


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)


def _taken(c: Column) -> Column:
    """What the discount takes from a count."""
    one, two, more = DISCOUNTS
    return F.when(c == 0, 0.0).when(c == 1, one).when(c == 2, two).otherwise(more)


def _arrays(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {c: table.column(c).to_numpy() for c in table.column_names}


def class_models(pairs: DataFrame, docs: DataFrame, larger: Kneser | None = None) -> Kneser | None:
    """The models of all counted pairs; with a larger model, those of the pairs outside the calibration fold, which hold no word that the larger
    one does not hold and back off to its shared counts. None where a class has no words. The tables' size is bounded by the sample of
    labelled rows; the counts they back off to are of all rows of docs."""
    t, o = (F.col("t0"), F.col("o0")) if larger else (F.col("t0") + F.col("t1"), F.col("o0") + F.col("o1"))
    counts = pairs.select("before", "word", t.alias("t"), o.alias("o")).where("t > 0 OR o > 0")
    classes = ("t", "o")
    left = [(F.col(c) - _taken(F.col(c))).alias(c) for c in classes]
    by_word = stored(counts.groupBy("word").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in classes], F.max(F.greatest("t", "o")).alias("most")), "continuations")
    sums = by_word.agg(*[F.sum(c).cast("double").alias(c) for c in classes], *[F.sum(_taken(F.col(c))).alias(f"d{c}") for c in classes]).first()
    if not sums["t"] or not sums["o"]:
        return None
    held = _arrays(by_word.where("t > 1 OR o > 1 OR most > 1").select("word", *left))
    words = Table.of(held["word"].view(np.uint64), [held["t"], held["o"], np.ones(len(held["t"]))], [0.0, 0.0, 1.0])
    total = larger.total if larger else shared_counts(docs, words)
    if larger:
        words.values[:, 2] = larger.words.values[np.r_[larger.words.rows(words.keys), len(larger.words.keys)], 2]
    by_history = counts.groupBy("before").agg(*[F.sum(c).alias(c) for c in classes], *[F.sum(_taken(F.col(c))).alias(f"d{c}") for c in classes])
    held = _arrays(by_history.where("dt < t OR do < o"))
    n = [np.maximum(held[c], 1).astype(float) for c in classes]
    histories = Table.of(held["before"].view(np.uint64), [*n, *[np.where(held[c] > 0, held[f"d{c}"] / m, 1.0) for c, m in zip(classes, n)]], [1.0] * 4)
    held = _arrays(counts.where("t > 1 OR o > 1").select("before", "word", *left))
    own = Table.of(pair_keys(held["before"].view(np.uint64), held["word"].view(np.uint64)), [held["t"], held["o"]], [0.0, 0.0])
    return Kneser(words, histories, own, (sums["t"], sums["o"]), (sums["dt"], sums["do"]), total)


def shared_counts(docs: DataFrame, words: Table) -> float:
    """Fills in how often each word of the table stands in all documents, the backoff of both classes, and gives how many words these have.
    A word that stands in none, as the documents are others, counts once."""
    shipped = docs.sparkSession.sparkContext.broadcast(words.keys)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shipped.value, np.empty(0))
        counts = np.zeros(len(table.keys) + 1, np.int64)
        for batch in batches:
            for _, texts in _parts(batch):
                codes, hashes, _ = word_codes(texts)
                np.add.at(counts, table.rows(hashes), np.bincount(codes, minlength=len(hashes)))
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], ["at", "n"])

    found = _arrays(docs.select("text").mapInArrow(rows, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")))
    inside = found["at"] < len(words.keys)
    words.values[found["at"][inside], 2] = found["n"][inside]
    return float(max(found["n"].sum(), 1))


def strongest(ratios: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """The largest sum of a window of so many words, over its width, for each of several texts in a row; a shorter text is one window."""
    sums = np.r_[0.0, np.cumsum(ratios)]
    ends = np.cumsum(counts)
    starts = ends - counts
    out = (sums[ends] - sums[starts]) / width
    long = counts > width
    if long.any():
        n = counts[long] - width + 1
        at = np.repeat(starts[long] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out[long] = np.maximum.reduceat(sums[at + width] - sums[at], np.cumsum(n) - n) / width
    return out


FEATURES = [f"{order}_{w}" for order in ("word", "pair") for w in (*WINDOWS, "all")] + ["length"]


def features(texts: pa.Array, model: Kneser) -> np.ndarray:
    """A row for each text: length-normalised log-likelihood ratios of the classes, of words alone and of words after the word before them, in
    the strongest windows and in the whole text, and the logarithm of its length. A text without words has zeros."""
    codes, hashes, counts = word_codes(texts)
    before, word = np.r_[hashes, START][_before(codes, counts, len(hashes))], hashes[codes]
    one, two = model.probabilities(before, word)
    out = []
    for p in (one, two):
        ratio = np.log(p[:, 0]) - np.log(p[:, 1])
        out += [strongest(ratio, counts, w) for w in WINDOWS]
        ends = np.cumsum(counts)
        sums = np.r_[0.0, np.cumsum(ratio)]
        out.append((sums[ends] - sums[ends - counts]) / np.maximum(counts, 1))
    return np.stack([*out, np.log1p(counts)], 1)


def featured(docs: DataFrame, model: Kneser) -> DataFrame:
    """The rows of docs with FEATURES in place of text. Every text is read whole."""
    names = [c for c in docs.columns if c != "text"]
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
            for first, texts in _parts(batch):
                got = features(texts, shipped.value)
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(texts)) for c in cols), *map(pa.array, got.T.copy())], [*names, *FEATURES])

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + [f"{c} double" for c in FEATURES]
    return docs.mapInArrow(rows, ", ".join(schema))


class Model(NamedTuple):
    """The class models, the logistic curve from features to a probability (intercept first), or one probability for all."""

    kneser: Kneser | None
    curve: tuple[float, ...]
    constant: float


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(labelled rows to fit on: text, toxic, inside, weight; the toxic share of all labelled rows). weight says how many labelled rows of its
    class a row stands for; inside marks the calibration fold. Fold 2 is never read. Rows are taken by a hash of their id."""
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 2))
         .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
         .withColumn("_u", F.pmod(F.xxhash64(F.lit("labelled"), "_id"), F.lit(1 << 30)) / float(1 << 30)))
    y = stored(y, "toxic-labels")
    rows = {r["toxic"]: r["count"] for r in y.groupBy("toxic").count().collect()}
    take = {c: min(1.0, LABELLED_ROWS / n) for c, n in rows.items()}

    def within(shares: dict[int, float]) -> Column:
        return F.lit(False) if not shares else F.coalesce(*[F.when(F.col("toxic") == c, F.col("_u") < s) for c, s in shares.items()])

    def joined(shares: dict[int, float]) -> DataFrame:
        known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
        return known.join(checked_broadcast(y.where(within(shares))), F.col("doc_id") == F.col("_id"))

    chars = {r["toxic"]: r["n"] for r in joined(take).groupBy("toxic").agg(F.sum(F.length("text")).alias("n")).collect()}
    take = {c: take[c] * min(1.0, LABELLED_CHARS / max(n, 1)) for c, n in chars.items()}
    weight = F.coalesce(F.lit(None).cast("double"), *[F.when(F.col("toxic") == c, F.lit(1 / s)) for c, s in take.items()])
    out = joined(take).select("text", "toxic", (fold(F.col("doc_id")) == 3).alias("inside"), weight.alias("weight"))
    return stored(out, "labelled"), rows.get(1, 0) / max(1, sum(rows.values()))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Models of both classes from labelled rows outside fold 2. Models of folds 0 and 1 score fold 3, which gives the curve from features
    to a probability; the final ones are of all three folds. Rows without a text, an id or a label teach nothing; an id with several
    labels counts as toxic if one says so."""
    rows, share = sampled(docs, labels)
    pairs = counted_pairs(rows)
    final = class_models(pairs, docs)
    if final is None:
        return Model(None, (), share)
    first = class_models(pairs, docs, final)
    held = rows.where("inside").select("text", "toxic", "weight")
    if first is not None and held.select("toxic").distinct().count() == 2:
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import VectorAssembler

        ready = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(stored(featured(held, first), "calibration"))
        # the fewer rows, the more the curve is held back
        curve = LogisticRegression(featuresCol="x", labelCol="toxic", weightCol="weight", regParam=CURVE / ready.count(), maxIter=100).fit(ready)
        return Model(final, (float(curve.intercept), *map(float, curve.coefficients)), share)
    # too little to calibrate on: the log-odds of the class, moved by the strongest word
    odds = math.log((share + 1e-3) / (1 - share + 1e-3))
    return Model(final, (odds, 1.0, *[0.0] * (len(FEATURES) - 1)), share)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs with a score in place of text. Every text is scored whole; a null text counts as empty."""
    if model.kneser is None:
        return docs.drop("text").withColumn("score", F.lit(float(model.constant)))
    z = F.lit(model.curve[0])
    for c, name in zip(model.curve[1:], FEATURES):
        z = z + c * F.col(name)
    return featured(docs, model.kneser).withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))).drop(*FEATURES)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row. Labels, lang, source and doc_id are no inputs of the score. Where a class has no
    labelled words the score is the share of toxic rows among those seen, 0 if there are none. A null doc_id is not held out."""
    told = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return told.select("doc_id", held_out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, columns as given. Decisions are made by text, so equal texts stay or go together."""
    model = fit(docs, labels)
    name = free_name(docs, "_print")
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = F.concat_ws("/", F.xxhash64(text), F.xxhash64(F.lit(1), text), F.length(text))
    toxic = stored(scored(docs.select("text", mark.alias(name)), model).where(F.col("score") >= THRESHOLD).select(name).distinct(), "toxic-texts")
    return docs.withColumn(name, mark).join(checked_broadcast(toxic), name, "left_anti").select(*columns_of(docs))

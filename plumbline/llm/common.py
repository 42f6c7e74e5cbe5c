"""Shared helpers: written tables in the shared folder, checked broadcasts, row numbers, hashed words and shingles."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import ensure_checkpoint_dir

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows a broadcast table may have; beyond it the same join is left to the shuffle.
BROADCAST_ROWS = 1_000_000
#: Characters of text that one numpy pass works on.
SLICE_CHARS = 2_000_000


def shared_path(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them again, so that later jobs do not repeat the work."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The stored table, marked for broadcast if it has at most so many rows; otherwise the join shuffles both sides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """A dense row number from 1 in the given order: ranges are numbered on their own and offset by the rows before them.
    The one window without a key runs over a row per range."""
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    keyed = ranged.withColumn("_part", part)
    # one row per range of the shuffle: bounded by the number of partitions
    return (keyed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("_part", "_before", "_at"))


def slices(batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of stretches of a batch with about so many characters; null texts count as empty."""
    texts: list[str] = []
    first = size = 0
    col = batch.column(batch.schema.get_field_index(column))
    for i in range(len(col)):
        t = col[i].as_py() or ""
        texts.append(t)
        size += len(t)
        if size >= chars:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def words_of(text: str) -> list[str]:
    """The words of a text, as WORD finds them."""
    for c in "\t\n\v\f\r":
        if c in text:
            text = text.replace(c, " ")
    words = text.split(" ")
    return [w for w in words if w] if "" in words else words


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, each distinct word hashed once."""
    if not words:
        return np.empty(0, np.uint64)
    codes, uniques = pd.factorize(np.array(words, dtype=object))
    return pd.util.hash_array(uniques, categorize=False)[codes]


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k lower-case words and the number of runs of each text. A text of 1 to k - 1 words has one run, of
    all its words; an empty text has none."""
    per_text = [words_of(t.lower()) for t in texts]
    for i, w in enumerate(per_text):
        if 0 < len(w) < k:
            per_text[i] = w + [""] * (k - len(w))
    lengths = np.array([len(w) for w in per_text], np.int64)
    h = word_hashes([w for ws in per_text for w in ws])
    if not len(h):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    keep = np.ones(len(h), bool)
    ends = np.cumsum(lengths)
    for j in range(1, k):  # the last k - 1 places of a text start no run
        at = ends[lengths > 0] - j
        keep[at] = False
    return mixed(out)[keep[:n]], np.maximum(lengths - k + 1, 0)


def offsets(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches [start, start + length) of flat, one after the other."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(total)]


def components(edges: DataFrame, name: str, most_rounds: int = 64) -> DataFrame:
    """(node, component): the smallest node that a node of edges (a, b) is connected with. Each round takes the smallest label
    among the neighbours and then the label of that label; a round that changes nothing ends it."""
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-0")
    for i in range(1, most_rounds + 1):
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
                .join(labels, F.col("a") == F.col("node")).select("node", F.col("component").alias("old"), F.least("near", "component").alias("low")))
        of = labels.select(F.col("node").alias("low"), F.col("component").alias("jump"))
        new = near.join(of, "low", "left").select("node", "old", F.least("low", F.coalesce("jump", "low")).alias("component"))
        new = stored(new, f"{name}-{i}")
        changed = new.where(F.col("old") != F.col("component")).limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError(f"components are not found after {most_rounds} rounds")

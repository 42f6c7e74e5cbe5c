"""Mixing sources to target weights: equal-token blocks given out by highest quotients."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, checked_broadcast, columns_of, free_name, numbered, stored

#: Words of a block, of a shard, and how often a source may be repeated.
BLOCK_WORDS, SHARD_WORDS, MOST_EPOCHS = 64, 262_144, 3
#: Blocks that a source has at least in each of its shards, as far as it has so many: what rounding to blocks may cost it.
LEAST_BLOCKS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size): sources in code-point order, null last, take the weights in turn and
    share the sum of all sizes. A target stops at most_epochs times its source's size and its excess goes to the others by weight,
    until none is above. Sources are numbered by ranges, and a round of resharing passes two sums to the driver."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Spark compares strings by their UTF-8 bytes, which is code-point order
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "place")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", w.alias("weight")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    top = most_epochs * F.col("source_size")
    level = 0.0
    while total:
        full = top <= level * F.col("weight")
        taken, free = ranked.agg(F.sum(F.when(full, top).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))).first()
        if not free:
            break
        new = (total - taken) / free
        if new <= level:
            break
        level = new
    return ranked.select("source", "source_size", F.least(top.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def quotas(wanted: np.ndarray, blocks: np.ndarray, seats: int, most_epochs: int = MOST_EPOCHS) -> np.ndarray:
    """Sainte-Lague: seats go one by one to the source with the highest wanted / (2 * held + 1), ties to the earlier source; a
    source holds at most most_epochs times its blocks."""
    limit = np.minimum(blocks * most_epochs, seats)
    held = np.repeat(np.arange(len(wanted)), limit)
    nth = np.arange(len(held)) - np.repeat(np.cumsum(limit) - limit, limit)
    order = np.lexsort((nth, held, -(wanted[held] / (2 * nth + 1))))
    return np.bincount(held[order[:seats]], minlength=len(wanted))


def mix_shard(pdf: pd.DataFrame, block_words: int, most_epochs: int, seed: int) -> pd.DataFrame:
    """The words that the mix takes from each document of a shard. A source's documents, in the order of a seeded hash, are a ring
    of words cut into equal blocks; whole rounds take all blocks, the rest of the quota is a run of blocks from a seeded start."""
    pdf = pdf.sort_values(["source_key", "deal", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
    size = pdf["size"].to_numpy(np.int64)
    codes, names = pd.factorize(pdf["source_key"])
    words = np.bincount(codes, size, len(names)).astype(np.int64)
    # targets are shared over the shards by what each holds of the source
    first = np.unique(codes, return_index=True)[1]
    wanted = pdf["ratio"].to_numpy(float)[first] * words
    blocks = np.where(words > 0, np.maximum(1, np.round(words / block_words)), 0).astype(np.int64)
    # a seat is a block of the source's own size
    seats = wanted * blocks / np.maximum(words, 1)
    q = quotas(seats, blocks, min(int(round(seats.sum())), int(blocks.sum()) * most_epochs), most_epochs)
    ends = np.cumsum(size) - np.repeat(np.r_[0, np.cumsum(words)[:-1]], np.bincount(codes, minlength=len(names)))
    taken = np.zeros(len(pdf), np.int64)
    for s in np.flatnonzero(q):
        rows = slice(first[s], first[s] + int((codes == s).sum()))
        rounds, rest = divmod(int(q[s]), int(blocks[s]))
        hi = ends[rows]
        lo = hi - size[rows]
        n = size[rows] * rounds
        if rest:
            cut = np.round(np.arange(blocks[s] + 1) * (words[s] / blocks[s])).astype(np.int64)
            start = int(pd.util.hash_array(np.array([f"{seed}/{names[s]}/{words[s]}"], dtype=object))[0] % np.uint64(blocks[s]))
            for a, b in ((start, min(start + rest, blocks[s])), (0, max(0, start + rest - blocks[s]))):
                n = n + np.maximum(0, np.minimum(hi, cut[b]) - np.maximum(lo, cut[a]))
        taken[rows] = n
    pdf["taken"] = taken
    return pdf


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, most_epochs: int = MOST_EPOCHS, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shard) for every document.

    Documents are dealt to shards of about shard_words words by a seeded hash of id and text, so a rerun gives the same rows. A source
    is spread over as many shards as it has LEAST_BLOCKS blocks for, from a shard that a hash of its name gives: a small source sits
    whole in few shards, where blocks of its own size meet its target. In a shard, blocks of about block_words words are apportioned to the
    sources by highest quotients. A null or empty text has size 0 and gives 0 words; a null source is a source of its own;
    repeated rows are documents of their own; an empty table gives no rows. No document gives more than most_epochs times its size.
    """
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "text").alias("print")), "sizes")
    targets = stored(source_targets(sizes, weights, most_epochs), "targets")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.coalesce("source", F.lit(""))))
    by_source = targets.withColumn("source_key", key).drop("source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = (sizes.withColumn("source_key", key).join(checked_broadcast(by_source), "source_key")
              .withColumn("ratio", ratio)
              # a row number keeps copies of one document apart
              .withColumn("deal", F.xxhash64(F.lit(seed), "doc_id", "print"))
              .withColumn("_spread", F.greatest(F.lit(1), F.least(F.lit(shards), F.floor(F.col("source_size") / (LEAST_BLOCKS * block_words)))))
              .withColumn("shard", F.pmod(F.pmod(F.xxhash64("source_key"), F.lit(shards)) + F.pmod(F.xxhash64("deal", F.lit(1)), F.col("_spread")), F.lit(shards))))
    out = "doc_id long, source string, size long, source_size long, target double, ratio double, source_key string, deal long, shard long, taken long"
    cols = [c.split()[0] for c in out.split(", ")][:-1]
    mixed = joined.select(*cols).groupBy("shard").applyInPandas(lambda pdf: mix_shard(pdf, block_words, most_epochs, seed), out)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "shard", "deal")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, columns as given: a document stands as often as the mix takes it, taken / size rounded to whole
    copies (only the two documents at the ends of a run of blocks are taken in part). Documents without words stand once. The
    decision is joined back by id and text, so repeated rows share their decisions evenly."""
    seed = options.get("seed", 7)
    # rows of equal id and text are alike: what is taken from them is summed and dealt out again
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1)
    deal, times, rows, copy = (free_name(docs, f"_mix_{c}") for c in ("deal", "times", "rows", "copy"))
    taken = stored(mix(docs, **options).groupBy(F.col("deal").alias(deal)).agg(F.sum(copies).cast("int").alias(times), F.count("*").alias(rows)), "taken")
    joined = docs.withColumn(deal, F.xxhash64(F.lit(seed), "doc_id", F.xxhash64(F.lit(seed), "text"))).join(checked_broadcast(taken), deal)
    # each of n alike rows stands floor(times / n) times, and a hash of its place gives out the remainder
    base, rest = F.floor(F.col(times) / F.col(rows)), F.col(times) % F.col(rows)
    extra = F.when(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(rows)) < rest, 1).otherwise(0)
    n = (base + F.when(rest == 0, 0).otherwise(extra)).cast("int")
    return joined.withColumn(copy, F.explode(F.when(n > 0, F.sequence(F.lit(1), n)))).select(*columns_of(docs))

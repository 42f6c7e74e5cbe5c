"""Token files: ids in shards, compressed by a Re-Pair grammar with expansion lengths for random access."""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import gathered, offsets, shared_path, slices

#: Ids of a shard; a longer document is a shard of its own.
SHARD_IDS = 1_000_000
#: A pair is replaced if it is chosen so often in a round; rounds end when one shortens the sequence by less than this share.
LEAST_PAIRS, LEAST_GAIN = 4, 0.005
#: Bits of the table in which a round counts pairs.
TABLE_BITS = 18
#: Words whose ids a task remembers, and characters that it encodes at once.
CACHED_WORDS, ENCODED_CHARS = 400_000, 500_000
#: Characters that a task encodes: the fewer tasks, the fewer words are learned again.
TASK_CHARS = 40_000_000
_MARKS = string.punctuation
SHARD = "part int, place int, base int, doc_ids binary, doc_ends binary, rule_pairs binary, rule_lengths binary, width int, sequence binary, n_tokens long"


@dataclass
class Grammar:
    """Ids below base are terminals; rule i rewrites base + i as its pair and stands for lengths[i] terminals."""

    base: int
    pairs: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray


def compress(ids: np.ndarray, ends: np.ndarray, base: int, least_pairs: int = LEAST_PAIRS, least_gain: float = LEAST_GAIN) -> Grammar:
    """Re-Pair in rounds: count adjacent pairs, replace the frequent ones where they do not overlap (the more frequent pair wins,
    of equally frequent ones that with the larger slot, of one pair in a row the left one), until a round gains little. ends marks the last id of each document; no pair crosses it, so every document
    starts and ends at a symbol.

    A round counts in a hashed table: each slot stands for one pair and counts that pair only. Pairs that lose their slot have
    another one in the next round.
    """
    seq, last = ids.astype(np.uint32), ends.astype(bool)
    pairs, lengths = [], []
    total = 0
    size = np.ones(base, np.uint32)
    slots = 1 << TABLE_BITS
    turn = 0
    # rounds work in the same memory
    keys, places, ranks = np.empty(len(seq), "<u8"), np.empty(len(seq), np.uint64), np.empty(len(seq), np.int64)
    while len(seq) > 1:
        m = len(seq) - 1
        key, slot = keys[:m], places[:m]
        halves = key.view("<u4").reshape(-1, 2)
        halves[:, 0], halves[:, 1] = seq[1:], seq[:-1]
        with np.errstate(over="ignore"):
            np.multiply(key, np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * turn & 0xFFFFFFFFFFFFFFFF), out=slot)
        slot >>= np.uint64(64 - TABLE_BITS)
        slot = slot.view(np.int64)
        turn += 1
        owner = np.zeros(slots, np.uint64)
        owner[slot] = key
        held = np.take(owner, slot, out=ranks[:m].view(np.uint64), mode="clip")
        # one slot more is for places that count nothing
        np.copyto(slot, slots, where=(held != key) | last[:-1])
        counts = np.bincount(slot, minlength=slots + 1)
        counts[slots] = 0
        # copies of a passage give runs of equally frequent pairs: the slot, a hash, decides between them
        rank = np.take(np.where(counts >= least_pairs, counts << TABLE_BITS | np.arange(slots + 1), 0), slot, out=ranks[:m], mode="clip")
        # a place is chosen if no neighbour outranks it; of equal neighbours the left one
        best = np.ones(len(rank), bool)
        best[1:] = rank[1:] > rank[:-1]
        best[0] = rank[0] > 0
        best[:-1] &= rank[:-1] >= rank[1:]
        at = np.flatnonzero(best)
        if not len(at):
            break
        used = np.bincount(slot[at], minlength=slots)
        at = at[used[slot[at]] >= least_pairs]
        if not len(at):
            break
        new = np.flatnonzero(used >= least_pairs)
        number = np.zeros(slots, np.uint32)
        number[new] = base + total + np.arange(len(new), dtype=np.uint32)
        rule = np.stack([owner[new] >> np.uint64(32), owner[new] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        pairs.append(rule)
        size = np.r_[size, size[rule].sum(1, dtype=np.uint32)]
        total += len(new)
        seq[at] = number[slot[at]]
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        gain = len(at) / len(seq)
        seq, last = seq[keep], last[keep]
        if gain < least_gain:
            break
    rules = np.concatenate(pairs) if pairs else np.empty((0, 2), np.uint32)
    return Grammar(base, rules, size[base:], seq)


def rule_texts(g: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """(flat, starts): the terminals of every symbol. Rules rewrite to smaller symbols, so runs of rules that need no rule of the
    same run are expanded together."""
    flat = [np.arange(g.base, dtype=np.uint32)]
    starts, lengths = np.zeros(g.base + len(g.pairs), np.int64), np.r_[np.ones(g.base, np.int64), g.lengths.astype(np.int64)]
    starts[:g.base] = np.arange(g.base)
    done = g.base
    text = flat[0]
    most = g.pairs.max(1).astype(np.int64) if len(g.pairs) else np.empty(0, np.int64)
    high = np.maximum.accumulate(most) if len(most) else most
    while done < len(starts):
        stop = g.base + int(np.searchsorted(high, done))
        rule = g.pairs[done - g.base:stop - g.base].reshape(-1)
        new = gathered(text, starts[rule], lengths[rule])
        own = lengths[done:stop]
        starts[done:stop] = len(text) + np.cumsum(own) - own
        text = np.r_[text, new]
        done = stop
    return text, starts


def expand(g: Grammar, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """The ids at places lo to hi: expansion lengths find the symbols that cover them, and only those are expanded."""
    lengths = np.r_[np.ones(g.base, np.int64), g.lengths.astype(np.int64)]
    ends = np.cumsum(lengths[g.sequence])
    total = int(ends[-1]) if len(ends) else 0
    hi = total if hi is None else min(hi, total)
    if lo >= hi:
        return np.empty(0, np.uint32)
    a, b = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(ends, hi, "left")) + 1
    part = g.sequence[a:b]
    before = int(ends[a] - lengths[part[0]])
    if b - a > 1000:
        flat, starts = rule_texts(g)
        out = gathered(flat, starts[part], lengths[part])
    else:
        out = np.array(part, np.uint32)
        while (big := out >= g.base).any():  # from the top, for a few symbols
            width = np.where(big, 2, 1)
            first = np.cumsum(width) - width
            new = np.empty(int(width.sum()), np.uint32)
            new[first[~big]] = out[~big]
            rule = g.pairs[out[big] - g.base]
            new[first[big]], new[first[big] + 1] = rule[:, 0], rule[:, 1]
            out = new
    return out[lo - before:hi - before]


def _packed(x: np.ndarray) -> tuple[int, bytes]:
    width = 2 if not len(x) or x.max() < 1 << 16 else 3 if x.max() < 1 << 24 else 4
    return width, np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 4), np.uint8)
    out[:, :width] = raw
    return out.view("<u4").reshape(-1)


def grammar_of(shard: dict) -> Grammar:
    return Grammar(shard["base"], np.frombuffer(shard["rule_pairs"], "<u4").reshape(-1, 2), np.frombuffer(shard["rule_lengths"], "<u4"), _unpacked(shard["sequence"], shard["width"]))


class WordEncoder:
    """Ids of texts by the tokenizer. Its pre-tokens never cross a blank or a line feed, so stretches between those are encoded once
    each and their ids copied; the memory holds a bounded number of them. Plain words, which its normaliser leaves as they are, are
    encoded many at a time and split at blanks alone: the ids of each pre-token end with one that closes a word, which tells them
    apart."""

    def __init__(self, tokenizer_file: str, cached: int = CACHED_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer, self.cached = Tokenizer.from_file(tokenizer_file), cached
        self.simple = Tokenizer(self.tokenizer.model)
        self.simple.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.known: dict[str, int] = {}
        self.flat, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keeps the half of the words that was learned first, which holds most of the frequent ones."""
        kept = self.cached // 2
        self.known = dict(islice(self.known.items(), kept))
        self.lengths = self.lengths[:kept].copy()
        self.flat = self.flat[:int(self.lengths.sum())].copy()

    @staticmethod
    def _letters(words: pa.Array) -> np.ndarray:
        """Which words are lower-case letters alone: one pre-token each, which the normaliser leaves as it is."""
        plain = np.array(pc.and_(pc.ascii_is_alpha(words), pc.ascii_is_lower(words)).to_numpy(zero_copy_only=False), bool)
        other = np.flatnonzero(~plain)
        plain[other] = [w.isalpha() and w == w.lower() and unicodedata.is_normalized("NFC", w) for w in words.take(pa.array(other)).to_numpy(zero_copy_only=False)]
        return plain

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words))))
        self.flat, self.lengths = np.concatenate([self.flat, ids]), np.concatenate([self.lengths, lengths])

    def _learn(self, words: list[str]) -> None:
        column = pa.array(words, pa.large_string())
        marks = (pc.binary_length(pc.ascii_rtrim(column, characters=_MARKS)).to_numpy() == 0) & (pc.binary_length(column).to_numpy() > 0)
        one = self._letters(column) | marks
        plain, odd = [words[i] for i in np.flatnonzero(one)], [words[i] for i in np.flatnonzero(~one)]
        lines = [" ".join(plain[i:i + 200]) for i in range(0, len(plain), 200)]
        lists = [e.ids for i in range(0, len(lines), 100) for e in self.simple.encode_batch_fast(lines[i:i + 100], add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(lists), np.uint32)
        self._add(plain, ids, np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0))
        lists = [e.ids for i in range(0, len(odd), 20_000) for e in self.tokenizer.encode_batch_fast(odd[i:i + 20_000], add_special_tokens=False)]
        self._add(odd, np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists)))

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words in a row, and how many each has. Marks after letters are a pre-token of their own, so neither is
        learned again for each of the other."""
        body = pc.ascii_rtrim(words, characters=_MARKS)
        size = pc.binary_length(body).to_numpy()
        ends = np.flatnonzero((size > 0) & (size < pc.binary_length(words).to_numpy()))
        ends = ends[self._letters(body.take(pa.array(ends)))]
        first = words.to_numpy(zero_copy_only=False)
        letters = body.take(pa.array(ends)).to_numpy(zero_copy_only=False)
        tails = [w[len(b):] for w, b in zip(first[ends], letters)]
        first[ends] = letters
        parts = [*first.tolist(), *tails]
        code = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        new = [parts[i] for i in np.flatnonzero(code < 0)]
        if new:
            self._learn(list(dict.fromkeys(new)))
            code[code < 0] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        starts = np.cumsum(self.lengths) - self.lengths
        whole, tail = np.split(code, [len(first)])
        code, own = np.insert(whole, ends + 1, tail), np.insert(np.ones(len(whole), bool), ends + 1, False)
        n = self.lengths[code]
        return gathered(self.flat, starts[code], n), np.add.reduceat(n, np.flatnonzero(own))

    @staticmethod
    def _lower(text: str) -> str:
        """Lower case where the tokenizer's own step would give the same: it leaves fewer words to learn."""
        if "<|" in text or not text.isascii() and ("\u03a3" in text or "\u0130" in text or not unicodedata.is_normalized("NFC", text)):
            return text
        return text.lower()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        if len(self.known) > self.cached:
            self._forget()
        lines = pa.array([self._lower(t).replace("\n", " ") for t in texts], pa.large_string())
        words = pc.split_pattern(lines, " ")
        counts = pc.list_value_length(words).to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        flat, lengths = self._ids(coded.dictionary)
        codes = coded.indices.to_numpy()
        n = lengths[codes]
        per = np.diff(offsets(n)[offsets(counts)])
        return gathered(flat, (np.cumsum(lengths) - lengths)[codes], n), per


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 1, shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of every text, each followed by end_id, in ascending order of doc_id (null first, then by text).

    The format is a Parquet table of shards: document ids, the place after each document's last id, the rules of the shard's grammar
    with their expansion lengths, and the rewritten sequence. part and place give the order of shards.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        encoder = WordEncoder(tokenizer_file)
        base = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal held, size, place
            doc_ids = [i for d, _, _ in held for i in d]
            ids, counts = np.concatenate([x for _, x, _ in held]), np.concatenate([c for _, _, c in held])
            held, size = [], 0
            stops = np.cumsum(counts)
            last = np.zeros(len(ids), bool)
            last[stops - 1] = True
            g = compress(ids, last, base)
            width, seq = _packed(g.sequence)
            known = np.array([i is not None for i in doc_ids], bool)
            row = {"part": part, "place": place, "base": base, "doc_ids": np.array([i or 0 for i in doc_ids], "<i8").tobytes() + known.tobytes(),
                   "doc_ends": stops.astype("<u8").tobytes(), "rule_pairs": g.pairs.astype("<u4").tobytes(), "rule_lengths": g.lengths.astype("<u4").tobytes(),
                   "width": width, "sequence": seq, "n_tokens": len(ids)}
            place += 1
            kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array([row[n]], kinds[k]) for n, k in (c.split() for c in SHARD.split(", "))], [c.split()[0] for c in SHARD.split(", ")])

        for batch in batches:
            names = batch.column(batch.schema.get_field_index("doc_id"))
            for first, texts in slices(batch, chars=ENCODED_CHARS):
                ids, counts = encoder.encode(texts)
                whole = np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32)
                held.append((names.slice(first, len(texts)).to_pylist(), whole, counts + 1))
                size += len(whole)
                if size >= shard_ids:
                    yield shard()
        if held:
            yield shard()

    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(max(1, -(-total // TASK_CHARS)), *order).sortWithinPartitions(*order)
    ranged.mapInArrow(encode, SHARD).write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part) of every document of the files: start counts the ids of all documents before it,
    in the order of the files. Shards are decoded where they lie; the only global step is a running sum over parts, of which there
    are as many as tasks that wrote."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = expand(grammar_of(shard)).astype("<u4")
                stops = np.frombuffer(shard["doc_ends"], "<u8").astype(np.int64)
                n = len(stops)
                names = np.frombuffer(shard["doc_ids"][:8 * n], "<i8")
                known = np.frombuffer(shard["doc_ids"][8 * n:], bool)
                begins = np.r_[0, stops[:-1]]
                raw = memoryview(ids.tobytes())
                crc = np.fromiter((zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins, stops)), np.int64, n)
                full = lambda x, kind: pa.array(np.full(n, x), kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64(), mask=~known), full(shard["part"], pa.int32()), full(shard["place"], pa.int32()), pa.array(begins), pa.array(stops - begins), pa.array(crc)],
                    ["doc_id", "part", "place", "begin", "n_tokens", "ids_crc32"])

    shards = spark.read.parquet(path)
    totals = shards.groupBy("part", "place").agg(F.sum("n_tokens").alias("n"))
    # shards of a part lie in one task's output; parts are as many as write tasks
    inside = totals.withColumn("in_part", F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    bases = inside.join(before, "part").select("part", "place", (F.col("in_part") + F.col("before")).alias("base"))
    rows = shards.mapInArrow(decode, "doc_id long, part int, place int, begin long, n_tokens long, ids_crc32 long")
    return rows.join(bases, ["part", "place"]).select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_file: str, end_id: int = 1, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the token files of the documents and reads them back: one row per document.

    A null or empty text has the end id alone; a null doc_id comes first and stays null; repeated rows are documents of their own,
    rows of equal doc_id stand in the order of a hash of their texts. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_file, end_id, shard_ids)
    return read_tokens(spark, path)

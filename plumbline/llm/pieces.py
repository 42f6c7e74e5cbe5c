"""SentencePiece encoding and decoding with seeded merge-dropout."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SLICE_CHARS, gathered, mixed, offsets, slices

#: The mark that stands for a blank in pieces.
MARK = "\u2581"
#: Share of candidate merges that are skipped, and seeds that documents are dealt to.
DROPOUT, VARIANTS = 0.1, (1 << 31) - 1
#: Units a task remembers, and the longest one that numpy segments in rows.
CACHED_UNITS, LONGEST_ROW = 800_000, 64
_NONE = np.int32(1 << 30)
_C1, _C2, _C3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_M = (1 << 64) - 1


def _mixed_int(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M
    return x ^ (x >> 31)


class Vocabulary:
    """Pieces of a merge-type model: symbols are piece ids, or numbers above them for characters that only pieces hold."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.symbol = {self.pieces[i]: i for i in plain}
        for i in plain:
            for c in self.pieces[i]:
                self.symbol.setdefault(c, max(n, len(self.symbol) + n))
        extra = sorted(c for c, s in self.symbol.items() if s >= n)
        self.symbol.update(zip(extra, range(n, n + len(extra))))
        self.size, self.unknown = n, n + len(extra)
        self.span = self.unknown + 1
        merges = []
        for i in plain:
            p = self.pieces[i]
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    merges.append((a * self.span + b, sp.get_score(i), i))
        merges.sort()
        self.keys = np.array([m[0] for m in merges], np.int64)
        self.made = np.array([m[2] for m in merges], np.int64)
        # equal scores rank alike, so that the left one goes first
        order = {s: r for r, s in enumerate(sorted({m[1] for m in merges}, reverse=True))}
        self.rank = np.array([order[m[1]] for m in merges], np.int32)
        self.of_rank = np.zeros(len(order), np.int32)
        self.of_rank[self.rank] = self.made
        self.bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.lookup = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.made.tolist())))

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of merging each pair, _NONE if it is none."""
        key = left.astype(np.int64) * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def spelled(self, symbol: int, char: str) -> list[int]:
        """A symbol as ids: its piece, or the bytes of its character."""
        return [symbol] if symbol < self.size else [self.byte_id[b] for b in char.encode()]


def agenda(v: Vocabulary, unit: str, key: int, dropout: float) -> list[int]:
    """Segments one unit: the candidate with the best score, then the leftmost, is merged next, unless the hash of the key and the
    ends of its two parts says that it is skipped."""
    sym = [v.symbol.get(c, v.unknown) for c in unit]
    n = len(sym)
    start, prev, nxt = list(range(n)), [i - 1 for i in range(n)], [i + 1 if i + 1 < n else -1 for i in range(n)]
    end = [i + 1 for i in range(n)]
    limit = int(dropout * (1 << 53))
    heap: list = []

    def push(i: int) -> None:
        j = nxt[i]
        if j < 0:
            return
        hit = v.lookup.get(sym[i] * v.span + sym[j])
        if hit and _mixed_int((key + start[i] * _C1 + start[j] * _C2 + end[j] * _C3) & _M) >> 11 >= limit:
            heapq.heappush(heap, (hit[0], i, j, end[i], end[j], hit[1]))

    for i in range(n - 1):
        push(i)
    alive = [True] * n
    while heap:
        _, i, j, e, f, made = heapq.heappop(heap)
        if not (alive[i] and alive[j] and end[i] == e and end[j] == f and nxt[i] == j):
            continue
        sym[i], end[i], alive[j], nxt[i] = made, end[j], False, nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        if prev[i] >= 0:
            push(prev[i])
        push(i)
    out, i = [], 0
    while i >= 0 and n:
        out += v.spelled(sym[i], unit[start[i]])
        i = nxt[i]
    return out


def _rows(v: Vocabulary, distinct: list[str], which: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """agenda() for many units of like length, distinct[which]: one merge of every unit at a time. The ids in a row, and how many each
    unit has. What the skips do not change, symbols and the ranks of their pairs, is looked up once for each distinct unit."""
    limit = np.uint64(int(dropout * (1 << 53)))
    n, width = len(which), max(map(len, distinct))
    sizes = np.fromiter(map(len, distinct), np.int32, len(distinct))
    count = sizes[which]
    code = np.frombuffer("".join([u.ljust(width, "\x01") for u in distinct]).encode("utf-32-le"), "<u4").reshape(len(distinct), width)
    chars, inv = np.unique(code, return_inverse=True)
    spelling = np.array([v.symbol.get(chr(c), v.unknown) for c in chars], np.int32)[inv.reshape(len(distinct), width)]
    sym = spelling[which]
    col = np.arange(width, dtype=np.int16)
    # the part at column i ends where that at column i + 1 starts
    start = np.broadcast_to(np.arange(width + 1, dtype=np.int16), (n, width + 1)).copy()
    rows = np.arange(n)
    final, left, first = np.zeros((n, width), np.int32), np.zeros(n, np.int32), np.zeros((n, width), np.int16)

    def taken(key, a, b, c):
        """Whether pairs from place a to b to c are not skipped."""
        with np.errstate(over="ignore"):
            return (mixed(key + a * np.uint64(_C1) + b * np.uint64(_C2) + c * np.uint64(_C3)) >> np.uint64(11)) >= limit

    def ranks(r, i):
        """Rank of the pair at columns i, i + 1 of rows r; skipped pairs have none."""
        a, b, c = (start[r, i + k].astype(np.uint64) for k in range(3))
        return np.where(taken(keys[r], a, b, c), v.find(sym[r, i], sym[r, i + 1]), _NONE)

    rank = np.full((n, width), _NONE)
    if width > 1:
        pairs = np.full((len(distinct), width), _NONE)
        r, i = np.nonzero(col[None, 1:] < sizes[:, None])
        pairs[r, i] = v.find(spelling[r, i], spelling[r, i + 1])
        r, i = np.nonzero((pairs != _NONE)[which])
        at = i.astype(np.uint64)
        rank[r, i] = np.where(taken(keys[r], at, at + np.uint64(1), at + np.uint64(2)), pairs[which[r], i], _NONE)
    while len(rows):
        at = rank.argmin(1)
        best = rank[np.arange(len(rows)), at]
        stop = best == _NONE
        if stop.any():
            final[rows[stop]], left[rows[stop]], first[rows[stop]] = sym[stop], count[stop], start[stop, :width]
            go = ~stop
            rows, sym, start, rank, at, best, count, keys = (x[go] for x in (rows, sym, start, rank, at, best, count, keys))
            if not len(rows):
                break
        r = np.arange(len(rows))
        sym[r, at] = v.of_rank[best]
        # the right part goes, what stands after it moves up
        moves = col[None, :] > at[:, None]
        for x in (sym, rank):
            np.copyto(x[:, :-1], x[:, 1:], where=moves[:, :-1])
        np.copyto(start[:, :-1], start[:, 1:], where=moves)
        count = count - 1
        rank[r, np.maximum(count - 1, 0)] = _NONE
        for i, ok in ((at - 1, at > 0), (at, at < count - 1)):
            k = np.flatnonzero(ok)
            if len(k):
                rank[k, i[k]] = ranks(k, i[k])
    inside = col[None, :] < left[:, None]
    odd = np.flatnonzero(((final >= v.size) & inside).any(1))
    if not len(odd):
        return final[inside], left.astype(np.int64)
    spelled = {k: [x for j in range(left[k]) for x in v.spelled(int(final[k, j]), distinct[which[k]][first[k, j]])] for k in odd.tolist()}
    parts = [np.array(spelled[k], np.int32) if k in spelled else final[k, :left[k]] for k in range(n)]
    return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, n)


def segment(v: Vocabulary, units: list[str], keys: np.ndarray, dropout: float, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat, starts, lengths): the ids of each of units[which] (without which, of all units) under its key. A line feed and a literal
    mark are spelled in bytes, so that they come back; long units and those with several blanks, whose merges rank alike, go through
    the agenda one by one."""
    which = np.arange(len(units)) if which is None else which
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    alone = np.fromiter((u[:1] == "\n" or u[:2] == MARK + MARK for u in units), bool, len(units)) | (sizes > LONGEST_ROW)
    starts, lengths = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
    flat, at = [np.empty(0, np.int32)], 0
    for i in np.flatnonzero(alone[which]).tolist():
        u = units[which[i]]
        ids = [v.byte_id[b] for b in u[-1].encode()] if u[:1] == "\n" else agenda(v, u, int(keys[i]), dropout)
        starts[i], lengths[i] = at, len(ids)
        flat.append(np.array(ids, np.int32))
        at += len(ids)
    sizes[alone] = 0
    by_size = np.argsort(sizes, kind="stable")
    place = np.empty(len(units), np.int32)
    place[by_size] = np.arange(len(units))
    order = np.argsort(place[which], kind="stable")
    ordered = sizes[which[order]]
    lo = int(np.searchsorted(ordered, 1))
    while lo < len(order):
        first = int(ordered[lo])
        hi = min(lo + 20_000, int(np.searchsorted(ordered, first + max(1, first // 5), "right")))
        part = order[lo:hi]
        places = place[which[part]]
        ids, n = _rows(v, [units[i] for i in by_size[places[0]:places[-1] + 1].tolist()], places - places[0], keys[part], dropout)
        starts[part], lengths[part] = at + np.cumsum(n) - n, n
        flat.append(ids)
        at += len(ids)
        lo = hi
    return np.concatenate(flat), starts, lengths


class Encoder:
    """Ids of texts. No piece crosses the start of a run of blanks or a line feed, so the units between them are segmented apart.
    The key of a unit is a hash of the seed, the document's variant, the unit and its place in the text, so each occurrence skips merges
    of its own; without dropout a unit is segmented once."""

    def __init__(self, model_file: str, seed: int = 7, dropout: float = DROPOUT, variants: int = VARIANTS, cached: int = CACHED_UNITS):
        self.v, self.seed, self.dropout, self.variants, self.cached = Vocabulary(model_file), seed, dropout, variants, cached
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def units(text: str) -> list[str]:
        """The text as line feeds, literal marks (written with a line feed before them) and stretches that begin with their blanks
        as marks; the first stretch has one more."""
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append("\n")
            for j, part in enumerate(line.split(MARK)):
                if j:
                    out.append("\n" + MARK)
                words = part.split(" ")
                if i == j == 0:
                    words.insert(0, "")
                if words[0]:
                    out.append(words[0])
                rest = words[1:]
                if "" not in rest:
                    out += [MARK + w for w in rest]
                    continue
                blanks = ""
                for w in rest:
                    blanks += MARK
                    if w:
                        out.append(blanks + w)
                        blanks = ""
                if blanks:
                    out.append(blanks)
        return out

    def key(self, variant: int | np.ndarray, unit_hashes: np.ndarray, places: int | np.ndarray = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            stream = np.uint64((self.seed * 1_000_003) & _M) + np.atleast_1d(np.asarray(variant)).astype(np.uint64)
            return mixed(unit_hashes ^ mixed(mixed(stream) + np.atleast_1d(np.asarray(places)).astype(np.uint64) * np.uint64(_C1)))

    def encode(self, texts: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has. An empty text has none."""
        per_text = [self.units(t) if t else [] for t in texts]
        counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
        units = [u for ws in per_text for u in ws]
        if not units:
            return np.empty(0, np.int32), counts
        codes, distinct = pd.factorize(np.array(units, dtype=object))
        hashes = pd.util.hash_array(distinct, categorize=False)[codes]
        if any("\0" in t for t in texts):  # at which factorize ends a unit
            number: dict[str, int] = {}
            codes = np.fromiter((number.setdefault(u, len(number)) for u in units), np.int64, len(units))
            distinct = np.array(list(number), dtype=object)
        if self.dropout:
            places = np.arange(len(units)) - np.repeat(offsets(counts)[:-1], counts)
            flat, starts, lengths = segment(self.v, distinct.tolist(), self.key(np.repeat(np.asarray(variants), counts), hashes, places), self.dropout, codes)
        else:
            if len(self.known) > self.cached:
                self._clear()
            fresh = [u for u in distinct.tolist() if u not in self.known]
            if fresh:
                self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
                flat, starts, lengths = segment(self.v, fresh, np.zeros(len(fresh), np.uint64), 0.0)
                self.starts, self.lengths = np.r_[self.starts, starts + len(self.flat)], np.r_[self.lengths, lengths]
                self.flat = np.r_[self.flat, flat]
            at = np.fromiter(map(self.known.__getitem__, distinct.tolist()), np.int64, len(distinct))[codes]
            flat, starts, lengths = self.flat, self.starts[at], self.lengths[at]
        return gathered(flat, starts, lengths), np.diff(offsets(lengths)[offsets(counts)])


def decode(v: Vocabulary, ids: list[int]) -> str:
    """The text of ids: bytes of the pieces, without the blank that every text begins with."""
    data = b"".join(map(v.bytes.__getitem__, ids))
    return data[1:].decode("utf-8", "replace") if data.startswith(b" ") else data.decode("utf-8", "replace")


def _variant(seed: int, variants: int):
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(variants)).cast("int").alias("variant")


def encode_documents(docs: DataFrame, model_file: str, seed: int = 7, dropout: float = DROPOUT, variants: int = VARIANTS) -> DataFrame:
    """(doc_id, variant, ids) for every row, in place. The variant is a keyed hash of doc_id and text, so reruns agree; it
    and the place in the text seed the skips, so that a word is segmented anew wherever it stands. A null text counts as empty and has no ids; a null
    doc_id stays null; repeated rows are encoded alike."""
    return round_trip(docs, model_file, seed, dropout, variants, check=False).select("doc_id", "variant", "ids")


def round_trip(docs: DataFrame, model_file: str, seed: int = 7, dropout: float = DROPOUT, variants: int = VARIANTS, check: bool = True, chars: int = SLICE_CHARS) -> DataFrame:
    """(doc_id, variant, n_ids, ids, lossless): the ids of encode_documents, decoded again in the same pass; lossless says whether
    that gave the text back (null without check). A task encodes about so many chars at once: fewer take less memory and a little more
    time, the ids are the same."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(model_file, seed, dropout, variants)
        for batch in batches:
            names = batch.column(batch.schema.get_field_index("doc_id"))
            which = batch.column(batch.schema.get_field_index("variant")).to_numpy()
            for first, texts in slices(batch, chars=chars):
                part = which[first:first + len(texts)]
                ids, counts = e.encode(texts, part)
                at = offsets(counts)
                same = [decode(e.v, ids[at[i]:at[i + 1]].tolist()) == t for i, t in enumerate(texts)] if check else [None] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [names.slice(first, len(texts)), pa.array(part, pa.int32()), pa.array(counts, pa.int32()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)), pa.array(same, pa.bool_())],
                    ["doc_id", "variant", "n_ids", "ids", "lossless"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _variant(seed, variants)).mapInArrow(encode, "doc_id long, variant int, n_ids int, ids array<int>, lossless boolean")


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) of encoded rows; null ids give an empty text."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(model_file)
        for batch in batches:
            ids, names = (batch.column(batch.schema.get_field_index(c)) for c in ("ids", "doc_id"))
            for i in range(0, batch.num_rows, 500):
                yield pa.RecordBatch.from_arrays([names.slice(i, 500), pa.array([decode(v, x or []) for x in ids.slice(i, 500).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(back, "doc_id long, text string")

"""Byte-level BPE by a transducer: merges are compiled once, its states are determinised as texts need them, decoding streams."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import free_name, gathered, offsets, slices

#: Characters that are split and encoded at once.
BATCH_CHARS = 4_000_000
#: States that a task keeps; beyond it they are built anew from the start state, with the same results.
KEPT_STATES = 400_000
#: Bytes of a piece that run beside the other pieces; what a longer piece has left runs on its own.
LOCKSTEP = 64
#: Tokens that the decoder takes at once.
DECODE_TOKENS = 1 << 16
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
_NEVER = np.int64(1) << 40


def char_classes() -> np.ndarray:
    """The class of every code point (letter, number, white space, other), asked of the library's own pattern engine, so that its
    edition of Unicode decides: a pattern without merges returns the code points that it matches."""
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    singles = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        found = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=singles, special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(found).decode().encode("utf-32-le"), "<u4")] = kind
    return out


def piece_starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the matches of the pattern start in code points of several texts in a row; first marks the first one of each text.

    A match is a run of one class with the blank before it; white space before other text leaves its last character to a match of its
    own or to the run; an apostrophe of its own takes one of the fixed endings s, t, re, ve, m, ll, d from the letters after it.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = classes[points]
    run = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]] | first)
    stop = np.r_[run[1:], n]
    of = kind[run]
    alone = first[run]  # nothing of the same text stands before it
    before = np.where(alone, 0, points[np.maximum(run - 1, 0)])
    space = of == _SPACE
    start = np.zeros(n, bool)
    start[run[~space] - (before[~space] == 32)] = True
    ends = np.r_[alone[1:], True]  # white space that ends its text stays whole
    a, z = run[space], stop[space]
    blank, whole = points[z - 1] == 32, ends[space]
    start[a[(z - a > 1) | ~blank | whole]] = True
    start[z[~blank & ~whole] - 1] = True
    mark = np.flatnonzero((of[:-1] == _OTHER) & (stop[:-1] - run[:-1] == 1) & (points[run[:-1]] == 39) & (before[:-1] != 32) & (of[1:] == _LETTER) & ~alone[1:])
    if len(mark):
        at, end = run[mark + 1], stop[mark + 1]
        one = points[at]
        two = np.where(end - at > 1, points[np.minimum(at + 1, n - 1)], 0)
        pair = np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        taken = np.where(pair, 2, np.isin(one, [ord(c) for c in "stmd"]).astype(int))
        start[at[taken > 0]] = False
        more = (taken > 0) & (at + taken < end)
        start[at[more] + taken[more]] = True
    return np.flatnonzero(start)


class Merges:
    """A rank file compiled: a trie of the tokens, and what tells whether one token may follow another.

    A sequence of tokens is the encoding of its bytes exactly if every two neighbours are. Two neighbours fail if an end part of the
    left one and a start part of the right one merge at a rank at which both still stand, so each token keeps the parts at its edges,
    outermost last.
    """

    def __init__(self, ranks_file: str):
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a rank file has to hold every single byte")
        size = max(ranks.values()) + 1
        joined: dict[tuple[int, int], int] = {}
        halves: dict[int, tuple[int, int]] = {}
        self.whole: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    joined[left, right] = rank
            if len(token) > 1:
                parts = self._below(token, rank, ranks)
                if len(parts) == 2 and max(parts) < rank:
                    halves[rank] = (parts[0], parts[1])
                else:  # no merges lead to it: only a piece equal to it is this token
                    self.whole[token] = rank
        left, right = {}, {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                left[rank] = right[rank] = [rank]
            elif rank in halves:
                a, b = halves[rank]
                if a in left and b in right:
                    left[rank], right[rank] = [rank, *left[a]], [rank, *right[b]]
                else:
                    self.whole[token] = rank
        self.left, self.right = self._table(left, size), self._table(right, size)
        keys = np.array([a << 32 | b for a, b in joined] or [-1], np.int64)
        order = np.argsort(keys)
        self.pairs, self.merged = keys[order], np.array(list(joined.values()) or [0], np.int64)[order]
        edges: dict[int, int] = {}
        token_of = [-1]
        for token, rank in ranks.items():
            if rank not in left:
                continue
            node = 0
            for b in token:
                node = edges.setdefault(node << 8 | b, len(token_of))
                if node == len(token_of):
                    token_of.append(-1)
            token_of[node] = rank
        keys = np.array(list(edges), np.int64)
        order = np.argsort(keys)
        self.edges, self.children = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.token_of = np.array(token_of, np.int64)
        self.open = np.zeros(len(token_of), bool)
        self.open[keys >> 8] = True
        texts = [b""] * size
        for token, rank in ranks.items():
            texts[rank] = token
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts, self.text = offsets(self.lengths)[:-1], np.frombuffer(b"".join(texts), np.uint8)

    @staticmethod
    def _below(token: bytes, rank: int, ranks: dict[bytes, int]) -> list[int]:
        """The parts of a token that merges below its rank leave."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank]
            if not found:
                break
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    @staticmethod
    def _table(parts: dict[int, list[int]], size: int) -> np.ndarray:
        out = np.full((max(map(len, parts.values())), size), -1, np.int32)
        for rank, own in parts.items():
            out[:len(own), rank] = own
        return out

    def follows(self, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether token t may stand after token p; -1 stands for the start of a piece."""
        ok = np.ones(len(p), bool)
        at = np.flatnonzero(p >= 0)
        upper = np.full(len(at), _NEVER)
        for i in range(len(self.right)):
            x = self.right[i, p[at]].astype(np.int64)
            at, x, upper = at[x >= 0], x[x >= 0], upper[x >= 0]
            if not len(at):
                break
            sub, limit = np.arange(len(at)), np.full(len(at), _NEVER)
            for j in range(len(self.left)):
                y = self.left[j, t[at[sub]]].astype(np.int64)
                sub, limit, y = sub[y >= 0], limit[y >= 0], y[y >= 0]
                if not len(sub):
                    break
                key = x[sub] << 32 | y
                k = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
                rank = np.where(self.pairs[k] == key, self.merged[k], _NEVER)
                # of two merges of one rank the left one comes first
                ok[at[sub[(rank < upper[sub]) & (rank <= limit)]]] = False
                limit = y
            upper = x
        return ok


class Transducer:
    """Reads bytes, tells the token that ends at each. A state is the set of open readings: the last token of each, and how far into the
    next token it is. There is one reading for each place where a token may still end, so after every byte exactly one token closes.
    States and steps are made when a text first needs them."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self._restart()

    def _restart(self) -> None:
        self.names: dict[bytes, int] = {}
        self.steps: dict[int, int] = {}  # state and byte to next state and token
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.readings, self.filled = np.zeros(4096, np.int64), 0
        self._named(np.zeros(1, np.int64), np.array([0, 1]))

    def _named(self, readings: np.ndarray, bounds: np.ndarray) -> list[int]:
        """The numbers of states given by their readings; unknown ones are added."""
        raw, cut = readings.tobytes(), (bounds * 8).tolist()
        names, out, new = self.names, [], []
        for i in range(len(cut) - 1):
            key = raw[cut[i]:cut[i + 1]]
            state = names.get(key)
            if state is None:
                state = names[key] = len(names)
                new.append(i)
            out.append(state)
        if new:
            new = np.array(new)
            n = np.diff(bounds)[new]
            rows = gathered(readings, bounds[new], n)
            if len(names) > len(self.first):
                self.first, self.count = (np.r_[x, np.zeros(len(names), np.int64)] for x in (self.first, self.count))
            if self.filled + len(rows) > len(self.readings):
                self.readings = np.r_[self.readings, np.zeros(self.filled + len(rows), np.int64)]
            known = len(names) - len(new)
            self.first[known:len(names)] = self.filled + np.cumsum(n) - n
            self.count[known:len(names)] = n
            self.readings[self.filled:self.filled + len(rows)] = rows
            self.filled += len(rows)
        return out

    def _determinise(self, keys: np.ndarray) -> None:
        """Adds the steps for keys state << 8 | byte."""
        m = self.merges
        state, byte = keys >> 8, keys & 255
        n = self.count[state]
        rows = gathered(self.readings, self.first[state], n)
        owner = np.repeat(np.arange(len(keys)), n)
        last, node = (rows >> 32) - 1, rows & 0xFFFFFFFF
        edge = node << 8 | byte[owner]
        at = np.minimum(np.searchsorted(m.edges, edge), len(m.edges) - 1)
        on = m.edges[at] == edge
        owner, last, child = owner[on], last[on], m.children[at[on]]
        token = m.token_of[child]
        closing = np.flatnonzero(token >= 0)
        closing = closing[m.follows(last[closing], token[closing])]
        closed = np.zeros(len(keys), np.int64)
        closed[owner[closing]] = token[closing]
        still = m.open[child]
        who = np.r_[owner[still], np.arange(len(keys))]
        rows = np.r_[(last[still] + 1) << 32 | child[still], (closed + 1) << 32]
        order = np.argsort(who, kind="stable")
        bounds = np.searchsorted(who[order], np.arange(len(keys) + 1))
        after = self._named(rows[order], bounds)
        self.steps.update(zip(keys.tolist(), [s << 32 | t for s, t in zip(after, closed.tolist())]))

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, token that ends here)."""
        key = state << 8 | byte
        if key not in self.steps:
            self._determinise(np.array([key]))
        found = self.steps[key]
        return found >> 32, found & 0xFFFFFFFF

    def open_places(self, state: int) -> list[int]:
        """How many bytes back the open readings of a state began their unfinished token."""
        if not hasattr(self, "depth"):
            self.depth = np.zeros(len(self.merges.token_of), np.int64)
            for edge, child in sorted(zip((self.merges.edges >> 8).tolist(), self.merges.children.tolist()), key=lambda e: e[1]):
                self.depth[child] = self.depth[edge] + 1
        rows = self.readings[self.first[state]:self.first[state] + self.count[state]]
        return self.depth[rows & 0xFFFFFFFF].tolist()

    def encode_pieces(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each has): pieces run side by side, a byte at a time."""
        if len(self.names) > KEPT_STATES:
            self._restart()
        order = np.argsort(-lengths, kind="stable")
        at, n = starts[order], lengths[order]
        state, closed = np.zeros(len(order), np.int64), np.zeros(len(text), np.int32)
        for k in range(min(int(n[0]) if len(n) else 0, LOCKSTEP)):
            live = int(np.searchsorted(-n, -k))  # pieces longer than k
            keys, back = np.unique(state[:live] << 8 | text[at[:live] + k], return_inverse=True)
            found = list(map(self.steps.get, keys.tolist()))
            if None in found:
                self._determinise(keys[[f is None for f in found]])
                found = list(map(self.steps.get, keys.tolist()))
            step = np.array(found, np.int64)[back]
            state[:live] = step >> 32
            closed[at[:live] + k] = step & 0xFFFFFFFF
        for i in np.flatnonzero(n > LOCKSTEP).tolist():
            s, a, z = int(state[i]), int(at[i]) + LOCKSTEP, int(at[i] + n[i])
            tail = []
            for byte in text[a:z].tolist():
                s, token = self.step(s, byte)
                tail.append(token)
            closed[a:z] = tail
        # from the end of each piece back: its last token, then the token that ends where that one starts
        places, ids = [], []
        who, end = np.flatnonzero(lengths), (starts + lengths)[lengths > 0]
        while len(who):
            token = closed[end - 1]
            end = end - self.merges.lengths[token]
            places.append(end)
            ids.append(token)
            more = end > starts[who]
            who, end = who[more], end[more]
        places, ids = np.concatenate(places or [np.empty(0, np.int64)]), np.concatenate(ids or [np.empty(0, np.int32)])
        into = np.argsort(places, kind="stable")
        ids, of = ids[into], np.searchsorted(starts, places[into], "right") - 1
        counts = np.bincount(of, minlength=len(starts)) if len(of) else np.zeros(len(starts), np.int64)
        for token, rank in self.merges.whole.items():
            for i in np.flatnonzero(lengths == len(token)).tolist():
                if text[starts[i]:starts[i] + lengths[i]].tobytes() == token:
                    a = int(counts[:i].sum())
                    ids = np.r_[ids[:a], rank, ids[a + counts[i]:]]
                    counts[i] = 1
        return ids, counts


class PieceStream:
    """Encodes the bytes of one piece as they come: a token is told as soon as all open readings agree on it, so it waits for no more
    bytes than the longest token has."""

    def __init__(self, transducer: Transducer):
        self.transducer, self.state = transducer, 0
        self.closed: list[int] = []  # tokens that end at the bytes after the last one told

    def _chain(self, end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(self.closed[end - 1])
            end -= int(self.transducer.merges.lengths[out[-1]])
        return out[::-1]

    def feed(self, data: bytes) -> list[int]:
        told: list[int] = []
        for byte in data:
            self.state, token = self.transducer.step(self.state, byte)
            self.closed.append(token)
            places = [len(self.closed) - d for d in self.transducer.open_places(self.state)]
            if min(places) <= 0:
                continue
            chains = [self._chain(p) for p in places]
            sure = 0
            while all(len(c) > sure and c[sure] == chains[0][sure] for c in chains):
                sure += 1
            told += chains[0][:sure]
            del self.closed[:int(self.transducer.merges.lengths[chains[0][:sure]].sum())]
        return told

    def finish(self) -> list[int]:
        out = self._chain(len(self.closed))
        self.state, self.closed = 0, []
        return out


class Utf8Stream:
    """Text of bytes that come in parts. The state is the start of a character that is not complete; bytes that can start or continue none
    become U+FFFD."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _open(tail: bytes) -> int:
        """How many of the last bytes may yet become a character: the state machine over its lead byte, the range of the second byte that the
        lead allows, and the bytes still wanted."""
        for back in range(1, min(3, len(tail)) + 1):
            lead = tail[-back]
            if 0x80 <= lead < 0xC0:
                continue
            wanted = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
            if back >= wanted:
                return 0
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
            high = {0xED: 0xA0, 0xF4: 0x90}.get(lead, 0xC0)
            return back if back == 1 or low <= tail[1 - back] < high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = self._open(data[-3:])
        self.held = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


class TextEncoder:
    """Ids of whole texts: the matches of the pattern, each distinct one of a batch run once through the transducer."""

    def __init__(self, merges: Merges, classes: np.ndarray):
        self.transducer, self.classes = Transducer(merges), classes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        heads = offsets(chars)[:-1]
        first = np.zeros(len(points) + 1, bool)
        first[heads] = True
        starts = piece_starts(points, first[:-1], self.classes)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.r_[offsets(width)[starts], int(width.sum())]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(joined.encode())]).dictionary_encode()
        codes, distinct = pieces.indices.to_numpy(), pieces.dictionary
        bounds = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1)
        flat = np.frombuffer(distinct.buffers()[2], np.uint8)
        ids, counts = self.transducer.encode_pieces(flat, bounds[:-1], np.diff(bounds))
        begin, n = np.cumsum(counts) - counts, counts[codes]
        per = np.diff(np.r_[offsets(n)[np.searchsorted(starts, heads)], int(n.sum())])
        return gathered(ids, begin[codes], n).astype(np.uint32), per


def decode_blocks(merges: Merges, ids: np.ndarray, tokens: int = DECODE_TOKENS) -> Iterator[str]:
    """The text of ids, told in parts as blocks of tokens come in."""
    stream = Utf8Stream()
    for a in range(0, len(ids), tokens):
        part = ids[a:a + tokens]
        yield stream.feed(gathered(merges.text, merges.starts[part], merges.lengths[part]).tobytes())
    yield stream.finish()


def _shipped(docs: DataFrame, ranks_file: str):
    """The compiled merges and the character classes, of the size of the vocabulary and of Unicode, sent to each executor once."""
    return docs.sparkSession.sparkContext.broadcast((Merges(ranks_file), char_classes()))


def _with_column(rows: DataFrame, source: str, name: str, kind: str, column) -> DataFrame:
    """The rows with one more column, made by column(batch, place of the source) in stretches (first row, array). Names stay out of the
    task, where a dot in one would be read as a field."""
    place = [c.lower() for c in rows.columns].index(source.lower())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = column()
        for batch in batches:
            for first, new in make(batch, place):
                part = batch.slice(first, len(new))
                yield pa.RecordBatch.from_arrays([*part.columns, new], names=[*batch.schema.names, "new"])

    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return plain.mapInArrow(run, plain.withColumn("new", F.lit(None).cast(kind)).schema).toDF(*rows.columns, name)


def encoded(docs: DataFrame, ranks_file: str, text_col: str = "text") -> DataFrame:
    """The rows with their ids (array<int>): every whole text, null as empty, encoded without special tokens as the library would.

    An empty text has no ids. Texts of any length, repeated rows and ids keep their rows; the new column takes a longer name where the
    table has one called ids.
    """
    shipped = _shipped(docs, ranks_file)

    def ids_of():
        encoder = TextEncoder(*shipped.value)

        def make(batch: pa.RecordBatch, place: int) -> Iterator[tuple[int, pa.Array]]:
            for first, texts in slices(batch, batch.schema.names[place], BATCH_CHARS):
                ids, counts = encoder.encode(texts)
                yield first, pa.ListArray.from_arrays(pa.array(offsets(counts).astype(np.int32)), pa.array(ids.astype(np.int32)))

        return make

    return _with_column(docs, text_col, free_name(docs, "ids"), "array<int>", ids_of)


def decoded(rows: DataFrame, ranks_file: str, ids_col: str = "ids") -> DataFrame:
    """The rows with the text of their ids; null ids give a null text, bytes that are no UTF-8 give U+FFFD."""
    shipped = _shipped(rows, ranks_file)

    def text_of():
        merges = shipped.value[0]

        def make(batch: pa.RecordBatch, place: int) -> Iterator[tuple[int, pa.Array]]:
            texts = [None if not x.is_valid else "".join(decode_blocks(merges, x.values.to_numpy())) for x in batch.column(place)]
            yield 0, pa.array(texts, pa.string())

        return make

    return _with_column(rows, ids_col, free_name(rows, "decoded"), "string", text_of)


def round_trip(docs: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, same) of every row: its text encoded and the ids decoded again in one pass. Digests
    are of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8; same tells whether it is the text again."""
    shipped = _shipped(docs, ranks_file)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, classes = shipped.value
        encoder = TextEncoder(merges, classes)
        for batch in batches:
            for first, texts in slices(batch, "text", BATCH_CHARS):
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                digests, back, same = [], [], []
                for text, a, z in zip(texts, (ends - counts).tolist(), ends.tolist()):
                    own = ids[a:z]
                    digests.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    whole = "".join(decode_blocks(merges, own))
                    back.append(hashlib.sha256(whole.encode()).hexdigest())
                    same.append(whole == text)
                columns = [batch.column(0).slice(first, len(texts)), pa.array(counts), pa.array(digests), pa.array(back), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")

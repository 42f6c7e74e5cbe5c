import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from plumbline.llm import bytepairs

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = " '  \n\t strevmld'asSLe1é中\U0001f600.,!²x ́  \x1c9"


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return bytepairs.Merges(FILE)


@pytest.fixture(scope="module")
def classes():
    return bytepairs.char_classes()


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_pieces_are_the_matches_of_the_pattern(classes):
    texts = [t.replace("\x1c", "") for t in odd_texts(3000)]  # regex takes U+001C for white space, the library does not
    points = np.array([ord(c) for t in texts for c in t], np.uint32)
    first = np.zeros(len(points), bool)
    ends = np.cumsum([len(t) for t in texts])
    first[[e - len(t) for t, e in zip(texts, ends) if t]] = True
    want = [e - len(t) + m.start() for t, e in zip(texts, ends) for m in regex.finditer(public_tokenizers.PATTERN, t)]
    assert bytepairs.piece_starts(points, first, classes).tolist() == want


@pytest.mark.parametrize("states", [50, 400_000])
def test_ids_are_the_library_s(merges, classes, library, monkeypatch, states):
    monkeypatch.setattr(bytepairs, "KEPT_STATES", states)
    texts = [*odd_texts(2000, 2), "", "x" * 3000, "ab" * 200 + "中" * 100, " \n" * 300, "<|endoftext|>"]
    encoder = bytepairs.TextEncoder(merges, classes)
    for part in (texts[:1000], texts[1000:], []):
        ids, counts = encoder.encode(part)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])][:len(part)] == [library.encode_ordinary(t) for t in part]


def test_stream_tells_tokens_after_bounded_lookahead(merges, library):
    transducer = bytepairs.Transducer(merges)
    rng = random.Random(3)
    longest = int(merges.lengths.max())
    for word in [" thereafter", "antidisestablishmentarianism", "aaaaaaaaaaaaaaaaaaaaaaaaaa", "é中\U0001f600"] + ["".join(rng.choice("thereinats") for _ in range(80)) for _ in range(40)]:
        stream, told, data = bytepairs.PieceStream(transducer), [], word.encode()
        for i in range(len(data)):
            told += stream.feed(data[i:i + 1])
            assert i + 1 - merges.lengths[told].sum() <= 2 * longest
        assert told + stream.finish() == library._core_bpe.encode_single_piece(data)


def test_token_that_no_merges_lead_to(tmp_path):
    rows = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"xyz"]  # xyz has no halves among the tokens
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(rows)))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(rows)}, special_tokens={})
    encoder = bytepairs.TextEncoder(bytepairs.Merges(str(path)), bytepairs.char_classes())
    texts = ["xyz abc", "abc", "xyzab", "ab,bc,xyz"]
    ids, counts = encoder.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_utf8_comes_whole_from_parts(size):
    for data in ("aé中\U0001f600z".encode() * 3, b"\xe4\xb8", b"\xffa\xe0\x80\x80b\xf4\x90\x80\x80\xed\xa0\x80\xc3", bytes(range(256))):
        stream = bytepairs.Utf8Stream()
        parts = [stream.feed(data[i:i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + stream.finish() == data.decode("utf-8", "replace")


def test_documents_encode_and_decode(edges, edge_rows, no_docs, library):
    want = []
    for row in edge_rows:
        ids = library.encode_ordinary(row[1] or "")
        want.append((row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest(), True))
    got = [tuple(r) for r in bytepairs.round_trip(edges, FILE).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bytepairs.round_trip(no_docs, FILE).collect() == []
    both = bytepairs.decoded(bytepairs.encoded(edges.toDF(*["IDS" if c == "rep" else c for c in edges.columns]), FILE), FILE, "ids_").collect()
    assert sorted((r.doc_id, r.decoded) for r in both if r.doc_id is not None) == sorted((r[0], r[1] or "") for r in edge_rows if r[0] is not None)
    assert all(r["ids_"] == library.encode_ordinary(r["text"] or "") for r in both)

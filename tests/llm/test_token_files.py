import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plumbline.llm import repair

FILE = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("shard_ids", [50, 2_000_000])
def test_files_hold_every_id_in_order(edges, edge_rows, shard_ids):
    got = repair.token_files(edges, FILE, shard_ids=shard_ids).orderBy("start").collect()
    assert len(got) == len(edge_rows)
    at = 0
    left = [(r[0], zlib.crc32(np.array(i, "<u4").tobytes()), len(i)) for r in edge_rows for i in [plain_ids(r[1])]]
    for r in got:
        assert r.start == at
        at += r.n_tokens
        left.remove((r.doc_id, r.ids_crc32, r.n_tokens))
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert got[0].doc_id is None and known == sorted(known) and not left


def test_no_documents(no_docs):
    assert repair.token_files(no_docs, FILE).collect() == []


def test_words_encoded_apart_are_the_text_encoded_whole():
    texts = ["It's  the\tEND<|endoftext|> of \u00a0 it", "\u0130\u03a3 e\u0301 a\u0308\n\u0301b", "9,99 \u2028 1'll", ""]
    e = repair.WordEncoder(FILE, cached=2)
    for _ in range(2):
        ids, counts = e.encode(texts)
        assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == plain_ids(texts[0])[:-1]
        assert ids.tolist() == [i for t in texts for i in plain_ids(t)[:-1]]


def test_letters_and_the_marks_after_them_are_learned_apart():
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = ["abc abc. abc, abc!? \u00e9t\u00e9*** \u00e9t\u00e9. .,", "e\u0301! \u0130. abc's abc's. a1. 'll, don't! <|endoftext|>. </w> a</w>", " ".join(f"w{a}{b} {a}{b} {a}w{b}" for a in marks for b in marks), "x.\0 x\u00b2. \u2019. \u03a3. A. "]
    e = repair.WordEncoder(FILE)
    e.encode(texts[:1])
    assert sorted(e.known) == sorted(["abc", ".", ",", "!?", "\u00e9t\u00e9", "***", ".,"])
    for _ in range(2):
        ids, counts = e.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain_ids(t)[:-1] for t in texts]
    # what is learned has one number each
    assert sorted(e.known.values()) == list(range(len(e.lengths))) and len(e.flat) == e.lengths.sum()


@pytest.mark.parametrize("seed", range(4))
def test_grammar_expands_to_what_it_was_made_of(seed):
    rng = np.random.default_rng(seed)
    phrase = rng.integers(0, 50, 40)
    ids = np.concatenate([rng.integers(0, 50, rng.integers(0, 30)) if rng.random() < 0.5 else phrase for _ in range(200)] + [np.zeros(500, int)])
    last = rng.random(len(ids)) < 0.02
    g = repair.compress(ids, last, 50)
    assert len(g.sequence) < 0.5 * len(ids) and np.array_equal(repair.expand(g), ids)
    ends = np.cumsum(np.r_[np.ones(50, int), g.lengths][g.sequence])
    assert set(np.flatnonzero(last) + 1) <= set(ends)  # documents end at symbols
    for lo, hi in [(0, 1), (3, 700), (len(ids) - 2, len(ids)), (5, 5), (900, 10**9)]:
        assert np.array_equal(repair.expand(g, lo, hi), ids[lo:hi])


def test_copies_of_a_passage_are_replaced_whole():
    """All pairs of a repeated passage are equally frequent, and still rounds go on until the passage is one symbol or a few."""
    passage = np.random.default_rng(3).permutation(40_000)[:3000]
    ids = np.tile(passage, 50)
    last = np.zeros(len(ids), bool)
    last[2999::3000] = True
    g = repair.compress(ids, last, 40_000)
    assert len(g.sequence) <= 4 * 50 and g.lengths.max() >= 1000 and np.array_equal(repair.expand(g), ids)


def test_words_are_remembered_in_bounds_and_encoded_alike_after_some_are_forgotten():
    rng = np.random.default_rng(5)
    e, whole = repair.WordEncoder(FILE, cached=60), repair.WordEncoder(FILE)
    for _ in range(12):
        texts = [" ".join("w%dx" % i for i in rng.integers(0, 400, 30)) for _ in range(4)]
        for got, want in zip(e.encode(texts), whole.encode(texts)):
            assert got.tolist() == want.tolist()
        assert len(e.known) <= 60 + 120 and len(e.known) == len(e.lengths) and len(e.flat) == e.lengths.sum()

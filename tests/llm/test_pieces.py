import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece

from plumbline.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a", "a  ", "\n", "\nabc\n\n x", "a\tb", "\u65e5\u672c\u8a9e \U0001f600x", "\u00e9" * 100, "a" * 300, "   \n  ", "hello  world   foo", "The quick brown fox can't, won't \u2014 jump!"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(MODEL)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_without_dropout_it_is_the_library(vocabulary):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = split(*pieces.Encoder(MODEL, dropout=0.0).encode(TEXTS, np.zeros(len(TEXTS), int)))
    assert got == [sp.encode(t) for t in TEXTS]


def test_dropout_varies_and_is_lossless(vocabulary):
    texts = [*TEXTS, "x\u2581y \u2581 z", "\0\1 q"]
    seen = []
    for v in range(4):
        got = split(*pieces.Encoder(MODEL, dropout=0.3).encode(texts, np.full(len(texts), v)))
        assert [pieces.decode(vocabulary, i) for i in got] == texts
        seen.append(got[12])
    assert len({tuple(s) for s in seen}) > 1
    assert split(*pieces.Encoder(MODEL, dropout=0.3, cached=1).encode(texts, np.full(len(texts), 3)))[12] == seen[3]


@pytest.mark.parametrize("dropout", [0.0, 0.2, 1.0])
def test_rows_and_agenda_agree(vocabulary, dropout):
    units = list({u for t in TEXTS for u in pieces.Encoder.units(t)} | {"\u2581unbelievable", "internationalisation", "\u4e2d\u2581"})
    keys = pieces.Encoder(MODEL).key(2, pd.util.hash_array(np.array(units, dtype=object), categorize=False))
    flat, starts, lengths = pieces.segment(vocabulary, units, keys, dropout)
    for u, k, s, n in zip(units, keys, starts, lengths):
        if u[0] != "\n":
            assert flat[s:s + n].tolist() == pieces.agenda(vocabulary, u, int(k), dropout)


def test_documents(edges, edge_rows, no_docs):
    got = pieces.round_trip(edges, MODEL).collect()
    assert len(got) == len(edge_rows) and all(r.lossless and r.n_ids == len(r.ids) for r in got)
    back = pieces.decode_documents(pieces.encode_documents(edges, MODEL), MODEL).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(r[0]), r[1] or "") for r in edge_rows)
    assert pieces.round_trip(no_docs, MODEL).collect() == []


def test_each_occurrence_of_a_word_has_skips_of_its_own(vocabulary):
    e = pieces.Encoder(MODEL)
    text = " ".join(["international"] * 300)
    ids, counts = e.encode([text, text], np.array([5, 6]))
    one, two = split(ids, counts)
    assert one != two and all(pieces.decode(vocabulary, x) == text for x in (one, two))
    assert split(*e.encode([text], np.array([5])))[0] == one
    # the ways in which single occurrences are cut
    ways, word = set(), []
    for i in one:
        if vocabulary.pieces[i].startswith(pieces.MARK) and word:
            ways.add(tuple(word))
            word = []
        word.append(i)
    assert len(ways | {tuple(word)}) > 4


@pytest.mark.parametrize("dropout", [0.0, 0.3, 1.0])
def test_occurrences_share_what_skips_do_not_change(vocabulary, monkeypatch, dropout):
    units = list(dict.fromkeys(u for t in [*TEXTS, "x▁y"] for u in pieces.Encoder.units(t)))
    which = np.random.default_rng(3).permutation(np.repeat(np.arange(len(units)), 40))
    keys = pieces.Encoder(MODEL).key(np.arange(len(which)), pd.util.hash_array(np.array(units, dtype=object), categorize=False)[which])
    asked, find = [], pieces.Vocabulary.find
    monkeypatch.setattr(pieces.Vocabulary, "find", lambda self, a, b: asked.append(len(a)) or find(self, a, b))
    flat, starts, lengths = pieces.segment(vocabulary, units, keys, dropout, which)
    if dropout == 1.0:  # nothing is merged: each pair of each distinct unit is looked up once
        assert sum(asked) <= sum(len(u) - 1 for u in units)
    for w, k, s, n in zip(which, keys, starts, lengths):
        if units[w][0] != "\n":
            assert flat[s:s + n].tolist() == pieces.agenda(vocabulary, units[w], int(k), dropout)

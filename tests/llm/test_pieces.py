"""Viterbi pieces against the library's unigram lattice, and exact round trips."""

import time

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from spendtide.llm import sentencepieces as p

from test_dedup import documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pieces():
    return p.Pieces.load()


@pytest.fixture(scope="module")
def lattice():
    """The same pieces and scores in the library, with the model's type set to unigram."""
    raw = open(p.MODEL, "rb").read()
    at = raw.rindex(b"\x18\x02\x20\x80\xfa\x01")  # the fields model type and vocabulary size
    return sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2 :])


def test_best_paths(pieces, lattice):
    texts = duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet'").fetchall()
    words = sorted({w for t, in texts for w in t.split()})[::9]
    mine = p.encode_texts(pieces, words)
    score = lambda ids: float(pieces.scores[ids].sum())
    for word, ids in zip(words, mine):
        best = lattice.nbest_encode_as_ids(word, 2)[0]
        assert score(best) == score(ids)  # of equal sums either may come first
    assert sum(i.tolist() == lattice.nbest_encode_as_ids(w, 2)[0] for w, i in zip(words, mine)) > 0.99 * len(words)


def test_words_do_not_depend_on_their_text(pieces):
    text = "The quick  brown fox\n\tjumps over 12 lazy dogs. 中文 ok"
    whole = [pieces.texts[i] for i in p.encode_texts(pieces, [text])[0]]
    assert "".join(t for t in whole).replace("<0x0A>", "\n").replace("<0x09>", "\t") == (
        p.MARK + text.replace(" ", p.MARK)
    )
    long = ("abc def" * 40).replace(" ", "")
    assert p.encode_texts(pieces, [long, "x " + long])[1].tolist()[-len(long) // 8 :] == (
        p.encode_texts(pieces, [long])[0].tolist()[-len(long) // 8 :]
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="▁")), max_size=5))
def test_round_trip(texts):
    own = _round_trip_pieces()
    assert [p.decode_ids(own, r.tolist()) for r in p.encode_texts(own, texts)] == texts


def _round_trip_pieces(kept=[]):
    if not kept:
        kept.append(p.Pieces.load())
    return kept[0]


def test_long_words_are_cut_without_loss(pieces):
    text = "中" * 3000 + "ab" * 2000 + "é😀" * 50
    ids = p.encode_texts(pieces, [text])[0]
    assert p.decode_ids(pieces, ids.tolist()) == text
    short = text[2990:3010]
    assert p.decode_ids(pieces, p.encode_texts(pieces, [short])[0].tolist()) == short


def test_tables(spark):
    rows = [(1, "Hello  world\n"), (None, " lead"), (2, ""), (3, None), (4, "x" * 50_000), (1, "Hello  world\n"),
            (5, "a▁b")]
    found = p.encode(documents(spark, rows), check=True)
    got = found.collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert all(r.n_pieces == len(r.piece_ids) for r in got)
    back = {r.doc_id: r.text for r in p.decode(found).collect()}
    assert back == {1: "Hello  world\n", None: " lead", 2: "", 3: "", 4: "x" * 50_000, 5: "a b"}
    assert p.encode(documents(spark, [])).isEmpty()
    counts = p.encode(documents(spark, rows), ids=False)
    assert counts.columns == ["doc_id", "n_pieces"]


def test_a_long_unit_advances_alone(monkeypatch):
    """The same pieces in blocks as in one table, unknown characters and ties included."""
    pieces, rng = p.Pieces.load(), np.random.default_rng(1)
    for signs in ("abcdefgh", "aaaab", "漢字x🙂", "0123456789ABCDEF="):
        codes = p._codes("".join(rng.choice(list(signs), 700)))
        ids, many = p.viterbi(pieces, codes[None, :])
        whole = ids[0, len(codes) - many[0] :].tolist()
        for block in (3, 64, 10_000):
            monkeypatch.setattr(p, "_ALONE", block)
            assert p.viterbi_alone(pieces, codes).tolist() == whole, (signs, block)


def test_a_very_long_word_in_bounded_time():
    pieces, rng = p.Pieces.load(), np.random.default_rng(2)
    word = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/"), 400_000))
    start = time.perf_counter()
    (ids,) = p.encode_texts(pieces, [f"so {word} long"])
    assert time.perf_counter() - start < 20 and p.decode_ids(pieces, ids.tolist()) == f"so {word} long"

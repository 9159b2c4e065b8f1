"""Importance resampling: payload algebra, buckets and the draw against plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendtide.llm import importance

DOCS = "doc_id long, text string"


def plain_words(text):
    text = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def plain_buckets(text):
    words = plain_words(text)
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [zlib.crc32(g.encode()) % 10000 for g in grams]


def plain_sample(docs, target):
    found = [plain_buckets(t) for _, t in docs]
    s, t = Counter(b for f in found for b in f), Counter(b for x in target for b in plain_buckets(x))
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (t_all + 10000) / ((s[b] + 1) * (b_all + 10000))))
        for t_all, b_all in [(s.total(), t.total())] for b in s
    }
    rows = []
    for (key, text), buckets in zip(docs, found):
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        name = "" if key is None else key
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(buckets), weight, score, len(plain_words(text)) >= 20))
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = may[: 25 * len(may) // 100]
    return Counter([(*r[:4], k) for k, r in enumerate(drawn, 1)] + [(*r[:4], None) for r in may[len(drawn) :]]
                   + [(*r[:4], None) for r in rows if not r[4]])


TEXTS = st.text(st.sampled_from("abzAZ09 -\n\x00\x7fé漢😀ß"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6), st.integers(1, 25), st.lists(st.text("abz09é", min_size=1), max_size=8))
def test_buckets_of_any_texts(texts, block, words):
    dictionary = importance.Dictionary(sorted({w.encode() for w in words}))
    n_words, n_features, found = dictionary.buckets([t.encode() for t in texts], block)
    assert n_words.tolist() == [len(plain_words(t)) for t in texts]
    ends = np.cumsum(n_features)
    for text, start, end in zip(texts, ends - n_features, ends):
        assert sorted(found[start:end].tolist()) == sorted(plain_buckets(text))


def test_payloads_compose_at_any_length():
    words = [b"a", b"b" * 63, b"c" * 64, b"d" * 65, b"e" * 5000, b"f" * 70_000, "é".encode() * 33]
    crc, size = np.array([zlib.crc32(w) for w in words], np.uint32), np.array([len(w) for w in words])
    found = importance.Dictionary([]).pairs(crc, size)
    assert found.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]


def test_dictionary_names_the_frequent_words(spark):
    docs = spark.createDataFrame([(1, "the THE the cat"), (2, None), (3, "cat " + "x" * 100)], DOCS)
    assert importance.frequent_words(docs) == [b"the", b"cat"]


def test_dictionary_does_not_show_in_the_result(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "one two three " * k + "four") for k in range(9)], DOCS)
    target = spark.createDataFrame([("two three",)], "text string")
    full = importance.importance_sample(docs, target, least_words=1).collect()
    monkeypatch.setattr(importance, "frequent_words", lambda *a: [])
    assert sorted(full) == sorted(importance.importance_sample(docs, target, least_words=1).collect())


def test_draw_against_plain_loops(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["tide", "Spend", "élan", "漢字", "a1", "x" * 70, "rare"]
    docs = [(int(k), " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for k in range(150)]
    docs += [(None, "tide " * 30), (None, "rare " * 30), (7, "tide " * 30), (7, "tide " * 30), (900, None), (901, ""),
             (902, "tide, rare! " * 50_000)]
    target = ["tide tide rare", None, "", "élan tide"]
    found = importance.importance_sample(
        spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("id", "tie", "may", "n_words", "rank")}),
        spark.createDataFrame([(t,) for t in target], "text string"),
    )
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in found.collect()) == plain_sample(docs, target)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b " * 20)], DOCS)
    assert importance.importance_sample(none, some).collect() == []
    assert importance.importance_sample(none, none).collect() == []
    (row,) = importance.importance_sample(some, none).collect()
    assert Counter([tuple(row)]) == plain_sample([(1, "a b " * 20)], [])

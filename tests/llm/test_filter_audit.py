"""The filter audit against plain loops, and its one pass against plain string functions."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendtide.llm import filter_audit

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def plain_measure(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text),
            len(re.findall("[#$%&*|]", text))]


def plain_audit(docs, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    marked = []
    for key, text, lang in docs:
        n, distinct, capitals, points, symbols = plain_measure(text or "")
        fails = {
            letter for letter, failed in zip("ABCDE", (
                n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * points, symbols > 0,
                key is not None and key > first[text or ""],
            )) if failed
        }
        marked.append((lang or "", fails, key in good, key in toxic))
    rows, shapley = {}, Counter()
    for part in {m[0] for m in marked}:
        own = [m[1:] for m in marked if m[0] == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [m for m in own if letter in m[0] and not before & m[0]]
                shapley[part, letter] += len(here)
                rows[part, "".join(order), step] = [
                    sum(not (before | {letter}) & m[0] for m in own), len(here),
                    sum(letter in m[0] and bool(before & m[0]) for m in own),
                    sum(m[0] == {letter} for m in own),
                    sum(m[1] for m in here), sum(m[2] for m in here),
                ]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def audited(spark, docs, labels):
    found = filter_audit.filter_audit(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    )
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley",
    ]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


TEXTS = st.text(st.sampled_from("ab AB\n\t\x0b\x1f é漢😀#|"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=6), st.integers(1, 20))
def test_one_pass_counts_what_string_functions_count(texts, block):
    found = filter_audit.measure([t.encode() for t in texts], block)
    assert found.tolist() == [plain_measure(t) for t in texts]


def test_long_words_and_long_texts():
    long = "x" * 5000
    texts = [long + "a " + long + "b " + long + "a", "", "word " * 300_000, " ".join(map(str, range(50_000)))]
    for block in (1000, 4 << 20):
        assert filter_audit.measure([t.encode() for t in texts], block).tolist() == [plain_measure(t) for t in texts]


def test_words_with_the_same_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(
        filter_audit.Spans, "_hashes", lambda self, doc, start, size: np.zeros(len(start), np.uint64)
    )
    texts = ["a b a c b", "b a " + "y" * 100 + " " + "y" * 99 + "z " + "y" * 100]
    assert filter_audit.measure([t.encode() for t in texts])[:, 1].tolist() == [3, 4]


def test_audit_against_plain_loops(spark):
    rng = np.random.default_rng(5)
    many = " ".join(f"w{k}" for k in range(250))
    shapes = ["", None, "short", many, many + " #", many + " X" * 60, "same " * 300, "Same | " * 300, many + " |" * 300]
    docs = [(int(k), shapes[rng.integers(len(shapes))], ["en", "de", None, ""][rng.integers(4)]) for k in range(120)]
    docs += [(None, many, "en"), (None, many, "en"), (3, many, "en"), (3, many, None), (500, "once", "fr")]
    labels = [(int(k), int(rng.integers(2)), int(rng.integers(2))) for k in range(0, 130, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_empty_tables_and_other_columns(spark):
    assert audited(spark, [], []) == set()
    docs = [(1, "a", "en"), (2, "a", "en")]
    assert audited(spark, docs, []) == plain_audit(docs, [])
    wide = spark.createDataFrame(docs, DOCS).withColumns(
        {c: F.lit(7) for c in ("id", "n", "part", "fails", "digest", "good", "words", "step")}
    )
    found = filter_audit.filter_audit(wide, spark.createDataFrame([(2, 1, 0)], LABELS).withColumn("id", F.lit(1)))
    assert {tuple(r) for r in found.collect()} == plain_audit(docs, [(2, 1, 0)])


def test_every_order_adds_up(spark):
    docs = [(k, "A # " * (k % 3), "en") for k in range(30)]
    rows = audited(spark, docs, [])
    for order in {r[1] for r in rows}:
        steps = {r[2]: r for r in rows if r[1] == order}
        assert steps[5][3] == 30 - sum(r[4] for r in steps.values())

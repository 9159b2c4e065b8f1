"""Held-out accuracy and edge cases of the quality classifier."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendtide.llm import quality

from test_dedup import documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{FOLDER}/documents.parquet"),
            spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    found = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert len(found) == labels.count()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert (found.predicted == (found.score >= 0.3)).all() and found.score.between(0, 1).all()
    out = found[found.held_out]
    assert len(out) > 50 and (out.predicted == out.quality).mean() >= 0.95
    assert (out[out.quality == 1].score > 0.3).all()


def test_same_model_again(spark, tables):
    a, b = quality.train(*tables, rows=100), quality.train(*tables, rows=100)
    assert np.array_equal(a.margin, b.margin) and a.offset == b.offset
    assert len(a.vectors) == quality.BUCKETS


def test_edge_cases(spark, tables):
    model = quality.train(*tables)
    rows = [(1, None), (2, ""), (None, " \n"), (3, "the " * 100_000), (3, "A"), (4, "€%%% ###")]
    scored = quality.score(documents(spark, rows), model, "text", {"doc_id": "doc_id"}).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    bias = 1 / (1 + np.exp(-model.offset))
    assert [r.score for r in scored[:3]] == pytest.approx([bias] * 3)
    none = tables[1].limit(0)
    assert {r.score for r in quality.classify(documents(spark, rows), none).collect()} == {0.5}
    assert quality.classify(documents(spark, []), tables[1]).isEmpty()
    odd = spark.createDataFrame([(None, 1), (1, None), (3, 1), (3, 0)], "doc_id long, quality int")
    assert len(quality.classify(documents(spark, rows), odd).collect()) == len(rows)


def test_dropping_keeps_columns_and_clean_rows(spark, tables):
    docs, labels = tables
    more = docs.withColumn("score", F.lit(0)).withColumn("check", F.lit("x"))
    kept = quality.drop_rejected(more, labels)
    assert kept.columns == more.columns
    good = labels.where("quality = 1").join(docs, "doc_id")
    assert good.join(kept, "doc_id").count() >= 0.99 * good.count()
    bad = labels.where("quality = 0").join(docs, "doc_id")
    assert bad.join(kept, "doc_id").count() <= 0.1 * bad.count()


def test_repetition_is_a_feature():
    words = quality.Words()
    assert len(words.of(b"a a a b")) == 6 and len(words.of(b"a b a b")) == 4
    owner, bucket = words.features()
    assert set(owner) == {0, 1, 2} and bucket.max() < quality.BUCKETS


def plain_features(text):
    """Buckets of a text with how often each occurs, word by word."""
    found = {}
    words = text.split()
    for k, word in enumerate(words):
        single = quality.Words()
        single.of(word.encode())
        for bucket in single.features()[1].tolist():
            found[bucket] = found.get(bucket, 0) + 1
        if k and word == words[k - 1]:
            mark = quality.xxhash.xxh32_intdigest(quality._REPEAT) % quality.BUCKETS
            found[mark] = found.get(mark, 0) + 1 + quality._REPEAT_WEIGHT
            for bucket in empty_word():
                found[bucket] = found.get(bucket, 0) + 1
    return found


def empty_word():
    """The n-grams of the two word marks alone, which a repetition has as well."""
    two = quality.Words()
    two.of(b"a a")
    owner, bucket = two.features()
    mark = quality.xxhash.xxh32_intdigest(quality._REPEAT) % quality.BUCKETS
    return [b for o, b in zip(owner.tolist(), bucket.tolist()) if o == 1 and b != mark]


def plain_fit(documents, labels, steps):
    """The same descent by loops over documents and features."""
    rng = np.random.default_rng(0)
    size = quality.SIZE
    vectors = rng.uniform(-1 / size, 1 / size, (quality.BUCKETS, size))
    weights, biases, order = np.zeros((size, 2)), np.zeros(2), []
    for step in range(steps):
        if len(order) < quality.BATCH:
            order += rng.permutation(len(labels)).tolist()
        rows, order = order[: quality.BATCH], order[quality.BATCH :]
        rate = quality.RATE * (1 - step / steps)
        d_weights, d_biases, d_vectors = np.zeros((size, 2)), np.zeros(2), {}
        for r in rows:
            total = sum(documents[r].values())
            mean = sum((n / total * vectors[f] for f, n in documents[r].items()), np.zeros(size))
            out = np.exp(mean @ weights + biases)
            error = out / out.sum()
            error[labels[r]] -= 1
            d_weights += np.outer(mean, error)
            d_biases += error
            for f, n in documents[r].items():
                d_vectors[f] = d_vectors.get(f, 0) + n / total * (weights @ error)
        weights -= 4 * rate / len(rows) * d_weights
        biases -= rate / len(rows) * d_biases
        for f, d in d_vectors.items():
            vectors[f] -= rate * d
    return quality.Model(vectors, weights, biases)


TEXTS = ["good plain words here", "bad bad bad %%%", "plain words again and again again", "### bad $$$ bad", "été good words"] * 8


def test_descent_against_plain_gradients(monkeypatch):
    monkeypatch.setattr(quality, "BATCH", 7)
    docs, labels = [plain_features(t) for t in TEXTS], np.array([1, 0, 1, 0, 1] * 8)
    found = quality.fit(
        [np.array(list(d), np.int64) for d in docs], [np.array(list(d.values()), np.float32) for d in docs], labels, 60,
    )
    want = plain_fit(docs, labels, 60)
    assert np.allclose(found.weights, want.weights, atol=2e-4) and np.allclose(found.biases, want.biases, atol=2e-4)
    used = sorted({f for d in docs for f in d})
    assert np.allclose(found.vectors[used], want.vectors[used], atol=2e-4)
    assert found.weights.any() and (found.margin[list(docs[1])].mean() < found.margin[list(docs[0])].mean())


def test_features_and_scores_against_plain_sums(spark):
    rng = np.random.default_rng(4)
    model = quality.Model(
        rng.normal(size=(quality.BUCKETS, quality.SIZE)).astype(np.float32),
        rng.normal(size=(quality.SIZE, 2)).astype(np.float32), np.array([0.25, -0.5], np.float32),
    )
    texts = [*TEXTS[:5], "a", "a a", "a a a", "漢字 漢字 x", " \n ", "one\ttwo\n one"]
    rows = quality.feature_counts(documents(spark, list(enumerate(texts))), "text", {"doc_id": "doc_id"}).collect()
    scores = quality.score(documents(spark, list(enumerate(texts))), model, "text", {"doc_id": "doc_id"}).collect()
    for row, scored in zip(sorted(rows, key=lambda r: r.doc_id), sorted(scores, key=lambda r: r.doc_id)):
        want = plain_features(texts[row.doc_id])
        found = dict(zip(np.frombuffer(row.features, np.int32).tolist(), np.frombuffer(row.counts, np.float32).tolist()))
        assert found == want, texts[row.doc_id]
        total = sum(want.values())
        mean = sum((n / total * model.vectors[f].astype(float) for f, n in want.items()), np.zeros(quality.SIZE))
        out = mean @ model.weights.astype(float) + model.biases
        assert scored.score == pytest.approx(1 / (1 + np.exp(out[0] - out[1])), abs=1e-5)


def test_repeated_ids_are_learned_from_once(spark):
    rows = [(1, "one text"), (1, "another text"), (1, "one text"), (2, "third"), (4, "fourth")] * 3
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0), (1, 1)], "doc_id long, quality int")
    once = {k: min((r[1] for r in rows if r[0] == k)) for k in (2, 4)}
    first = [quality.train(documents(spark, rows).repartition(n), labels) for n in (1, 7)]
    assert np.array_equal(first[0].margin, first[1].margin) and once
    either = [quality.train(documents(spark, [(1, t), (2, "third"), (4, "fourth")]), labels) for t in ("one text", "another text")]
    assert any(np.array_equal(first[0].margin, m.margin) for m in either)

"""Quality classifier on supervised subword embeddings.

Every word stands for some hashed features: the word itself, its character n-grams
between word marks, and a mark where it repeats the word before it. Each feature has a
learned vector; a document is the mean of all its features' vectors, and a softmax over
the two labels sits on top. Training is stochastic gradient descent in numpy on the
driver, over the features of at most ``TRAINING_ROWS`` labelled rows, the ones with the
smallest hash of their id, so memory and time are bounded however many labels there are.

The output of a document is linear in the mean, so tasks get one number per hash bucket
(the difference of the two outputs) instead of the vectors, and a word's features are
summed once per slice of documents and reused wherever the word stands.

Defined results: null and empty texts have no features and get the score of the bias;
rows with a null id or a null label are never learned from; null and repeated ids are
scored row by row; without a label of either kind every score is 0.5; columns other than
ids, texts and labels are never read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendtide.llm.texts import drop_rows, map_texts, with_key
from spendtide.plans.materialize import materialize

BUCKETS, SIZE, NGRAMS = 1 << 17, 8, (2, 3, 4)
TRAINING_ROWS, STEPS, BATCH, RATE = 4000, 1000, 64, 0.5
KEEP_FROM = 0.3
_REPEAT, _REPEAT_WEIGHT = b"\x00repeat", 16


@dataclass(frozen=True)
class Model:
    """Bucket vectors, softmax weights and biases of the labels 0 and 1."""

    vectors: np.ndarray
    weights: np.ndarray
    biases: np.ndarray

    @property
    def margin(self) -> np.ndarray:
        """Output 1 minus output 0 of a single feature, by bucket."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)

    @property
    def offset(self) -> float:
        return float(self.biases[1] - self.biases[0])


class Words:
    """Numbers for words in the order they are first seen."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = defaultdict(lambda: len(self.number))

    def of(self, text: bytes) -> np.ndarray:
        """The text's words, each repetition of the word before it as the mark as well."""
        parts = text.split()
        found = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        repeats = int(np.count_nonzero(found[1:] == found[:-1]))
        if repeats:
            mark = np.full(repeats, self.number[_REPEAT], np.int64)
            found = np.concatenate([found, mark])
        return found

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(word number, bucket) of every feature of every word, in no order."""
        words = list(self.number)
        whole = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.int64, len(words))
        owner, bucket = [np.arange(len(words))], [whole % BUCKETS]
        if _REPEAT in self.number:  # weighs as much as a word
            mark = np.full(_REPEAT_WEIGHT, self.number[_REPEAT], np.int64)
            owner.append(mark)
            bucket.append(whole[mark] % BUCKETS)
            words[self.number[_REPEAT]] = b""
        marked = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        for n in NGRAMS:
            if len(chars) < n:
                continue
            starts = len(of) - n + 1
            key = np.full(starts, n, np.uint32)
            for k in range(n):
                key ^= chars[k : k + starts]
                key *= np.uint32(0x9E3779B1)
                key ^= key >> np.uint32(15)
            inside = of[:starts] == of[n - 1 :]
            owner.append(of[:starts][inside])
            bucket.append((key[inside] % np.uint32(BUCKETS)).astype(np.int32))
        return np.concatenate(owner), np.concatenate(bucket)


def held_out(id_column: Column) -> Column:
    """Rows kept out of training: CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def feature_counts(docs: DataFrame, text_col: str, keep: dict[str, str]) -> DataFrame:
    """``keep`` with the distinct features of each text and how often each occurs, as the
    bytes of 32-bit numbers."""

    def work(texts: list[bytes]) -> dict[str, pa.Array]:
        words = Words()
        rows = [words.of(t) for t in texts]
        owner, flat = words.features()
        flat = flat[np.argsort(owner, kind="stable")]
        begin = np.append(0, np.cumsum(np.bincount(owner, minlength=len(words.number))))
        features, counts = [], []
        for row in rows:
            number, times = np.unique(row, return_counts=True)
            size = begin[number + 1] - begin[number]
            at = np.repeat(begin[number] - np.cumsum(size) + size, size) + np.arange(size.sum())
            own, where = np.unique(flat[at], return_inverse=True)
            features.append(own.astype(np.int32).tobytes())
            times = np.bincount(where, np.repeat(times, size))
            counts.append(times.astype(np.float32).tobytes())
        return {
            "features": pa.array(features, pa.binary()), "counts": pa.array(counts, pa.binary())
        }

    return map_texts(docs, text_col, keep, work, "features binary, counts binary", most=2 << 20)


def fit(
    features: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray,
    steps: int = STEPS, seed: int = 0,
) -> Model:
    """Gradient descent on the cross entropy, some documents a step, falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    weights, biases = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(vectors, weights, biases)
    shares = [c / max(1.0, c.sum()) for c in counts]
    order = np.empty(0, np.int64)
    for step in range(steps):
        if len(order) < BATCH:  # every document comes once before any comes again
            order = np.concatenate([order, rng.permutation(len(labels))])
        rows, order = order[:BATCH], order[BATCH:]
        rate = RATE * (1 - step / steps)
        flat = np.concatenate([features[r] for r in rows])
        share = np.concatenate([shares[r] for r in rows]).astype(np.float32)
        owner = np.repeat(np.arange(len(rows)), [len(features[r]) for r in rows])
        parts = vectors[flat]
        means = np.stack(
            [np.bincount(owner, parts[:, k] * share, len(rows)) for k in range(SIZE)], axis=1
        )
        out = means @ weights + biases
        out = np.exp(out - out.max(axis=1, keepdims=True))
        error = out / out.sum(axis=1, keepdims=True)
        error[np.arange(len(rows)), labels[rows]] -= 1
        back = rate * error @ weights.T
        weights -= (4 * rate / len(rows) * means.T @ error).astype(np.float32)
        biases -= (rate / len(rows) * error.sum(axis=0)).astype(np.float32)
        for k in range(SIZE):
            vectors[:, k] -= np.bincount(flat, back[owner, k] * share, BUCKETS).astype(np.float32)
    return Model(vectors, weights, biases)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAINING_ROWS,
) -> Model:
    """A model from the labelled rows of ``docs`` that are not held out.

    At most ``rows`` labelled ids are used, those with the smallest hash. An id with
    labels of both kinds counts as the smaller one, one with several texts as that with the
    smallest hash.
    """
    picked = (
        labels.select(F.col(id_col).alias("key"), F.col(label_col).alias("label"))
        .where(F.col("key").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("key")))
        .groupBy("key").agg(F.min("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(picked), "key").groupBy("key", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    )
    found = feature_counts(chosen, "text", {"key": "key", "label": "label"})
    held = sorted(found.toLocalIterator(), key=lambda r: r.key)
    return fit(
        [np.frombuffer(r.features, np.int32) for r in held],
        [np.frombuffer(r.counts, np.float32) for r in held],
        np.array([r.label for r in held], np.int64),
    )


def score(docs: DataFrame, model: Model, text_col: str, keep: dict[str, str]) -> DataFrame:
    """``keep`` and the score of every text, the probability of label 1."""
    margin, offset = model.margin, model.offset

    def work(texts: list[bytes]) -> dict[str, pa.Array]:
        words = Words()
        rows = [words.of(t) for t in texts]
        owner, flat = words.features()
        sums, sizes = np.bincount(owner, margin[flat]), np.bincount(owner)
        out = np.fromiter(
            ((sums[r].sum() / sizes[r].sum() if len(r) else 0.0) for r in rows),
            np.float64, len(rows),
        )
        return {"score": pa.array(1 / (1 + np.exp(-(out + offset))))}

    return map_texts(docs, text_col, keep, work, "score double", most=4 << 20)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score and predicted (score >= 0.3)."""
    scored = score(docs, train(docs, labels, id_col, text_col), text_col, {id_col: id_col})
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


def drop_rejected(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.3, all columns as they were."""
    model = train(docs, labels, id_col, text_col)
    scored = score(with_key(docs, id_col, text_col), model, text_col, {"id": "id", "check": "check"})
    rejected = scored.where(F.col("score") < KEEP_FROM).select("id", "check").distinct()
    return drop_rows(docs, materialize(rejected, "rejected"), id_col, text_col)

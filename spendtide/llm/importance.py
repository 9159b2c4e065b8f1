"""Documents drawn by importance weights towards the distribution of target texts.

Features are words and pairs of neighbouring words, hashed to buckets by CRC-32. A
dictionary of the words that the corpus uses most is an Aho-Corasick automaton over the
words with a blank on either side, so a match is always one whole word and neighbours share
a blank. Each entry's payload is its CRC and its length. A scan emits the payloads along the
text, and two neighbours' payloads compose to the CRC of the pair: the first one's CRC is
moved on by the other's length (a linear map of 32 bits, from tables) and added to the
other's. No pair is ever built as a string. Words outside the dictionary, found as the
places without a match, get the same payload from their bytes, so the dictionary's choice
shows in the time only, never in a result.

The buckets of every document are stored once, two bytes a feature; the corpus' and the
target's bucket counts are sums over them, and weights are looked up by them.

Defined results: a null text has no words; a null id draws like an empty one and comes last
among equal scores; rows that share an id count and draw one by one; an empty table gives
an empty result, an empty target counts no feature; extra columns are never read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendtide.llm.texts import as_bytes, map_texts, slices
from spendtide.operators.numbering import number_rows
from spendtide.plans.materialize import materialize

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Most words of the dictionary, and most bytes of one.
ENTRIES, LONGEST = 16_384, 64
BLOCK = 1 << 20

#: Letters and digits stay, A-Z lower-cased, bytes of longer characters too; a blank else.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def _moved(crc: np.ndarray) -> np.ndarray:
    """The CRC register after one more zero byte."""
    low = crc & np.uint32(255)
    for _ in range(8):
        low = (low >> np.uint32(1)) ^ np.where(low & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return low ^ (crc >> np.uint32(8))


def _through(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map that ``tables`` (4 x 256, by byte of the register) state."""
    found = tables[0][crc & np.uint32(255)]
    for k in range(1, 4):
        found = found ^ tables[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return found


class Shift:
    """Moves CRCs on by numbers of bytes: below 64 by one table each, more by powers of two."""

    def __init__(self) -> None:
        one = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        steps = [one]
        for _ in range(64):
            steps.append(_moved(steps[-1]))
        self._short, self._powers = np.stack(steps[:64]), [steps[64]]

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        low = size & 63
        found = self._short[low, 0, crc & np.uint32(255)]
        for k in range(1, 4):
            found = found ^ self._short[low, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
        more, k = size >> 6, 0
        while more.any():
            if k == len(self._powers):
                self._powers.append(_through(self._powers[-1], self._powers[-1]))
            which = np.flatnonzero(more & 1)
            found[which] = _through(self._powers[k], found[which])
            more, k = more >> 1, k + 1
        return found


class Dictionary:
    """The automaton of some words, whose payloads compose to those of pairs."""

    def __init__(self, words: list[bytes]) -> None:
        self._crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self._size = np.array([len(w) for w in words], np.int64)
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, word in enumerate(words):
            self._automaton.add_word(f" {word.decode('latin-1')} ", k)
        if words:
            self._automaton.make_automaton()
        self._shift = Shift()
        self._blank = np.uint32(zlib.crc32(b" "))

    def payloads(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, CRC and length of every word; ``data`` begins and ends with a blank."""
        inside = np.frombuffer(data, np.uint8) != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        crc, size = np.zeros(len(starts), np.uint32), np.zeros(len(starts), np.int64)
        if len(self._crc):
            # One character a byte; a match ends on the blank behind its word.
            found = self._automaton.iter(data.decode("latin-1"))
            found = np.fromiter(chain.from_iterable(found), np.int64)
            word = np.searchsorted(ends, found[::2])
            crc[word], size[word] = self._crc[found[1::2]], self._size[found[1::2]]
        rest = np.flatnonzero(size == 0)
        size[rest] = ends[rest] - starts[rest]
        crc[rest] = [zlib.crc32(data[s:e]) for s, e in zip(starts[rest].tolist(), ends[rest].tolist())]
        return starts, crc, size

    def pairs(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The CRC of every word, a blank and its successor."""
        first = self._shift(crc[:-1], np.ones(max(len(crc) - 1, 0), np.int64)) ^ self._blank
        return self._shift(first, size[1:]) ^ crc[1:]

    def buckets(self, texts: list[bytes], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, features of each text, and the features' buckets in the order
        of the texts."""
        data = b" " + b" ".join(t.translate(WORD_BYTES) for t in texts) + b" "
        ends = np.cumsum([len(t) + 1 for t in texts])
        made, owners = [], []
        words = np.zeros(len(texts), np.int64)
        # The last word of a block is the first neighbour of the next one.
        held = (np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64))
        at = 0
        while at < len(data) - 1:
            stop = min(at + block, len(data) - 1)
            stop = data.find(b" ", stop)
            starts, crc, size = self.payloads(data[at : stop + 1])
            doc = np.searchsorted(ends, starts + at, "left")
            words += np.bincount(doc, minlength=len(texts))
            made.append((crc % BUCKETS).astype(np.uint16))
            owners.append(doc)
            doc, crc, size = (np.append(a, b) for a, b in zip(held, (doc, crc, size)))
            same = np.flatnonzero(doc[1:] == doc[:-1])
            made.append((self.pairs(crc, size)[same] % BUCKETS).astype(np.uint16))
            owners.append(doc[same])
            held = (doc[-1:], crc[-1:], size[-1:])
            at = stop
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        found = np.concatenate(made) if made else np.empty(0, np.uint16)
        order = np.argsort(owner, kind="stable")
        return words, np.bincount(owner, minlength=len(texts)), found[order]


@lru_cache(maxsize=1)
def dictionary_of(words: tuple[bytes, ...]) -> Dictionary:
    """The dictionary, made once in each Python worker."""
    return Dictionary(list(words))


def frequent_words(docs: DataFrame, text_col: str = "text") -> list[bytes]:
    """At most ``ENTRIES`` words, the most frequent of those that make up at least one in
    ``ENTRIES`` of the words of some slice of texts; each slice names at most that many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK):
                counts: Counter[bytes] = Counter()
                for text in as_bytes(part.column("text")):
                    counts.update(text.translate(WORD_BYTES).split())
                least = counts.total() / ENTRIES
                found = [(w, n) for w, n in counts.items() if n >= least and len(w) <= LONGEST]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())],
                    ["word", "n"],
                )

    text = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = text.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # Stored, so that the best of every partition meet in a task and not on the driver.
    best = materialize(counts.orderBy(F.desc("n"), "word").limit(ENTRIES), "dictionary")
    return [bytes(r.word) for r in best.orderBy(F.desc("n"), "word").collect()]


def features(
    docs: DataFrame, words: list[bytes], text_col: str = "text", **keep: str
) -> DataFrame:
    """(n_words, n_features, buckets) of every row beside the columns that ``keep`` names
    (new name to old); ``buckets`` holds two bytes a feature."""
    entries = tuple(words)

    def work(texts: list[bytes]) -> dict[str, pa.Array]:
        n_words, n_features, found = dictionary_of(entries).buckets(texts)
        ends = np.append(0, np.cumsum(2 * n_features)).astype(np.int64)
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(found)]
        )
        return {
            "n_words": pa.array(n_words), "n_features": pa.array(n_features),
            "buckets": packed.cast(pa.binary()),
        }

    schema = "n_words long, n_features long, buckets binary"
    return map_texts(docs, text_col, {old: new for new, old in keep.items()}, work, schema, BLOCK)


def _packed(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("buckets").to_pylist()), np.uint16)


def bucket_counts(stored: DataFrame) -> np.ndarray:
    """Features in each bucket, summed in every task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            total += np.bincount(_packed(batch), minlength=BUCKETS)
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], ["bucket", "n"])

    counts = stored.select("buckets").mapInArrow(run, "bucket long, n long")
    total = np.zeros(BUCKETS, np.int64)
    # One row per bucket.
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: a thousand times the logarithm of its share in the target by its
    share in the corpus, one more feature counted in every bucket; rounded down."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    """The columns of ``stored`` but its buckets, and each row's mean gain, rounded down."""
    names = [c for c in stored.columns if c != "buckets"]
    kinds = dict(stored.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_features").to_numpy()
            total = np.append(0, np.cumsum(gain[_packed(batch)]))
            ends = np.cumsum(n)
            weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(weight)], names + ["weight"]
            )

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names)
    return stored.mapInArrow(run, f"{schema}, weight long")


def _noise(key: Column) -> Column:
    """A thousand times a Gumbel draw that the key's hash names, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_sample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Every row's id, n_features, weight, score and rank; those with a rank are drawn:
    ``percent`` of the rows with ``least_words`` words or more, the highest scores."""
    words = frequent_words(docs, text_col)
    stored = materialize(features(docs, words, text_col, id=id_col), "features")
    corpus = bucket_counts(stored)
    wanted = bucket_counts(features(target, words, target_col))
    scored = weights(stored, gains(corpus, wanted)).withColumns({
        "score": F.col("weight") + _noise(F.col("id")),
        "may": F.col("n_words") >= least_words,
        "tie": F.monotonically_increasing_id(),
    })
    scored = materialize(scored, "scores")
    drawn = scored.where("may").count() * percent // 100
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("id"), F.asc("tie")]
    place = F.col("place") + 1
    return number_rows(scored, order, "place").select(
        F.col("id").alias(id_col), "n_features", "weight", "score",
        F.when(F.col("may") & (place <= drawn), place).alias("rank"),
    )

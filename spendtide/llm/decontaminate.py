"""Benchmark passages in documents, by CGK embedding and bit-sampling LSH.

Texts are words: ASCII letters lower-cased, other ASCII signs than letters and digits
taken as blanks. A document holds a benchmark item if some stretch of its words is
within ``edits = floor((1 - SIMILARITY) * words)`` word insertions, deletions and
substitutions of the item.

Item-sized windows of a document are embedded by CGK's random walk: a step writes the
current word and moves on or not, as a random bit of (step, word) says, so that few edits
become few differing places. Each of ``tables`` hash tables has a walk of its own and
samples ``SAMPLED`` places; items are filed by their length and the words there, windows are
looked up, an item in a window's bucket is a candidate, and an exact edit distance decides. ``tables`` is the smallest number that
finds the share ``RECALL`` of copies with the largest number of edits, measured for
each such number on the shortest item that has it, edited at random with a fixed seed;
unedited copies always agree.

A window can only reach an item if it shares enough of its word q-grams on neighbouring
diagonals (an edit breaks q of them, so at least ``words - q + 1 - q * edits`` are left).
Places where no item reaches that bound are not embedded; elsewhere windows of that item's
length are, and all items are looked up. The bound loses nothing. It is tested in stretches
of text with about ``ANCHORS`` shared q-grams each, which overlap by the longest item.

Items are read in blocks of ``BLOCK``, each block a pass over the documents, so what a
task gets is bounded however many items there are.

Defined results: null or empty texts and items hold nothing; null and repeated ids keep
their matches; items without a word never match; an empty table gives an empty result;
columns other than ids and texts are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.llm.texts import as_bytes, drop_rows, slices
from spendtide.plans.materialize import materialize

SIMILARITY, RECALL, SAMPLED, BLOCK = 0.8, 0.99, 3, 5000
_TRIALS, _MOST_TABLES, _GRAM, _WINDOWS = 200, 512, 3, 20_000
#: Shared q-grams that are held at a time, more only where one item-sized stretch has more.
ANCHORS = 1_000_000

#: Item ids of other types are returned as text.
_ITEM_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
_BLANKS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BLANKS).split()


def edits_allowed(words: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * words + 1e-9)


def _gram(words: int, edits: int) -> int:
    """Length of word runs of which at least one survives ``edits`` edits."""
    return max(1, min(_GRAM, -(-(words - edits) // (edits + 1))))


def embed(windows: np.ndarray, sizes: np.ndarray, table: int) -> np.ndarray:
    """Walks of rows of word codes (not 0); a row is ``sizes`` long, with 0 behind."""
    rows, longest = windows.shape
    padded = np.concatenate([windows, np.zeros((rows, 1), windows.dtype)], axis=1)
    at, out = np.zeros(rows, np.int64), np.empty((rows, 3 * longest), windows.dtype)
    every = np.arange(rows)
    for step in range(3 * longest):
        word = padded[every, at]
        out[:, step] = word
        salt = np.uint64((table * 0x9E3779B97F4A7C15 + step * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1)
        bit = ((word.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) ^ salt
        bit = (bit ^ (bit >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        at = np.minimum(at + (bit >> np.uint64(63)).astype(np.int64), sizes)
    return out


def sampled_places(size: int, table: int, sampled: int = SAMPLED) -> np.ndarray:
    """Places of the walk of ``size`` words, as often the same one as there are too few."""
    return np.random.default_rng([size, table]).choice(3 * size, sampled, replace=3 * size < sampled)


def _edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """An item-sized window on the item after ``edits`` random edits by unknown words."""
    words = list(item)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(max(1, len(words))))
        new = int(rng.integers(1 << 29, 1 << 30))
        if kind == 0:
            words.insert(at, new)
        elif kind == 1 and len(words) > 1:
            del words[at]
        elif words:
            words[at] = new
    words += [int(x) for x in rng.integers(1 << 29, 1 << 30, len(item))]
    return np.array(words[: len(item)], np.int64)


def tables_needed(item: np.ndarray, edits: int, recall: float = RECALL) -> int:
    """Tables that find the share ``recall`` of copies with ``edits`` edits."""
    if not edits:
        return 1
    rng = np.random.default_rng([len(item), edits])
    left = np.stack([_edited(item, edits, rng) for _ in range(_TRIALS)])
    row, size, allowed = item[None, :], np.array([len(item)]), int(_TRIALS * (1 - recall))
    for table in range(_MOST_TABLES):
        places = sampled_places(len(item), table)
        left = left[(embed(left, size, table) != embed(row, size, table))[:, places].any(1)]
        if len(left) <= allowed:
            return table + 1
    raise ValueError(f"{_MOST_TABLES} tables do not find {recall} of copies with {edits} edits")


def distance_within(item: list[int], text: list[int], edits: int) -> tuple[int, int] | None:
    """Least edit distance of ``item`` to a stretch of ``text`` and where that ends.

    Rows of the table as bits of one number (Myers); None beyond ``edits``.
    """
    size = len(item)
    full, top, places = (1 << size) - 1, 1 << (size - 1), {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    plus, minus, score, best = full, 0, size, None
    for end, word in enumerate(text, 1):
        same = places.get(word, 0)
        x = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up, down = minus | ~(across | plus) & full, plus & across
        score += 1 if up & top else -1 if down & top else 0
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(x | up) & full, up & x
        if score <= edits and (best is None or score < best[0]):
            best = (score, end)
    return best


@dataclass
class Items:
    """A block of benchmark items, ready for a task."""

    ids: list
    words: list[np.ndarray]
    codes: dict[bytes, int]
    tables: dict[int, int]
    similarity: float
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(
        default_factory=dict
    )
    buckets: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(w) for w in self.words], np.int64)

    @cached_property
    def by_size(self) -> dict[int, np.ndarray]:
        """The items of each length."""
        order = np.argsort(self.sizes, kind="stable")
        sizes, first = np.unique(self.sizes[order], return_index=True)
        return dict(zip(sizes.tolist(), np.split(order, first[1:])))

    def table_count(self, size: int) -> int:
        return self.tables[edits_allowed(size, self.similarity)]

    def bucket(self, table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash table of the items of ``size`` words: sorted keys, and their items."""
        if (table, size) not in self.buckets:
            own = self.by_size[size]
            rows = np.stack([self.words[k] for k in own])
            keys = _bucket_keys(embed(rows, np.full(len(own), size), table), size, table)
            order = np.argsort(keys, kind="stable")
            self.buckets[table, size] = keys[order], own[order]
        return self.buckets[table, size]

    def look_up(self, windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of every item that stands in the bucket of a window, in any of the
        tables of that length."""
        found = []
        for table in range(self.table_count(size)):
            keys, own = self.bucket(table, size)
            probe = _bucket_keys(embed(windows, np.full(len(windows), size), table), size, table)
            lo, hi = np.searchsorted(keys, probe, "left"), np.searchsorted(keys, probe, "right")
            many = hi - lo
            entry = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
            found.append(np.stack([np.repeat(np.arange(len(windows)), many), own[entry]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]

    @classmethod
    def build(cls, rows: list[tuple[object, bytes]], similarity: float) -> "Items":
        codes: dict[bytes, int] = {}
        ids, words = [], []
        for name, text in rows:
            if own := words_of(text):
                ids.append(name)
                words.append(np.array([codes.setdefault(w, len(codes) + 1) for w in own], np.int64))
        made = cls(ids, words, codes, {}, similarity)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for own in sorted(words, key=len):  # the shortest item with as many edits is the hardest
            edits = edits_allowed(len(own), similarity)
            if edits not in made.tables:
                made.tables[edits] = tables_needed(own, edits)
        for k, own in enumerate(words):
            edits = edits_allowed(len(own), similarity)
            gram = _gram(len(own), edits)
            for at, key in enumerate(made.keys(own, gram)):
                found.setdefault(gram, []).append((int(key), k, at))
        for gram, entries in found.items():
            entries.sort()
            keys = np.array([e[0] for e in entries], np.int64)
            unique, first = np.unique(keys, return_index=True)
            made.grams[gram] = (
                unique, np.append(first, len(keys)),
                np.array([e[1] for e in entries]), np.array([e[2] for e in entries]),
            )
        return made

    def keys(self, words: np.ndarray, gram: int) -> np.ndarray:
        """Numbers of the word runs of length ``gram``; -1 where a word is unknown."""
        base, runs = len(self.codes) + 1, len(words) - gram + 1
        if runs <= 0:
            return np.empty(0, np.int64)
        key, known = np.zeros(runs, np.int64), np.ones(runs, bool)
        for k in range(gram):
            part = words[k : k + runs]
            key, known = key * base + part, known & (part > 0)
        return np.where(known, key, -1)


def _bucket_keys(walks: np.ndarray, size: int, table: int) -> np.ndarray:
    """One number for the words of each walk at the table's sampled places."""
    key = np.full(len(walks), size, np.uint64)
    for place in sampled_places(size, table):
        key = (key ^ walks[:, place].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _hits(items: Items, words: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``words`` whose run of ``gram`` words some item has, and its number."""
    unique = items.grams[gram][0]
    keys = items.keys(words, gram)
    at = np.flatnonzero(keys >= 0)
    place = np.minimum(np.searchsorted(unique, keys[at]), len(unique) - 1)
    hit = unique[place] == keys[at]
    return at[hit], place[hit]


def _stretches(items: Items, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item, diagonal) of the word runs that an item and the text share, in stretches of the
    text that overlap by what one copy takes."""
    hits = {gram: _hits(items, words, gram) for gram in items.grams}
    at = np.concatenate([a for a, _ in hits.values()] or [np.empty(0, np.int64)])
    many = np.concatenate(
        [np.diff(items.grams[g][1])[place] for g, (_, place) in hits.items()] or [np.empty(0, np.int64)]
    )
    if not len(at):
        return
    order = np.argsort(at, kind="stable")
    at, many = at[order], np.cumsum(many[order])
    longest = int(items.sizes.max())
    reach = longest + 2 * edits_allowed(longest, items.similarity) + 1
    begin = int(at[0])
    while begin <= at[-1]:
        first = int(np.searchsorted(at, begin))
        before = int(many[first - 1]) if first else 0
        stop = int(at[min(int(np.searchsorted(many, before + ANCHORS)), len(at) - 1)])
        end = max(stop, begin + 2 * reach)
        who, where = [], []
        for gram, (places, runs) in hits.items():
            _, lead, owner, offset = items.grams[gram]
            own = slice(*np.searchsorted(places, [begin, end + 1]))
            place, run = places[own], runs[own]
            count = lead[run + 1] - lead[run]
            entry = np.repeat(lead[run] - np.cumsum(count) + count, count) + np.arange(count.sum())
            who.append(owner[entry])
            where.append(np.repeat(place, count) - offset[entry])
        yield np.concatenate(who), np.concatenate(where)
        if end >= at[-1]:
            return
        begin = end - reach


def _near(items: Items, who: np.ndarray, where: np.ndarray) -> dict[int, np.ndarray]:
    """By length the starts of windows that can be within the edits of an item of it."""
    order = np.lexsort((where, who))
    who, where = who[order], where[order]
    at = np.flatnonzero(np.diff(who, prepend=-1))
    found: dict[int, list[np.ndarray]] = {}
    for lo, hi in zip(at, np.append(at[1:], len(who))):
        diagonals, size = where[lo:hi], len(items.words[int(who[lo])])
        edits = edits_allowed(size, items.similarity)
        gram = _gram(size, edits)
        least = max(1, size - gram + 1 - gram * edits)
        if hi - lo < least:
            continue
        # Diagonals of one copy lie within twice the edits: is there such a stretch?
        dense = np.searchsorted(diagonals, diagonals + 2 * edits, "right") - np.arange(hi - lo) >= least
        # The first of them is at most the edits away from the copy's start.
        lead = np.unique(diagonals[dense])
        if len(lead):
            near = lead[:, None] + np.arange(-edits, edits + 1)
            found.setdefault(size, []).append(np.unique(near))
    return {size: np.unique(np.concatenate(starts)) for size, starts in found.items()}


def search(
    items: Items, words: np.ndarray, starts: np.ndarray, similarity: float
) -> list[tuple[int, int, int, int]]:
    """(document, item, edits, last word) in documents that lie one after the other in
    ``words`` (0: a word that no item has), each from its entry of ``starts``."""
    starts_of: dict[int, list[np.ndarray]] = {}
    for who, where in _stretches(items, words):
        for size, near in _near(items, who, where).items():
            starts_of.setdefault(size, []).append(near)
    pairs = [np.empty((0, 2), np.int64)]
    for size, near in starts_of.items():
        near = np.unique(np.concatenate(near))
        for k in range(0, len(near), _WINDOWS):
            window, item = items.look_up(_windows(words, near[k : k + _WINDOWS], size), size)
            pairs.append(np.stack([item, near[k : k + _WINDOWS][window]], axis=1))
    who, near = np.unique(np.concatenate(pairs), axis=0).T
    found = []
    cut = np.flatnonzero((np.diff(who) != 0) | (np.diff(near) > 1)) + 1
    for own, part in zip(np.split(who, cut), np.split(near, cut)):
        if not len(own):
            continue
        item = items.words[own[0]]
        edits = edits_allowed(len(item), similarity)
        begin, end = max(0, int(part[0]) - edits), int(part[-1]) + len(item) + edits
        first = max(0, int(np.searchsorted(starts, begin, "right")) - 1)
        last = int(np.searchsorted(starts, end, "left"))
        for doc in range(first, last):  # a stretch may touch the next document
            left = max(begin, int(starts[doc]))
            right = min(end, int(starts[doc + 1]) if doc + 1 < len(starts) else len(words))
            if best := distance_within(item.tolist(), words[left:right].tolist(), edits):
                found.append((doc, int(own[0]), best[0], left - int(starts[doc]) + best[1] - 1))
    return found


def _windows(words: np.ndarray, near: np.ndarray, size: int) -> np.ndarray:
    """The windows of ``size`` words that start at ``near``; words that no item has, and
    those beyond the text, all differ."""
    shifted = near[:, None] + np.arange(size)
    inside = (shifted >= 0) & (shifted < len(words))
    windows = np.where(inside, words[np.clip(shifted, 0, len(words) - 1)], 0)
    unknown = windows == 0
    windows[unknown] = (1 << 40) + shifted[unknown]
    return windows


def _block(docs: DataFrame, items: Items, item_type: str, similarity: float) -> DataFrame:
    kinds = dict(docs.dtypes)
    schema = (
        f"id {kinds['id']}, check long, item {item_type}, edits int, item_words int,"
        " last_word int"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = items.codes.get
        for batch in batches:
            for part in slices(batch, "text", 16 << 20):
                texts = [words_of(t) for t in as_bytes(part.column("text"))]
                sizes = np.array([len(t) for t in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                flat = np.fromiter(
                    map(code, chain.from_iterable(texts), repeat(0)), np.int64, int(sizes.sum())
                )
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for doc, k, edits, last in search(items, flat, starts, similarity):
                    best[doc, k] = min(best.get((doc, k), (edits, last)), (edits, last))
                rows = pa.array([doc for doc, _ in best], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(rows),
                        part.column("check").take(rows),
                        pa.array([items.ids[k] for _, k in best], item_kind),
                        pa.array([e for e, _ in best.values()], pa.int32()),
                        pa.array([len(items.words[k]) for _, k in best], pa.int32()),
                        pa.array([last for _, last in best.values()], pa.int32()),
                    ],
                    ["id", "check", "item", "edits", "item_words", "last_word"],
                )

    item_kind = _ITEM_KINDS[item_type]
    return docs.mapInArrow(run, schema)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, check, item, edits, item_words, last_word), the best place of each item in each
    row of ``docs`` that holds it; ``check`` tells apart rows that share an id."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("check"),
        F.col(text_col).alias("text"),
    )
    item_type = dict(benchmark.dtypes)[item_col]
    if item_type not in _ITEM_KINDS:
        benchmark = benchmark.withColumn(item_col, F.col(item_col).cast("string"))
        item_type = "string"
    found = []
    read = benchmark.select(item_col, text_col).toLocalIterator()
    while block := list(islice(read, BLOCK)):
        items = Items.build([(r[0], (r[1] or "").encode()) for r in block], similarity)
        if items.ids:
            found.append(_block(rows, items, item_type, similarity))
    if found:
        return reduce(DataFrame.unionAll, found)
    return rows.limit(0).select(
        "id", "check", F.lit(None).cast(item_type).alias("item"), F.lit(0).alias("edits"),
        F.lit(0).alias("item_words"), F.lit(0).alias("last_word"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were."""
    found = matches(docs, benchmark, id_col, text_col).select("id", "check").distinct()
    return drop_rows(docs, materialize(found, "contaminated"), id_col, text_col)

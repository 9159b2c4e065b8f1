"""What each filter of a chain removes, in every order of the chain.

The figures of a text come from one pass of a table-driven transducer over its UTF-8
bytes: a byte's class and the state before it (between words or inside one) name a step,
and a table says what the step emits: the start or end of a word, a capital, a code point,
a symbol. Here the class alone decides the next state, so the steps of a block are looked
up at once; the state and the start of an open word are carried from block to block. The
words' spans go into a hash table with open addressing, whose owners are compared byte by
byte before a word counts as seen, which gives the distinct words of each document.

Filters fail a document on: A too few words, B too few distinct words, C too many capitals,
D a symbol, E a text that a smaller id has, too. Per part only 32 sets of failed filters
can occur, so all orders are worked out from 32 counts, not from documents.

Copies are counted by groups of digest, part and label, summed before the shuffle, so a
text that a third of all rows share reaches its reducer as one row per task.

Defined results: a null text counts as empty, a null part as the empty string; a row
without an id has no smaller id and is none; rows that share an id count one by one, and
are no copies of each other; a label counts if any row of the document's id has it; an
empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendtide.llm.texts import map_texts
from spendtide.plans.materialize import materialize

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3
SYMBOLS = b"#$%&*|"

_SPACE, _OTHER, _CAPITAL, _SYMBOL, _TAIL = range(5)
#: The class of every byte; a tail continues a code point.
CLASS = np.full(256, _OTHER, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
CLASS[ord("A") : ord("Z") + 1] = _CAPITAL
CLASS[list(SYMBOLS)] = _SYMBOL
CLASS[0x80:0xC0] = _TAIL
_BETWEEN, _INSIDE = 0, 1
#: The state after a byte of each class, whatever the state before.
NEXT = np.array([_BETWEEN, _INSIDE, _INSIDE, _INSIDE, _INSIDE], np.uint8)
_STARTS, _ENDS, _IS_CAPITAL, _IS_POINT, _IS_SYMBOL = 1, 2, 4, 8, 16


def _outputs() -> np.ndarray:
    table = np.zeros((2, 5), np.uint8)
    table[_BETWEEN, 1:] |= _STARTS
    table[_INSIDE, _SPACE] |= _ENDS
    table[:, _CAPITAL] |= _IS_CAPITAL
    table[:, _SYMBOL] |= _IS_SYMBOL
    table[:, [_SPACE, _OTHER, _CAPITAL, _SYMBOL]] |= _IS_POINT
    return table.ravel()


#: What the step from a state (0 or 5) by a class emits.
OUTPUT = _outputs()

BLOCK = 4 << 20
_CHUNKS = 8
_HASH = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Spans:
    """The distinct words of each document of a buffer, as spans in a hash table.

    Linear probing; a slot's owner and a span that comes to it are the same word if
    document, length, hash and all bytes agree.
    """

    def __init__(self, data: bytes) -> None:
        self._data = data
        self._eight = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))
        self._used = 0
        self._clear(1 << 12)

    def _clear(self, size: int) -> None:
        self._start = np.full(size, -1, np.int64)
        self._size = np.zeros(size, np.int64)
        self._doc = np.zeros(size, np.int64)
        self._hash = np.zeros(size, np.uint64)

    def _chunk(self, start: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
        return self._eight[start + at] & _KEPT[np.minimum(size - at, 8)]

    def _hashes(self, doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """From the first 64 bytes, the length and the document."""
        found = (doc.astype(np.uint64) << np.uint64(32)) ^ size.astype(np.uint64)
        for at in range(0, min(int(size.max(initial=0)), 8 * _CHUNKS), 8):
            which = np.flatnonzero(size > at)
            mixed = (found[which] ^ self._chunk(start[which], size[which], at)) * _HASH
            found[which] = mixed ^ (mixed >> np.uint64(29))
        return found

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the spans of ``size`` bytes at ``a`` and ``b`` have the same bytes."""
        same = np.ones(len(a), bool)
        for at in range(0, min(int(size.max(initial=0)), 8 * _CHUNKS), 8):
            which = np.flatnonzero(same & (size > at) & (a != b))
            same[which] = self._chunk(a[which], size[which], at) == self._chunk(b[which], size[which], at)
        for k in np.flatnonzero(same & (size > 8 * _CHUNKS) & (a != b)):
            n = size[k]
            same[k] = self._data[a[k] : a[k] + n] == self._data[b[k] : b[k] + n]
        return same

    def insert(self, doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which of the spans are new words of their documents."""
        if 2 * (self._used + len(start)) > len(self._start):
            self._grow(self._used + len(start))
        new = self._place(doc, start, size, self._hashes(doc, start, size))
        self._used += int(new.sum())
        return new

    def _grow(self, count: int) -> None:
        held = np.flatnonzero(self._start >= 0)
        old = [x[held] for x in (self._doc, self._start, self._size, self._hash)]
        self._clear(1 << (4 * count - 1).bit_length())
        self._place(*old)

    def _place(
        self, doc: np.ndarray, start: np.ndarray, size: np.ndarray, hashed: np.ndarray
    ) -> np.ndarray:
        last = len(self._start) - 1
        new = np.zeros(len(start), bool)
        slot = (hashed & np.uint64(last)).astype(np.int64)
        left = np.arange(len(start))
        while len(left):
            claim = left[self._start[slot[left]] < 0]
            self._start[slot[claim]] = start[claim]
            owners = claim[self._start[slot[claim]] == start[claim]]
            at = slot[owners]
            self._doc[at], self._size[at], self._hash[at] = doc[owners], size[owners], hashed[owners]
            new[owners] = True
            at = slot[left]
            same = (
                (self._hash[at] == hashed[left]) & (self._size[at] == size[left])
                & (self._doc[at] == doc[left])
            )
            likely = np.flatnonzero(same)
            mine = left[likely]
            same[likely] = self._equal(start[mine], self._start[slot[mine]], size[mine])
            left = left[~same]
            slot[left] = (slot[left] + 1) & last
        return new


def measure(texts: list[bytes], block: int = BLOCK) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols (columns) of each text."""
    data = b" ".join(texts) + b" "
    ends = np.cumsum([len(t) + 1 for t in texts])
    found, spans = np.zeros((len(texts), 5), np.int64), Spans(data)
    state, opened = _BETWEEN, np.empty(0, np.int64)
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(whole), block):
        part = CLASS[whole[at : at + block]]
        states = np.empty(len(part), np.uint8)
        states[0], states[1:] = state, NEXT[part[:-1]]
        state = NEXT[part[-1]]
        emitted = OUTPUT[states * np.uint8(5) + part]

        first = int(np.searchsorted(ends, at, "right"))
        behind = int(np.searchsorted(ends, at + len(part) - 1, "right")) + 1
        cuts = np.maximum(np.append(0, ends[first : behind - 1] - at), 0)
        for column, mark in ((0, _STARTS), (2, _IS_CAPITAL), (3, _IS_POINT), (4, _IS_SYMBOL)):
            found[first:behind, column] += np.add.reduceat((emitted & mark) > 0, cuts, dtype=np.int64)

        starts = np.append(opened, at + np.flatnonzero(emitted & _STARTS))
        stops = at + np.flatnonzero(emitted & _ENDS)
        opened, starts = starts[len(stops) :], starts[: len(stops)]
        doc = np.searchsorted(ends, starts, "right")
        new = spans.insert(doc, starts, stops - starts)
        found[:, 1] += np.bincount(doc[new], minlength=len(texts))
    found[:, 3] -= 1  # the blank behind each text
    return found


def figures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(id, part, words, distinct, capitals, points, symbols, digest) of every row."""
    names = ("words", "distinct", "capitals", "points", "symbols")

    def work(texts: list[bytes]) -> dict[str, pa.Array]:
        found = measure(texts)
        made = {name: pa.array(found[:, k]) for k, name in enumerate(names)}
        return made | {"digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())}

    schema = ", ".join(f"{name} long" for name in names) + ", digest binary"
    return map_texts(docs, text_col, {id_col: "id", part_col: "part"}, work, schema, BLOCK)


def _bits(failed: dict[str, Column]) -> Column:
    total = F.lit(0)
    for letter, condition in failed.items():
        total = total + F.when(condition, 1 << FILTERS.index(letter)).otherwise(0)
    return total


def failures(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(part, fails, good, toxic, n): documents by the filters they fail, as bits, and by
    their labels."""
    fails = _bits({
        "A": F.col("words") < MIN_WORDS,
        "B": 100 * F.col("distinct") < MIN_DISTINCT * F.col("words"),
        "C": 100 * F.col("capitals") > MAX_CAPITALS * F.col("points"),
        "D": F.col("symbols") > 0,
    })
    part = F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part")
    rows = (
        figures(docs, id_col, text_col, part_col)
        .groupBy("id", "digest", fails.alias("fails"), part)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = materialize(rows, "filter-figures")

    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    known = rows.where("id is not null").join(marks, F.col("id") == F.col("label_id"), "left")
    plain = rows.where("id is null").withColumns({m: F.lit(False) for m in ("good", "toxic")})
    marked = known.drop("label_id").unionByName(plain).fillna(False, ["good", "toxic"])

    # Equal texts fail the same of the filters before E, so a text has few groups.
    groups = marked.groupBy("digest", "fails", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("id").alias("first"),
        F.min_by("n", "id").alias("n_first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_plain"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    groups = groups.withColumn("least", least)
    passing = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0) + F.col("n_plain")
    copy = 1 << FILTERS.index("E")
    return (
        groups.select(
            "part", "good", "toxic",
            F.inline(F.array(
                F.struct(F.col("fails").alias("fails"), passing.alias("n")),
                F.struct((F.col("fails") + copy).alias("fails"), (F.col("n") - passing).alias("n")),
            )),
        )
        .groupBy("part", "fails", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def audit(counts: DataFrame) -> DataFrame:
    """Per part, order of all filters and step of it: what ``failures`` amount to there."""
    sets = range(1 << len(FILTERS))

    def by_set(condition: Column) -> Column:
        return F.array(*[
            F.coalesce(F.sum(F.when((F.col("fails") == s) & condition, F.col("n"))), F.lit(0)) for s in sets
        ])

    parts = counts.groupBy("part").agg(
        by_set(F.lit(True)).alias("all"), by_set(F.col("good")).alias("good"),
        by_set(F.col("toxic")).alias("toxic"),
    )
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    base = ord(FILTERS[0])
    before = F.expr(
        "aggregate(sequence(1, 5), 0, (got, k) -> got"
        f" + if(k < step, shiftleft(1, ascii(substr(filter_order, k, 1)) - {base}), 0))"
    )
    steps = (
        parts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(steps))
        .withColumn("before", before)
        .withColumn("own", F.expr(f"shiftleft(1, ascii(substr(filter_order, step, 1)) - {base})"))
    )

    def total(of: str, condition: str) -> Column:
        return F.expr(
            f"aggregate(sequence(0, {len(sets) - 1}), 0L,"
            f" (got, s) -> got + if({condition}, `{of}`[s], 0L))"
        )

    here = "(s & before) = 0 and (s & own) > 0"
    found = steps.select(
        "part", "filter_order", "step", "own",
        total("all", "(s & (before | own)) = 0").alias("kept"),
        total("all", here).alias("removed"),
        total("all", "(s & before) > 0 and (s & own) > 0").alias("redundant"),
        total("all", "s = own").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "own"))
    return found.withColumn("shapley", shapley).drop("own")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``documents`` with ``labels``, per language."""
    return audit(failures(docs, labels))

"""Passages that repeat across documents, by content-defined chunking.

A gear hash rolls over a text's UTF-8: ``h = 2 h + G[byte]``; its low ``REACH`` bits depend
on the last ``REACH`` bytes only. A chunk ends where no bits within ``RADIUS`` bytes on either
side are smaller; of equal places closer than that to each other every one that is
``RADIUS`` bytes behind the last cut is taken. So a boundary depends on the bytes around it
and on nothing else: what is inserted before a passage moves its chunks, but cuts them
alike, and all chunks inside it are whole but for those at its ends. Text that repeats
after a few bytes is cut at the same place of its period again and again, wherever it
begins, so its chunks are alike in every copy.

Chunks are deduplicated by digest: of a digest that occurs more than once, in several
documents or in one, one chunk stays, that of the document with the smallest hash of id and
text and there the first. Repeated chunks in a row make a passage; it counts from
``LEAST_WORDS`` words, so that a common line or phrase is none. A shared passage of more than
50 words is found with all but the words at its ends. A digest has 64 bits; a passage is
several chunks in a row, so chance collisions make none.

Digests are first counted with partial sums. A second pass cuts the texts again (cheaper
than to store all chunks) and joins them to the repeated digests in a sort-merge join,
which Spark splits where one passage is very frequent. Only repeated chunks are stored,
and gathered by document.

Defined results: null and empty texts have no chunks; rows are documents, whatever their ids,
so equal rows repeat each other; an empty table gives an empty result; columns other than
the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendtide.llm.texts import as_bytes, slices
from spendtide.plans.materialize import materialize

REACH, RADIUS, LEAST_WORDS = 16, 16, 20
#: A random number for each byte value.
GEAR = np.random.default_rng(42).integers(0, 1 << 16, 256, dtype=np.uint16)
_LAST = np.uint16(0xFFFF)


def _window_least(values: np.ndarray, size: int) -> np.ndarray:
    """Least of ``size`` values from each place on; behind the end nothing is less."""
    least, held = values, 1
    while held < size:
        step = min(held, size - held)
        shifted = np.full_like(least, _LAST)
        shifted[:-step] = least[step:]
        least, held = np.minimum(least, shifted), held + step
    return least


def boundaries(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of some bytes, the last one at their end."""
    if not len(data):
        return np.empty(0, np.int64)
    sums = GEAR[data]
    for step in (1, 2, 4, 8):  # sums over 2, 4, 8 and 16 bytes
        longer = sums.copy()
        longer[step:] += sums[:-step] << np.uint16(step)
        sums = longer
    after = _window_least(sums, RADIUS + 1)
    before = np.full(len(sums), _LAST)
    before[RADIUS:] = _window_least(sums, RADIUS)[:-RADIUS]
    for k in range(1, min(RADIUS, len(sums))):  # fewer bytes stand before the first places
        before[k] = sums[:k].min()
    ends = np.flatnonzero((sums <= before) & (sums <= after)) + 1
    if (np.diff(ends) < RADIUS).any():  # equal places
        kept, last = [], -RADIUS
        for end in ends.tolist():
            if end - last >= RADIUS:
                kept.append(end)
                last = end
        ends = np.array(kept)
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, check, row, n, at, size, words, digest): the chunks of every text, from 0, by
    place and size in bytes and the words that begin in them; ``check`` hashes id and text,
    ``row`` tells rows apart in this frame."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("check"),
        F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                numbers, starts, sizes, words, hashes = [], [], [], [], []
                for text in as_bytes(part.column("text")):
                    data = np.frombuffer(text, np.uint8)
                    ends = boundaries(data)
                    begin = np.append(0, ends[:-1]) if len(ends) else ends
                    numbers.append(len(ends))
                    starts.append(begin)
                    sizes.append(ends - begin)
                    if len(ends):
                        gap = blank[data]
                        first = ~gap & np.append(True, gap[:-1])
                        words.append(np.add.reduceat(first.astype(np.int32), begin))
                    hashes += [digest(text[a:b]) for a, b in zip(begin.tolist(), ends.tolist())]
                row = np.repeat(np.arange(part.num_rows), numbers)
                hashes = np.array(hashes, np.uint64).view(np.int64)
                at = np.concatenate(starts) if starts else np.empty(0, np.int64)
                n = np.arange(len(row)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(row)),
                        part.column("check").take(pa.array(row)),
                        part.column("row").take(pa.array(row)),
                        pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32)),
                        pa.array(np.concatenate(sizes or [at]).astype(np.int32)),
                        pa.array(np.concatenate(words or [at]).astype(np.int32)),
                        pa.array(hashes),
                    ],
                    ["id", "check", "row", "n", "at", "size", "words", "digest"],
                )

    return rows.mapInArrow(
        run,
        f"id {kind}, check long, row long, n int, at int, size int, words int, digest long",
    )


def repeated_chunks(found: DataFrame) -> DataFrame:
    """The chunks whose digest occurs again, with ``copies`` and whether this is the one
    that stays; stored."""
    again = found.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    again = materialize(again, "repeated-digests")
    repeated = materialize(found.join(again, "digest"), "repeated-chunks")
    place = F.struct("check", "row", "n")
    first = materialize(repeated.groupBy("digest").agg(F.min(place).alias("first")), "first-chunks")
    return repeated.join(first, "digest").select(
        "id", "check", "row", "n", "at", "size", "words", "copies", (place == F.col("first")).alias("stays")
    )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """One row per repeated passage of each document: id, check, start and size in bytes,
    words, chunks, the most copies of one of its chunks, and ``kept_bytes``, how much of
    it stays here (0: all of it stands elsewhere and may go)."""
    repeated = repeated_chunks(chunks(docs, id_col, text_col))
    along = Window.partitionBy("row").orderBy("n")
    runs = repeated.withColumn("run", F.col("n") - F.row_number().over(along))
    return (
        runs.groupBy("row", "run")
        .agg(
            F.first("id").alias("id"), F.first("check").alias("check"),
            F.min("at").alias("start"),
            F.max(F.col("at") + F.col("size")).alias("end"),
            F.sum("words").cast("int").alias("words"),
            F.count(F.lit(1)).cast("int").alias("chunks"),
            F.max("copies").alias("copies"),
            F.sum(F.when(F.col("stays"), F.col("size")).otherwise(0)).alias("kept_bytes"),
        )
        .where(F.col("words") >= least_words)
        .select(
            F.col("id").alias(id_col), "check", "start",
            (F.col("end") - F.col("start")).alias("size"),
            "words", "chunks", "copies", "kept_bytes",
        )
    )

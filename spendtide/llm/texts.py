"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are. Texts of ASCII alone take the fast way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text of a column; a null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    sizes = batch.column(text).cast(pa.binary())
    start = held = 0
    for k in range(batch.num_rows):
        size = len(sizes[k].as_buffer()) if sizes[k].is_valid else 0
        if k > start and held + size > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(
    docs: DataFrame,
    text_col: str,
    keep: dict[str, str],
    work: Callable[[list[bytes]], dict[str, pa.Array]],
    schema: str,
    most: int = 8 << 20,
) -> DataFrame:
    """One row per document: ``keep`` (old to new name) and what ``work`` adds to it.

    ``work`` gets the texts of a slice of at most ``most`` bytes, or one longer text, so
    that a task holds a slice at a time. Only the columns named here are read.
    """
    rows = docs.select(
        *[F.col(old).alias(new) for old, new in keep.items()],
        F.col(text_col).cast("string").alias("_text"),
    )
    kinds = dict(rows.dtypes)
    fields = ", ".join([f"`{n}` {kinds[n]}" for n in keep.values()] + [schema])
    names = list(keep.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", most):
                made = work(as_bytes(part.column("_text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + list(made.values()), names + list(made)
                )

    return rows.mapInArrow(run, fields)


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, check, text) of each row: what decisions on a row are joined back by.

    ``check`` tells rows apart that share an id but not the text.
    """
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("check"),
        F.col(text_col).alias(text_col),
    )


def _same_row(id_col: str, text_col: str) -> Column:
    return F.col(f"d.{id_col}").eqNullSafe(F.col("k.id")) & (
        F.xxhash64(F.col(f"d.{text_col}")) == F.col("k.check")
    )


def drop_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``keys`` (id, check) names."""
    return docs.alias("d").join(keys.alias("k"), _same_row(id_col, text_col), "left_anti")


def keep_one(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each row of ``keys`` (id, check)."""
    one = Window.partitionBy("id", "check").orderBy("id")
    rows = docs.alias("d").join(keys.alias("k"), _same_row(id_col, text_col)).select(
        F.struct("d.*").alias("row"), "k.id", "k.check"
    )
    return rows.withColumn("n", F.row_number().over(one)).where("n = 1").select("row.*")

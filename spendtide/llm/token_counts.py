"""Token counts by source, language and tokenizer version, kept by signed deltas.

A batch of changes inserts documents, deletes them, or revises their counts; its rows are
signed: +1 document and +n tokens, -1 and -n, or 0 and the difference. Only the batch's
sums by key are stored, as a part of its own, and totals are sums of sums, so they never
rescan documents.

A batch is committed by its name: its sums are written first, then one small file of that
name that says where they are, which appears only if there is none yet. Sums without a
commit count for nothing, and a batch that is committed already is not applied again. Every
``FOLD`` commits the totals so far are written as one part, under the next number, with
the names that are in it, so reading totals opens that part and fewer than ``FOLD`` others,
however many batches there were. All files lie in the store's path, which all executors
and the driver share.

Defined results: a null source or language is a key of its own; a null text counts as an
empty one with no tokens; a null old or new count counts as 0; an empty batch is committed
without sums; an empty store has no totals; extra columns are never read. Rows, not ids,
are counted: those with a null or repeated id one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote, unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.llm import sentencepieces
from spendtide.sources.commit_log import Log

KEYS = ("source", "lang", "version")
_SUMS = "source string, lang string, version string, docs long, tokens long"
#: Commits after which the totals are written as one part.
FOLD = 50


def word_count(text: Column) -> Column:
    """Runs of signs other than white space."""
    text = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.size(F.array_remove(F.split(text, " "), "")).cast("long")


def counted(docs: DataFrame, version: str, model: str = sentencepieces.MODEL) -> DataFrame:
    """(doc_id, source, lang, version, tokens) with the pieces of the model as tokens."""
    keep = {"doc_id": "doc_id", "source": "source", "lang": "lang"}
    found = sentencepieces.encode(docs, model, keep=keep, ids=False)
    return found.select(
        "doc_id", "source", "lang", F.lit(version).alias("version"),
        F.col("n_pieces").cast("long").alias("tokens"),
    )


def counted_words(docs: DataFrame, version: str = "words") -> DataFrame:
    """The same with runs of signs other than white space as tokens."""
    return docs.select(
        "doc_id", "source", "lang", F.lit(version).alias("version"),
        word_count(F.col("text")).alias("tokens"),
    )


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that add the documents of ``counts``."""
    return counts.select(*KEYS, F.lit(1).alias("docs"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take the documents of ``counts`` away."""
    return counts.select(
        *KEYS, F.lit(-1).alias("docs"), (-F.coalesce("tokens", F.lit(0))).alias("tokens")
    )


def revisions(pairs: DataFrame) -> DataFrame:
    """Changes for documents whose ``old_tokens`` become ``new_tokens``."""
    change = F.coalesce("new_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))
    return pairs.select(*KEYS, F.lit(0).alias("docs"), change.alias("tokens"))


@dataclass(frozen=True)
class Rollup:
    """Totals under a shared path."""

    spark: SparkSession
    path: str

    def _state(self) -> tuple[str | None, set[str], dict[str, str], int]:
        """The folded part, the names in it, the parts of other commits by name, and the
        number of folds."""
        log = Log(self.spark, self.path)
        names = log.names()
        folds = [n for n in names if n.endswith(".fold")]
        folded = log.read(folds[-1]) if folds else {"part": None, "names": []}
        known = set(folded["names"])
        rest = {unquote(n.removesuffix(".batch")) for n in names if n.endswith(".batch")} - known
        return folded["part"], known, {n: log.read(_file(n))["part"] for n in sorted(rest)}, len(folds)

    def commits(self) -> DataFrame:
        """The names of all committed batches."""
        _, folded, rest, _ = self._state()
        return self.spark.createDataFrame([(n,) for n in sorted(folded | set(rest))], "batch string")

    def _write(self, sums: DataFrame) -> str:
        part = f"sums/{uuid4().hex}"
        sums.coalesce(1).write.parquet(f"{self.path}/{part}")
        return part

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit the signed ``changes``; False if the batch was committed before."""
        log = Log(self.spark, self.path)
        if _file(batch) in log.names():
            return False
        sums = changes.groupBy(*KEYS).agg(
            F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens")
        )
        done = log.create(_file(batch), {"part": self._write(sums)})
        if done:
            self._fold()
        return done

    def _fold(self) -> None:
        part, folded, rest, number = self._state()
        if len(rest) >= FOLD:
            whole = self._write(self._sums(part, rest))
            content = {"part": whole, "names": sorted(folded | set(rest))}
            Log(self.spark, self.path).create(f"{number + 1:020d}.fold", content)

    def _sums(self, part: str | None, rest: dict[str, str]) -> DataFrame:
        parts = [f"{self.path}/{p}" for p in [part, *rest.values()] if p]
        if not parts:
            return self.spark.createDataFrame([], _SUMS)
        return self.spark.read.schema(_SUMS).parquet(*parts).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )

    def totals(self) -> DataFrame:
        """Documents and tokens of every key, keys without either left out."""
        part, _, rest, _ = self._state()
        return self._sums(part, rest).where("docs <> 0 or tokens <> 0")


def _file(batch: str) -> str:
    return f"{quote(batch, safe='')}.batch"

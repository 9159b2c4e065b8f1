"""Tables by day: parquet in parts, one folder per day in each, and a commit log.

Every write makes a part of its own, whose rows are counted against those that were sent,
and one commit then says which days the part adds to or replaces (see ``commit_log``).
Readers take each day from the parts that hold it by the log, so a write shows as a whole
or not at all: one that breaks off leaves a part that nobody reads, and the old days stay.
Loads that read days and write them back are worked out again if another writer changed
those days meanwhile; loads of other days, and appends, just follow each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendtide.sources.commit_log import Commit, Log, State

#: How often a load is worked out again when other writers change its days.
ATTEMPTS = 10
#: The first day that a change of the whole table is taken to touch; the last is ``date.max``.
FIRST_DAY = date(1000, 1, 1)
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _write(df: DataFrame, path: str, day: str) -> None:
    df.write.mode("error").partitionBy(day).parquet(path)


def within(df: DataFrame, day: str, first: date | None, last: date | None) -> DataFrame:
    """Rows from ``first`` to ``last`` by the column ``day``."""
    if first is not None:
        df = df.where(F.col(day) >= F.lit(first))
    if last is not None:
        df = df.where(F.col(day) <= F.lit(last))
    return df


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed while a scan is made; by default each by a task of its own."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(min(int(usual), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def joined(stretches: list[tuple[date, date]]) -> list[tuple[date, date]]:
    """Stretches of days without those that overlap or follow each other."""
    found: list[tuple[date, date]] = []
    for first, last in sorted(stretches):
        if found and first.toordinal() <= found[-1][1].toordinal() + 1:
            found[-1] = found[-1][0], max(found[-1][1], last)
        else:
            found.append((first, last))
    return found


@dataclass(frozen=True)
class DayTable:
    """The table of ``schema`` at ``path``, in parts by its date column ``day``; files are
    sorted by ``order`` within a day."""

    spark: SparkSession
    path: str
    schema: T.StructType
    day: str
    order: Sequence[str] = ()

    def _log(self) -> Log:
        return Log(self.spark, self.path)

    def exists(self) -> bool:
        return self._log().state().version > 0

    def commits(self) -> DataFrame:
        """(version, action, part, day, rows): what each commit holds of each day."""
        rows = [
            (version, c.action, c.part, None if d == _NO_DAY else date.fromisoformat(d), count)
            for version, c in self._log().commits() for d, count in c.rows.items()
        ]
        return self.spark.createDataFrame(
            rows, f"version long, action string, part string, `{self.day}` date, rows long"
        )

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The table as of the last commit, or its days from ``first`` to ``last``, as a
        partition-pruned scan."""
        state = self._log().state()
        if not state.version:
            raise FileNotFoundError(f"no table at {self.path}")
        return self.scan(state, first, last)

    def scan(self, state: State, first: date | None = None, last: date | None = None) -> DataFrame:
        """The folders of the days from ``first`` to ``last``; no other one is even listed."""
        held = [
            f"{self.path}/part={part}/{self.day}={d}"
            for d, parts in sorted(state.days.items())
            if (first is None or str(first) <= d) and (last is None or d <= str(last))
            for part in parts
        ]
        if not held:
            return self.spark.createDataFrame([], self.schema)
        kind = T.StructType([*self.schema.fields, T.StructField("part", T.StringType())])
        with _few_listing_tasks(self.spark):
            found = self.spark.read.schema(kind).option("basePath", self.path).parquet(*held)
        return within(found, self.day, first, last).select(*self.schema.names)

    def _store(self, df: DataFrame) -> tuple[str, dict[str, int]]:
        """Write ``df`` as a part; its name and its rows per day, read back and compared.

        Rebalancing by day gives each partition few files of the advisory size and splits
        a day that is too large for one task. Rows are counted behind that shuffle, where
        a repeated task counts once.
        """
        part, sent = f"p{uuid4().hex}", Observation()
        rows = df.select(*self.schema.names).hint("rebalance", self.day)
        rows = rows.observe(sent, F.count(F.lit(1)).alias("rows"))
        where = f"{self.path}/part={part}"
        _write(rows.sortWithinPartitions(self.day, *self.order), where, self.day)
        with _few_listing_tasks(self.spark):
            stored = self.spark.read.schema(self.schema).parquet(where)
        counts = stored.groupBy(self.day).agg(F.count(F.lit(1)).alias("rows")).collect()
        found = {_NO_DAY if r[0] is None else str(r[0]): r[1] for r in counts}
        if sum(found.values()) != sent.get.get("rows", 0):
            raise RuntimeError(f"{where} has {sum(found.values())} rows of {sent.get}")
        return part, found

    def append(self, df: DataFrame, writer: str | None = None, batch: int | None = None) -> bool:
        """Add rows. A ``writer``'s batches are numbered upwards; one that is not above its
        last is left out, and False returned."""

        def known(batches: dict[str, int]) -> bool:
            return writer is not None and batch <= batches.get(writer, batch - 1)

        log = self._log()
        state = log.state()
        if known(state.batches):
            return False
        part, rows = self._store(df)
        commit = Commit("append", part, rows, writer=writer, batch=batch)
        return log.commit(state, commit, lambda c: c.writer is not None and known({c.writer: c.batch}))

    def overwrite(self, df: DataFrame) -> None:
        """Replace the whole table; ``df`` may read from it."""
        log = self._log()
        state = log.state()
        log.commit(state, Commit("overwrite", *self._store(df)), lambda _: False)

    def batch_of(self, writer: str) -> int:
        """The last batch that ``writer`` has committed; 0 if none."""
        return self._log().state().batches.get(writer, 0)

    def changes(self, since: int) -> tuple[State, list[tuple[date, date]]]:
        """The table as of now, and the stretches of days that commits behind number
        ``since`` touched, apart from each other and in order."""
        state = self._log().state()
        found = []
        for version, commit in self._log().commits(since):
            if version > state.version:
                continue
            if commit.action == "overwrite":
                found.append((FIRST_DAY, date.max))
            if commit.action == "replace":
                found.append((date.fromisoformat(commit.first), date.fromisoformat(commit.last)))
            days = [date.fromisoformat(d) for d in commit.rows if d != _NO_DAY]
            found += [(d, d) for d in days]
        return state, joined(found)

    def replace_days(
        self, first: date, last: date, content: Callable[[DataFrame], DataFrame],
        writer: str | None = None, batch: int | None = None,
    ) -> None:
        """Put ``content`` of the days from ``first`` to ``last`` in their place.

        It is worked out again from the new days where another writer has changed them.
        """
        log = self._log()
        for _ in range(ATTEMPTS):
            state = log.state()
            made = content(self.scan(state, first, last))
            part, rows = self._store(within(made, self.day, first, last))
            commit = Commit("replace", part, rows, str(first), str(last), writer, batch)
            if log.commit(state, commit, lambda c: c.touches(str(first), str(last))):
                return
        raise RuntimeError(f"other writers changed {first} to {last} {ATTEMPTS} times")

    def drop_unread(self, min_age_seconds: int = 0) -> None:
        """Delete the parts that hold no day any more, and those never committed.

        A part being written is not committed yet: where other writers may be at work,
        ``min_age_seconds`` must be above the time that a load takes.
        """
        kept = {part for parts in self._log().state().days.values() for part in parts}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        newest = self.spark._jvm.java.lang.System.currentTimeMillis() - 1000 * min_age_seconds
        for found in system.listStatus(root):
            name = found.getPath().getName()
            unread = name.startswith("part=") and name.removeprefix("part=") not in kept
            if unread and found.getModificationTime() <= newest:
                system.delete(found.getPath(), True)

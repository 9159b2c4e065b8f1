"""A numbered log of commits beside a table's files.

Every change of a table is one small file with the next free number. It appears whole and
only if nobody took the number: it is written under a temporary name and then renamed
without overwriting (hard-linked where the folder is a local one, whose rename overwrites).
Whoever finds the number taken reads what the other wrote, and goes on to the next number
or gives up, as its change allows. No clock decides anything.

The log's folder must lie on a file system whose rename without overwriting is atomic, as
HDFS and the local one are; a plain object store needs a committer that gives it that.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_log"
#: Commits after which the state is written out, so that readers start from there.
SNAPSHOT_EVERY = 50


@dataclass(frozen=True)
class Commit:
    """A part of the table: the rows it has of each day, and what it takes the place of.

    ``append`` adds the part to its days, ``replace`` puts it in the place of everything
    from ``first`` to ``last``, ``overwrite`` in the place of the whole table. ``writer``
    and ``batch`` name a change that must not be applied twice.
    """

    action: str
    part: str
    rows: dict[str, int]
    first: str | None = None
    last: str | None = None
    writer: str | None = None
    batch: int | None = None

    def touches(self, first: str, last: str) -> bool:
        """Whether it changes any day from ``first`` to ``last``."""
        if self.action == "overwrite":
            return True
        if self.action == "replace" and self.first <= last and first <= self.last:
            return True
        return any(first <= day <= last for day in self.rows)


@dataclass(frozen=True)
class State:
    """The parts that hold each day, and each writer's last batch, after ``version`` commits."""

    version: int = 0
    days: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def after(self, commit: Commit) -> State:
        days = self.days
        if commit.action == "overwrite":
            days = {}
        elif commit.action == "replace":
            days = {d: p for d, p in days.items() if not commit.first <= d <= commit.last}
        days = days | {d: [*days.get(d, []), commit.part] for d in commit.rows}
        batches = self.batches
        if commit.writer is not None:
            batches = batches | {commit.writer: commit.batch}
        return State(self.version + 1, days, batches)


class Log:
    """The log of the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder = f"{path.rstrip('/')}/{FOLDER}"
        self._fs = self._path().getFileSystem(self._conf)

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}" if name else self._folder)

    def names(self) -> list[str]:
        """The log's files, in order."""
        if not self._fs.exists(self._path()):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path()))

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, name: str, content: dict) -> bool:
        """Make the file, whole; False if there is one of that name."""
        hidden = self._path(f".{uuid4().hex}")
        stream = self._fs.create(hidden, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        target = self._path(name)
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(hidden.toUri().getPath(), target.toUri().getPath())
            else:
                self._rename(hidden, target)
            return True
        except FileExistsError:
            return False
        finally:
            self._fs.delete(hidden, False)

    def _rename(self, source, target) -> None:
        fs = self._jvm.org.apache.hadoop.fs
        rename = getattr(fs, "Options$Rename")
        never_over = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        never_over[0] = rename.NONE
        try:
            fs.FileContext.getFileContext(target.toUri(), self._conf).rename(source, target, never_over)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise FileExistsError(str(target)) from error
            raise

    def commits(self, since: int = 0) -> list[tuple[int, Commit]]:
        """The commits behind number ``since``, with their numbers."""
        numbers = [int(n.split(".")[0]) for n in self.names() if n.endswith(".json")]
        return [(n, Commit(**self.read(f"{n:020d}.json"))) for n in numbers if n > since]

    def state(self) -> State:
        """The table as of now: the last written state and the commits since."""
        names = self.names()
        written = [n for n in names if n.endswith(".state")]
        state = State(**self.read(written[-1])) if written else State()
        for name in names:
            if name.endswith(".json") and int(name.split(".")[0]) > state.version:
                state = state.after(Commit(**self.read(name)))
        return state

    def commit(self, state: State, commit: Commit, gives_way: Callable[[Commit], bool]) -> bool:
        """Add ``commit``, worked out from ``state``; False if a commit made since then is
        one that it gives way to."""
        while not self.create(f"{state.version + 1:020d}.json", vars(commit)):
            other = Commit(**self.read(f"{state.version + 1:020d}.json"))
            if gives_way(other):
                return False
            state = state.after(other)
        state = state.after(commit)
        if state.version % SNAPSHOT_EVERY == 0:
            self.create(f"{state.version:020d}.state", vars(state))
        return True

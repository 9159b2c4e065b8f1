"""The daily cube and monthly moments of a fact, kept from run to run.

Both are tables by day of their own that follow another table's log: what its commits have
touched since the last refresh is made again from it, and the last of these writes carries
the number up to which it has followed. A refresh that breaks off is done again from that
number; days made twice are replaced by themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendtide.functions.numbers import EXACT
from spendtide.operators.moment_states import merged_states, states_of, value_states
from spendtide.operators.rollups import LEVELS, daily_cube, rollup
from spendtide.sources.day_table import DayTable, joined
from spendtide.sources.facts import fact_table

MONTH = "MONTH_START"
_KEYS = "SERVICE string, TAG string, STARTDATE date"
_CUBE = f"{_KEYS}, USD double, USD_MIN double"
_EXACT_CUBE = f"{_KEYS}, USD decimal(38,12), USD_MIN {EXACT.simpleString()}"
_STATE = f"{MONTH} date, n long, mean double, squares double, low double, high double"


def month_start(day: date) -> date:
    return day.replace(day=1)


def next_month(day: date) -> date:
    return month_start(month_start(day) + timedelta(days=31))


def follow(
    source: DayTable, target: DayTable, content: Callable[[DataFrame], DataFrame],
    to_target: Callable[[date], date] = lambda day: day,
    until: Callable[[date], date] = lambda day: day,
) -> None:
    """Make again what ``source`` has changed since ``target`` last followed it.

    ``to_target`` names the target's day that a source day belongs to, and ``until`` the
    last source day of a target day; ``content`` turns the source's rows into the target's.
    """
    state, touched = source.changes(target.batch_of("source"))
    stretches = joined([(to_target(first), to_target(last)) for first, last in touched])
    for n, (first, last) in enumerate(stretches, 1):
        mark = ("source", state.version) if n == len(stretches) else (None, None)
        rows = source.scan(state, first, until(last))
        target.replace_days(first, last, lambda _, rows=rows: content(rows), *mark)


@dataclass(frozen=True)
class KeptState:
    """What is kept of the fact at ``fact_path``, under ``path``."""

    spark: SparkSession
    fact_path: str
    path: str
    exact: bool = False

    @property
    def cube(self) -> DayTable:
        """One row per service, tag and day, as ``daily_cube``."""
        kind = T._parse_datatype_string(_EXACT_CUBE if self.exact else _CUBE)
        return DayTable(self.spark, f"{self.path}/cube", kind, "STARTDATE", ("SERVICE", "TAG"))

    def months(self, level: str) -> DayTable:
        """One state of the daily sums per key of ``level`` and month, by its first day."""
        keys = ", ".join(f"{k} string" for k in LEVELS[level])
        kind = T._parse_datatype_string(f"{keys}, {_STATE}")
        return DayTable(self.spark, f"{self.path}/months_{level}", kind, MONTH, LEVELS[level])

    def refreshed(self) -> KeptState:
        """Bring the cube in step with the fact."""
        follow(fact_table(self.spark, self.fact_path, self.exact), self.cube, daily_cube)
        return self

    def refreshed_months(self, level: str) -> KeptState:
        """Bring the cube and the months of ``level`` in step with the fact."""
        month = F.trunc("STARTDATE", "MM").cast("date")

        def content(cube: DataFrame) -> DataFrame:
            return states_of(rollup(cube, level, "day"), LEVELS[level], month, MONTH)

        def month_end(first: date) -> date:
            return date.max if first == month_start(date.max) else next_month(first) - timedelta(days=1)

        follow(self.refreshed().cube, self.months(level), content, month_start, month_end)
        return self

    def states(self, level: str, first: date, last: date) -> DataFrame:
        """One state per key over the days from ``first`` to ``last``: whole months from
        their states, the days beside them from the cube."""
        keys = LEVELS[level]
        start = first if first == month_start(first) else next_month(first)
        end = month_start(last + timedelta(days=1))
        ends = [(first, last)] if start >= end else [
            (first, start - timedelta(days=1)), (end, last),
        ]
        days = [
            value_states(rollup(self.cube.read(a, b), level, "day"), keys) for a, b in ends if a <= b
        ]
        found = [self.months(level).read(start, end - timedelta(days=1)).drop(MONTH)] if start < end else []
        found += days
        states = found[0]
        for more in found[1:]:
            states = states.unionByName(more)
        return merged_states(states, keys)

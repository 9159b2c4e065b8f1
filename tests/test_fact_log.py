"""The fact's commit log: appends, replaced days and overwrites by several writers."""

import json
from datetime import timedelta

import pytest

from frames import DAY0, costs, rows
from spendtide.sources import commit_log, day_table, facts
from spendtide.sources.commit_log import Commit, Log, State


def day(n):
    return DAY0 + timedelta(days=n)


def stored(spark, path):
    return [(d.day, u) for d, u in rows(facts.read_fact(spark, path), "STARTDATE", "USD")]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "fact")


def test_appends_after_a_merge_are_read(spark, path):
    facts.append_fact(costs(spark, [("a", "x", 0, 1)]), path)
    for _ in range(2):
        facts.merge_fact(costs(spark, [("a", "x", 0, 1), ("a", "x", 0, 2)]), path, day(0), day(1))
    facts.append_fact(costs(spark, [("a", "x", 0, 3), ("a", "x", 0, 1), ("a", "x", 5, 9)]), path)
    assert stored(spark, path) == [(1, 1), (1, 1), (1, 2), (1, 3), (6, 9)]
    facts.merge_fact(costs(spark, []), path, day(0), day(0))
    assert stored(spark, path) == [(1, 1), (1, 2), (1, 3), (6, 9)]
    facts.overwrite_fact(facts.read_fact(spark, path).where("USD > 2"), path)
    assert stored(spark, path) == [(1, 3), (6, 9)]
    assert rows(facts.commits(spark, path), "version", "action", "rows")[-2:] == [(6, "overwrite", 1)] * 2


def test_two_writers_of_the_same_day(spark, path):
    """The second writer commits while the first one is at work; both loads are kept."""
    facts.append_fact(costs(spark, [("a", "x", 0, 1), ("a", "x", 1, 1)]), path)
    seen = []

    def first_load(history):
        seen.append(history.count())
        if len(seen) == 1:
            facts.merge_fact(costs(spark, [("a", "x", 0, 2)]), path, day(0), day(0))
        return facts.merged(history, costs(spark, [("a", "x", 0, 3)]))

    facts.replace_days(spark, path, day(0), day(0), first_load)
    assert stored(spark, path) == [(1, 1), (1, 2), (1, 3), (2, 1)] and seen == [1, 2]


def test_writers_of_other_days_follow_each_other(spark, path):
    facts.append_fact(costs(spark, [("a", "x", 0, 1)]), path)
    seen = []

    def load(history):
        seen.append(1)
        facts.merge_fact(costs(spark, [("a", "x", 1, 2)]), path, day(1), day(1))
        facts.append_fact(costs(spark, [("a", "x", 2, 4)]), path)
        return facts.merged(history, costs(spark, [("a", "x", 0, 3)]))

    facts.replace_days(spark, path, day(0), day(0), load)
    assert stored(spark, path) == [(1, 1), (1, 3), (2, 2), (3, 4)] and len(seen) == 1


def test_a_day_that_keeps_changing_is_an_error(spark, path, monkeypatch):
    monkeypatch.setattr(day_table, "ATTEMPTS", 2)

    def load(history):
        facts.append_fact(costs(spark, [("a", "x", 0, 1)]), path)
        return history

    with pytest.raises(RuntimeError, match="2 times"):
        facts.replace_days(spark, path, day(0), day(0), load)
    assert stored(spark, path) == [(1, 1)] * 2


def test_a_part_with_lost_rows_is_not_committed(spark, path, monkeypatch):
    facts.append_fact(costs(spark, [("a", "x", 0, 1)]), path)
    write = day_table._write
    monkeypatch.setattr(day_table, "_write", lambda df, *where: write(df.where("USD < 3"), *where))
    with pytest.raises(RuntimeError, match="has 1 rows of"):
        facts.append_fact(costs(spark, [("a", "x", 0, 2), ("a", "x", 0, 3)]), path)
    assert stored(spark, path) == [(1, 1)]


def test_numbered_batches_count_once(spark, path):
    batch = costs(spark, [("a", "x", 0, 1)])
    assert facts.append_fact(batch, path, "loader", 0)
    assert not facts.append_fact(batch, path, "loader", 0)
    assert facts.append_fact(batch, path, "other", 0) and facts.append_fact(batch, path, "loader", 1)
    assert stored(spark, path) == [(1, 1)] * 3


def test_batch_committed_meanwhile_is_left_out(spark, path, monkeypatch):
    batch = costs(spark, [("a", "x", 0, 1)])
    table, done = facts.fact_table(spark, path), []
    store = day_table.DayTable._store

    def slow(self, df):
        found = store(self, df)
        if not done:
            done.append(1)
            assert table.append(df, "loader", 7)
        return found

    monkeypatch.setattr(day_table.DayTable, "_store", slow)
    assert not table.append(batch, "loader", 7)
    assert stored(spark, path) == [(1, 1)]


def test_empty_and_dayless_rows(spark, path):
    with pytest.raises(FileNotFoundError):
        facts.read_fact(spark, path)
    facts.append_fact(costs(spark, []), path)
    assert stored(spark, path) == []
    facts.append_fact(costs(spark, [("a", "x", 0, 1)]).selectExpr("* except (STARTDATE)", "date(null) STARTDATE"), path)
    assert [r.STARTDATE for r in facts.read_fact(spark, path).collect()] == [None]
    facts.merge_fact(costs(spark, [("a", "x", 0, 1)]), path, day(0), day(0))
    assert facts.read_fact(spark, path).count() == 2


def test_log_is_read_from_its_last_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commit_log, "SNAPSHOT_EVERY", 3)
    log = Log(spark, str(tmp_path))
    for n in range(8):
        assert log.commit(State(), Commit("append", f"p{n}", {"2024-01-01": n}), lambda _: False)
    names = {p.name for p in (tmp_path / "_log").iterdir() if not p.name.startswith(".")}
    assert {n for n in names if n.endswith(".state")} == {f"{n:020d}.state" for n in (3, 6)}
    assert log.state() == State(8, {"2024-01-01": [f"p{n}" for n in range(8)]}, {})
    # The commits before the last state are not needed.
    for n in range(1, 7):
        (tmp_path / "_log" / f"{n:020d}.json").unlink()
    assert log.state().version == 8


def test_a_number_is_taken_once(spark, tmp_path):
    log = Log(spark, str(tmp_path))
    assert log.create("x.json", {"n": 1}) and not log.create("x.json", {"n": 2})
    assert json.loads((tmp_path / "_log" / "x.json").read_text()) == {"n": 1}
    # The way of other file systems: a rename that never overwrites.
    (tmp_path / "_log" / "a").write_text("a")
    log._rename(log._path("a"), log._path("b"))
    (tmp_path / "_log" / "c").write_text("c")
    with pytest.raises(FileExistsError):
        log._rename(log._path("c"), log._path("b"))
    assert (tmp_path / "_log" / "b").read_text() == "a"

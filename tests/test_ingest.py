import json
import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from frames import DAY0, costs, rows
from spendtide.__main__ import main, parse
from spendtide.config import JobConfig
from spendtide.functions.text import clean_tag
from spendtide.plans.daily_job import load_costs, run
from spendtide.plans.materialize import materialize, name_work_folder, work_folder
from spendtide.schema import COST_FACT
from spendtide.sources import day_table, facts, jdbc, landing
from spendtide.streaming.landing_stream import append_landed


def page(*days):
    """A page from (day, [(service, tag, amount)])."""
    return json.dumps({"ResultsByTime": [
        {
            "TimePeriod": {"Start": str(d), "End": str(d + timedelta(days=1))},
            "Groups": [
                {"Keys": [s, f"Name${t}"], "Metrics": {"UnblendedCost": {"Amount": a, "Unit": "USD"}}}
                for s, t, a in groups
            ],
        }
        for d, groups in days
    ]}, indent=1)


D1, D2 = date(2024, 5, 20), date(2024, 5, 21)


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "1.json").write_text(page((D1, [("a", "production", "1.5"), ("a", "", "1E-7")]), (D2, [])))
    (folder / "2.json").write_text(page((D1, [("b", "db", "-2")]), (D2, [("b", "db", "oops")])))
    return str(folder)


def test_pages_become_fact_rows(spark, pages):
    landed = landing.read_cost_pages(spark, pages)
    fact = landing.landed_costs(landed)
    assert fact.schema == COST_FACT or [f.dataType for f in fact.schema] == [f.dataType for f in COST_FACT]
    assert rows(fact, "SERVICE", "TAG", "STARTDATE", "ENDDATE", "USD", "WEEK") == [
        ("a", "", D1, D2, 1e-7, 21), ("a", "production", D1, D2, 1.5, 21),
        ("b", "db", D1, D2, -2.0, 21),
    ]
    assert rows(fact.select("METRIC", "GRANULARITY", "UNIT").distinct(), "*") == [("UnblendedCost", "DAILY", "USD")]
    (bad,) = landing.rejected(landed).collect()
    assert bad.reason == "unreadable amount" and "oops" in bad.raw


def line(*days):
    return json.dumps(json.loads(page(*days)))


def test_every_layout_of_pages_is_read(spark, tmp_path):
    """Five pages on lines, indented pages in a row, both in one file, two on a line."""
    days = [D1 + timedelta(days=n) for n in range(5)]
    five = "\n".join(line((d, [("lines", "t", "1")])) for d in days) + "\n"
    two = page((D1, [("indented } {", "t", "1")])) + "\n" + page((D2, [("indented", "t", "2")]))
    mixed = line((D1, [("mixed", "t", "1")])) + "\n" + page((D2, [("mixed", "t", "2")])) + "\n\n" + line((D2, [("mixed", "u", "3")]))
    same = line((D1, [("same", "t", "1")])) + line((D1, [("same", "t", "2")]))
    for name, text in {"a": five, "b": two, "c": mixed, "d": same, "e": "\n \n"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    landed = landing.read_cost_pages(spark, str(tmp_path))
    found = rows(landing.landed_costs(landed).groupBy("SERVICE").count(), "*")
    assert dict(found) == {"lines": 5, "indented": 1, "indented } {": 1, "mixed": 3, "same": 2}
    assert landing.rejected(landed).count() == 0


@pytest.fixture
def small_blocks(spark):
    """Files are read in blocks of a few lines, so pages run over many of them."""
    settings = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


NAMES = ["plain", "A}  {B", '{"ResultsByTime":', 'quo"te\\', "back\\", "}", "{{", "\u00e9 } {", '\\"}{']


def test_pages_of_any_layout_in_small_blocks(spark, tmp_path, small_blocks):
    """Random pages in random layouts, some cut off, against what was written."""
    rnd = random.Random(4)
    want, cut = [], 0
    for f in range(3):
        text = ""
        for n in range(14):
            name = rnd.choice(NAMES) + f" {f}-{n}"
            amounts = [str(rnd.randint(1, 99)) for _ in range(rnd.randint(1, 4))]
            whole = json.loads(page((D1, [(name, f"t{k}", a) for k, a in enumerate(amounts)])))
            if rnd.random() < 0.3:
                whole = {"NextPageToken": "x}{"} | whole
            written = json.dumps(whole, indent=rnd.choice([None, 0, 1, 4]), ensure_ascii=rnd.random() < 0.5)
            if rnd.random() < 0.2:
                # What is cut off ends with its line; the next page begins on a line of its own.
                written = written[: rnd.randint(40, len(written) - 30)].rstrip()
                cut += 1
                text += ("" if text.endswith("\n") or not text else "\n") + written + "\n"
                continue
            want += [(name, float(a)) for a in amounts]
            text += written + rnd.choice(["\n", "\n\n", "\r\n", "\n  \n"])
        (tmp_path / f"{f}.json").write_text(text, newline="")
    landed = materialize(landing.read_cost_pages(spark, str(tmp_path)), "landed")
    assert rows(landing.landed_costs(landed), "SERVICE", "USD") == sorted(want, key=lambda r: tuple(map(str, ((v is None, str(v)) for v in r))))
    assert cut > 4 and landing.rejected(landed).count() == cut


def test_a_group_holds_one_page(spark, tmp_path, small_blocks):
    """An indented file of many pages never comes together: no row is longer than a page."""
    one = page((D1, [(f"s{k}", "t", "1") for k in range(5)]))
    (tmp_path / "1.json").write_text("\n".join([one] * 200))
    lines = landing.with_place(landing.text_lines(spark.read, str(tmp_path)))
    raw = landing._pages_over_lines(lines)
    assert rows(raw.select(F.length("raw")).distinct(), "*") == [(len(one),)] and raw.count() == 200


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_pages_run_over_the_parts_of_a_block(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(landing, "PART_BITS", bits)
    test_pages_of_any_layout_in_small_blocks(spark, tmp_path, None)


def _window_spills(plan):
    """Bytes that each window of an executed plan has spilled."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _window_spills(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _window_spills(plan.plan())
    below = plan.children()
    own = [plan.metrics().get("spillSize").get().value()] if kind == "WindowExec" else []
    return own + [n for k in range(below.size()) for n in _window_spills(below.apply(k))]


def test_windows_over_lines_do_not_grow_with_the_block(spark, tmp_path):
    """A block of many lines: what no window keeps as it is would be spilled at once."""
    one = page((D1, [(f"s{k}", "t", "1") for k in range(5)]))
    (tmp_path / "1.json").write_text("\n".join([one] * 100))
    assert 4096 < one.count("\n") * 100
    spark.conf.set("spark.sql.windowExec.buffer.spill.threshold", "1000")
    try:
        lines = landing.with_place(landing.text_lines(spark.read, str(tmp_path)))
        raw = landing._pages_over_lines(lines)
        assert [r.raw for r in raw.collect()] == [one] * 100
    finally:
        spark.conf.unset("spark.sql.windowExec.buffer.spill.threshold")
    spills = _window_spills(raw._jdf.queryExecution().executedPlan())
    assert len(spills) > 3 and sum(spills) == 0


def test_a_page_without_an_end_is_cut(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(landing, "PAGE_BYTES", 1024)
    text = '{"ResultsByTime": [\n' + "1,\n" * 4000
    (tmp_path / "1.json").write_text(text + page((D1, [("a", "t", "1")])))
    landed = materialize(landing.read_cost_pages(spark, str(tmp_path)), "landed")
    bad = landing.rejected(landed)
    assert landing.landed_costs(landed).count() == 1 and bad.count() >= len(text) // 1400
    assert bad.agg(F.max(F.length("raw"))).first()[0] < 1600
    assert bad.agg(F.sum(F.length(F.replace("raw", F.lit("\n"), F.lit(""))))).first()[0] == len(text.replace("\n", ""))


def test_broken_pages_are_rejected_with_their_text(spark, tmp_path):
    cut = line((D1, [("a", "t", "1")]))[:60]
    (tmp_path / "1.json").write_text("\n".join([line((D1, [("a", "t", "1")])), cut, cut, '{"NextPageToken": "x"}']))
    (tmp_path / "2.json").write_text(page((D1, [("a", "t", "1")]))[:80])
    (tmp_path / "3.json").write_text(json.dumps({"ResultsByTime": [
        {"Groups": [{"Keys": ["no day", "Name$"], "Metrics": {"UnblendedCost": {"Amount": "1"}}}]},
        {"TimePeriod": {"Start": "2024-05-20"}, "Groups": [{"Keys": ["none", "Name$"], "Metrics": {}}]},
        {"TimePeriod": {"Start": "2024-05-20"}},
    ]}))
    landed = landing.read_cost_pages(spark, str(tmp_path))
    reasons = [r for (r,) in rows(landing.rejected(landed), "reason")]
    assert reasons == ["malformed page"] * 3 + ["no amount", "no groups", "no readable day", "no results in page"]
    assert landing.landed_costs(landed).count() == 1
    assert cut in [r for (r,) in rows(landing.rejected(landed), "raw")]


def test_missing_days(spark, pages):
    landed = landing.read_cost_pages(spark, pages)
    assert rows(landing.missing_days(landed, D1 - timedelta(days=1), D2), "*") == [(D1 - timedelta(days=1),)]


def test_load_stops_before_it_loses_spend(spark, pages, tmp_path):
    cfg = JobConfig(run_date=D2 + timedelta(days=1), overlap_days=1, landing_path=pages, fact_path=str(tmp_path / "fact"))
    with pytest.raises(ValueError, match="1 landed records cannot be read"):
        load_costs(spark, cfg)
    assert not (tmp_path / "fact").exists()
    assert spark.read.parquet(str(tmp_path / "fact-rejected")).first().reason == "unreadable amount"
    with pytest.raises(ValueError, match="2024-05-18, 2024-05-19"):
        load_costs(spark, replace(cfg, overlap_days=3, reject_tolerance=1))
    load_costs(spark, replace(cfg, reject_tolerance=1))
    assert facts.read_fact(spark, cfg.fact_path).count() == 3


def test_day_folders_are_pruned(spark, tmp_path):
    for d in (D1, D2):
        folder = tmp_path / f"day={d}"
        folder.mkdir()
        (folder / "1.json").write_text(page((d, [("a", "t", "1")])))
    pages = landing.read_cost_pages(spark, str(tmp_path), D2, D2)
    fact = landing.landed_costs(pages, D2, D2)
    scan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan
    assert rows(fact, "STARTDATE") == [(D2,)]


def test_command_line():
    cfg = parse(["--run-date", "2024-05-23", "--no-load-data", "--z-in", "2", "--gap-fill", "per_service"])
    assert cfg == JobConfig(run_date=date(2024, 5, 23), load_data=False, z_in=2.0, gap_fill="per_service")
    with pytest.raises(SystemExit):
        main(["--run-date", "2024-05-23"])


def test_tag_prefix(spark):
    df = spark.createDataFrame([("Name$production",), ("Name$abc",), ("Name$",), (None,)], "t string")
    got = rows(df.select(clean_tag(F.col("t")), clean_tag(F.col("t"), True)), "*")
    assert got == [("", ""), ("abc", ""), ("production", "ction"), (None, None)]


def test_export_headers(spark):
    old = spark.createDataFrame(
        [("a", "t", "UnblendedCost", "DAILY", "2024-05-20", "2024-05-21", "2.5", "USD")],
        list(landing.EXPORT_HEADERS),
    )
    new = landing.normalize_columns(old)
    assert rows(landing.to_fact(new), "SERVICE", "STARTDATE", "USD", "DAY") == [("a", D1, 2.5, 20)]
    assert landing.normalize_columns(new).columns == new.columns


def test_overlap_window(spark):
    first, last = landing.overlap_window(date(2024, 5, 22))
    assert (first, last) == (date(2024, 5, 15), date(2024, 5, 22))
    assert landing.overlap_window(date(2024, 5, 22), end_inclusive=False)[1] == date(2024, 5, 21)
    assert landing.expected_days(spark, first, last).count() == 8


def test_append_compact_overwrite(spark, tmp_path):
    path = str(tmp_path / "fact")
    week = costs(spark, [("a", "x", d, d) for d in range(7)])
    facts.append_fact(week, path)
    facts.append_fact(costs(spark, [("a", "x", 6, 6), ("a", "x", 6, 66), ("a", "x", 7, 7)]), path)
    assert facts.read_fact(spark, path).count() == 10
    facts.compact_fact(spark, path, DAY0 + timedelta(days=5), DAY0 + timedelta(days=9))
    once = rows(facts.read_fact(spark, path), "STARTDATE", "USD")
    assert len(once) == 9  # a restated amount stays beside the old one
    facts.compact_fact(spark, path, DAY0, DAY0 + timedelta(days=9))
    assert rows(facts.read_fact(spark, path), "STARTDATE", "USD") == once
    facts.overwrite_fact(costs(spark, [("z", "x", 0, 1)]), path)
    assert rows(facts.read_fact(spark, path), "SERVICE") == [("z",)]


def test_merge_is_idempotent_and_touches_its_days_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    first, last = DAY0 + timedelta(days=3), DAY0 + timedelta(days=6)
    facts.merge_fact(costs(spark, [("a", "x", d, 1) for d in range(5)]), path, DAY0, last)
    old = set((tmp_path / "fact").glob("part=*/STARTDATE=2024-01-01/*"))
    batch = costs(spark, [("a", "x", d, 2 if d == 4 else 1) for d in range(2, 7)])
    facts.merge_fact(batch, path, first, last)
    once = rows(facts.read_fact(spark, path), "STARTDATE", "USD")
    assert [(d.day, u) for d, u in once] == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (5, 2), (6, 1), (7, 1)]
    facts.merge_fact(batch, path, first, last)
    assert rows(facts.read_fact(spark, path), "STARTDATE", "USD") == once
    assert old and set((tmp_path / "fact").glob("part=*/STARTDATE=2024-01-01/*")) == old
    facts.merge_fact(batch, path, first, last, compact="latest")
    latest = rows(facts.read_fact(spark, path), "STARTDATE", "USD")
    assert [(d.day, u) for d, u in latest if d.day == 5] == [(5, 2)]


def test_a_load_that_breaks_off_leaves_the_old_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    last = DAY0 + timedelta(days=3)
    facts.merge_fact(costs(spark, [("a", "x", d, 1) for d in range(4)]), path, DAY0, last)
    facts.merge_fact(costs(spark, [("a", "x", 1, 5)]), path, DAY0, last)
    before = rows(facts.read_fact(spark, path), "STARTDATE", "USD")
    assert len(before) == 5
    write = day_table._write

    def broken(df, *where):
        write(df, *where)
        raise OSError("lost after the new days were written")

    monkeypatch.setattr(day_table, "_write", broken)
    with pytest.raises(OSError):
        facts.merge_fact(costs(spark, [("a", "x", 2, 7)]), path, DAY0, last, compact="latest")
    monkeypatch.undo()
    assert rows(facts.read_fact(spark, path), "STARTDATE", "USD") == before
    facts.merge_fact(costs(spark, [("a", "x", 2, 7)]), path, DAY0, last, compact="latest")
    after = rows(facts.read_fact(spark, path), "STARTDATE", "USD")
    assert [u for d, u in after if d.day == 3] == [7] and len(after) == 5
    assert len(list((tmp_path / "fact").glob("part=*"))) == 4
    facts.drop_old_versions(spark, path, min_age_seconds=3600)
    assert len(list((tmp_path / "fact").glob("part=*"))) == 4
    facts.drop_old_versions(spark, path)
    assert len(list((tmp_path / "fact").glob("part=*"))) == 1
    assert rows(facts.read_fact(spark, path), "STARTDATE", "USD") == after


def test_reading_days_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts.append_fact(costs(spark, [("a", "x", d, 1) for d in range(9)]), path)
    days = facts.read_fact(spark, path, DAY0 + timedelta(days=7), DAY0 + timedelta(days=8))
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(STARTDATE" in plan and days.count() == 2


def test_jdbc_slices_cover_every_day_once():
    slices = jdbc.date_slices(date(2024, 1, 1), date(2024, 1, 10), 3)
    assert slices[0].startswith("STARTDATE >= DATE '2024-01-01'")
    assert slices[-1].endswith("STARTDATE < DATE '2024-01-11'")
    ends = [s.split("< DATE ")[1] for s in slices]
    starts = [s.split(">= DATE ")[1].split(" AND")[0] for s in slices]
    assert ends[:-1] == starts[1:] and len(slices) == 3
    assert len(jdbc.date_slices(date(2024, 1, 1), date(2024, 1, 2), 8)) == 2


def test_stream_appends_each_page_once(spark, pages, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    append_landed(spark, pages, table, state).awaitTermination(120)
    assert facts.read_fact(spark, table).count() == 3
    days = [D1 + timedelta(days=n) for n in range(5)]
    five = "\n".join(line((d, [("c", "x", "3")])) for d in days)
    (tmp_path / "landing" / "3.json").write_text(five)
    append_landed(spark, pages, table, state).awaitTermination(120)
    assert rows(facts.read_fact(spark, table).where("SERVICE = 'c'"), "STARTDATE", "USD") == [(d, 3.0) for d in days]
    landed = facts.read_fact(spark, table)
    assert landed.count() == 8
    bad = spark.read.parquet(f"{table}-rejected")
    assert rows(bad, "reason") == [("unreadable amount",)]
    # The streamed table is merged like any other batch.
    facts.merge_fact(landed, str(tmp_path / "fact"), D1, days[-1])
    facts.merge_fact(landed, str(tmp_path / "fact"), D1, days[-1])
    assert rows(facts.read_fact(spark, str(tmp_path / "fact")), "*") == rows(landed, "*")


class _Session:
    """A session without a checkpoint folder."""

    def __init__(self):
        self.conf, self.sparkContext = {}, self

    def getCheckpointDir(self):
        return None


def test_work_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    kept = materialize(spark.range(5), "five")
    assert work_folder(spark) == shared and shared in kept.inputFiles()[0]
    assert kept.count() == 5
    with pytest.raises(ValueError):
        work_folder(_Session())


class _Cluster(_Session):
    """One on a cluster, with the warehouse given."""

    def __init__(self, warehouse):
        self.conf, self.sparkContext, self.master = {"spark.sql.warehouse.dir": warehouse}, self, "spark://host:7077"

    def setCheckpointDir(self, path):
        self.named = path


def test_no_work_folder_on_one_machine_of_a_cluster():
    for warehouse in ("file:/tmp/warehouse", "/tmp/warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            name_work_folder(_Cluster(warehouse))
    shared = _Cluster("hdfs://host/warehouse/")
    name_work_folder(shared)
    assert shared.named == "hdfs://host/warehouse/_work"


def test_daily_run_end_to_end(spark, tmp_path):
    landed = tmp_path / "landing"
    landed.mkdir()
    day = date(2024, 5, 22)
    history = [("Compute", "web", day - timedelta(days=n), 10 + n % 3) for n in range(8, 300)]
    history += [("Store", "db", day - timedelta(days=n), 5 + n % 2) for n in range(8, 300)]
    facts.append_fact(costs(spark, history), str(tmp_path / "fact"))
    for n in range(8):
        d = day - timedelta(days=n)
        amount = "90.5" if n == 0 else "11"
        (landed / f"{d}.json").write_text(page((d, [("Compute", "web", amount), ("Store", "db", "5")])))
    cfg = JobConfig(
        run_date=day + timedelta(days=1), landing_path=str(landed), fact_path=str(tmp_path / "fact"),
        output_path=str(tmp_path / "out"), base_url="https://charts", public=False,
    )
    result = run(spark, cfg)
    assert rows(result.alerts.svc_spike_alerts, "SERVICE", "date") == [("Compute", day)]
    assert rows(result.alerts.tag_spike_alerts, "SERVICE", "TAG") == [("Compute", "web")]
    texts = rows(result.message_rows.where("section_no = 3"), "text", "link")
    assert texts == [("Compute", "amz_tot_Compute_20240522")]
    out = tmp_path / "out"
    charts = spark.read.parquet(str(out / "charts" / "spike"))
    assert charts.count() == 300 and charts.first().chart_id == "amz_tot_Compute_20240522"
    sent = spark.read.json(str(out / "messages")).first()
    assert sent.channel == "private" and json.loads(sent.blocks)[0]["type"] == "rich_text"
    assert sent.message_no == 1 and sent.as_of == day
    total = spark.read.parquet(str(out / "total_by_service")).where("SERVICE = 'Compute'").first()
    may = facts.read_fact(spark, str(tmp_path / "fact")).where("SERVICE = 'Compute' AND MONTH = 5 AND YEAR = 2024")
    assert total.TOTAL_SPEND == pytest.approx(may.agg(F.sum("USD")).first()[0])
    # The run of another day leaves this day's outputs alone.
    kept = {p: p.stat().st_mtime_ns for p in out.rglob("as_of=2024-05-22/*.parquet")}
    run(spark, replace(cfg, run_date=day, load_data=False))
    assert len({p.parent.name for p in out.rglob("*.parquet")}) == 2
    assert all(p.stat().st_mtime_ns == t for p, t in kept.items()) and len(kept) >= 9
    # A second load of the same day changes nothing.
    before = facts.read_fact(spark, cfg.fact_path).count()
    load_costs(spark, cfg)
    assert facts.read_fact(spark, cfg.fact_path).count() == before == 600

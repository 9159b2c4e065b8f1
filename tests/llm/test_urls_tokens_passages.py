"""URL lists in time, token totals, repeated passages."""

import random
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import numpy as np
from pyspark.sql import functions as F

from spendtide.llm import sentencepieces, substring_dedup, token_counts, url_filter

from test_dedup import documents

FOLDER = "/root/testdata/sf0.01"


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


def test_url_verdicts(spark):
    entries = spark.createDataFrame(
        [("Bad.org.", "block", day(3), 1), ("bad.org", None, day(10), 1), ("bad.org", "block", day(20), 1),
         ("ok.bad.org", "allow", day(4), 1), ("org", "watch", day(1), 1), ("tie.com", "allow", day(2), 1),
         ("tie.com", "block", day(2), 1), ("tie.com", None, day(2), 1), (None, "block", day(1), 1),
         ("x.com", "block", None, 1)],
        "rule string, action string, at timestamp, since int",
    )
    captures = [
        (1, "http://www.bad.org/x", day(2), "org"), (2, "http://www.bad.org/x", day(3), "bad.org"),
        (3, "https://u:p@BAD.org:80/?q=http://ok.bad.org", day(9, 23), "bad.org"),
        (4, "http://bad.org", day(10), "org"), (5, "http://bad.org", day(25), "bad.org"),
        (6, "http://a.ok.bad.org#f", day(25), "ok.bad.org"), (7, "http://tie.com", day(2), "tie.com"),
        (8, "http://notbad.org", day(5), "org"), (9, "http://x.com", day(5), None),
        (10, "no url", day(5), None), (11, None, day(5), None), (12, "http://bad.org", None, None),
        (None, "http://bad.org", day(5), "bad.org"), (2, "http://www.bad.org/x", day(3), "bad.org"),
    ]
    named = "page_id long, url string, fetched_at timestamp, want string, rule int, host int"
    table = spark.createDataFrame([(*c, 1, 1) for c in captures], named)
    found = url_filter.verdicts(table, entries).collect()
    assert Counter((r.page_id, r.rule) for r in found) == Counter((c[0], c[3]) for c in captures)
    assert {r.action for r in found if r.page_id == 7} == {"block"}
    assert url_filter.verdicts(table.limit(0), entries).isEmpty()
    assert all(r.rule is None for r in url_filter.verdicts(table, entries.limit(0)).collect())


def test_url_verdicts_against_all_entries(spark):
    """Random lists and captures, some rules with very many entries, against every entry."""
    rng = random.Random(6)
    names = ["a.org", "b.a.org", "c.b.a.org", "org", "x.com", "com"]
    start = datetime(2024, 1, 1)
    entries = [
        (rng.choice(names), rng.choice(["block", "allow", None]), start + timedelta(minutes=rng.randrange(60 * 24 * 9)))
        for _ in range(400)
    ]
    captures = [
        (k, f"https://{rng.choice(['', 'www.'])}{rng.choice(names)}/", start + timedelta(minutes=rng.randrange(60 * 24 * 10)))
        for k in range(600)
    ]

    def plain(url, at):
        labels = url.removeprefix("https://").rstrip("/").split(".")
        for k in range(len(labels)):
            rule = ".".join(labels[k:])
            past = [(e[2], e[1] or "") for e in entries if e[0] == rule and e[2] <= at]
            if past and max(past)[1]:
                return rule, max(past)[1], max(past)[0]
        return None, None, None

    found = url_filter.verdicts(
        spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp"),
        spark.createDataFrame(entries, "rule string, action string, at timestamp"),
    ).collect()
    assert {r.page_id: (r.rule, r.action, r.since) for r in found} == {k: plain(u, at) for k, u, at in captures}


def totals(rollup):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_token_totals(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "a b  c", "en", "s", 1), (2, None, "en", "s", 1), (3, "d\te", None, None, 1), (3, "d\te", None, None, 1)],
        "doc_id long, text string, lang string, source string, tokens int",
    )
    counts = token_counts.counted_words(docs)
    rollup = token_counts.Rollup(spark, str(tmp_path / "totals"))
    assert totals(rollup) == {} and rollup.commits().isEmpty()
    assert rollup.apply("one", token_counts.inserts(counts))
    first = {("s", "en", "words"): (2, 3), (None, None, "words"): (2, 4)}
    assert totals(rollup) == first
    assert not rollup.apply("one", token_counts.inserts(counts)) and totals(rollup) == first
    # A batch that broke off after its sums were written counts for nothing, then once.
    broken = token_counts.deletes(counts.where("doc_id = 3"))
    sums = broken.groupBy(*token_counts.KEYS).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").alias("tokens"))
    rollup._write(sums)
    assert totals(rollup) == first
    assert rollup.apply("two", broken)
    assert totals(rollup) == {("s", "en", "words"): (2, 3)}
    pairs = counts.where("doc_id < 3").selectExpr("source", "lang", "version", "tokens AS old_tokens", "10 AS new_tokens")
    rollup.apply("three", token_counts.revisions(pairs))
    assert totals(rollup) == {("s", "en", "words"): (2, 20)}
    assert rollup.apply("none", token_counts.inserts(counts.limit(0))) and rollup.commits().count() == 4


def test_token_query_against_plain_sums(spark):
    from spendtide.llm.queries import op6_token_counts
    found = {(r.source, r.lang, r.version): (r.docs, r.tokens)
             for r in op6_token_counts(spark, FOLDER).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{FOLDER}/documents.parquet' ORDER BY 1").fetchall()
    last = {}
    for key, text, *_ in rows:
        last["".join(c.lower() if "A" <= c <= "Z" else c for c in text)] = key
    pieces, want = sentencepieces.Pieces.load(), Counter()
    for key, text, source, lang in rows:
        if key in last.values():
            words = sum(any(c.isalpha() or c.isdecimal() for c in w) for w in text.split())
            for version, n in (("words", words), ("pieces", len(sentencepieces.encode_texts(pieces, [text])[0]))):
                want[source, lang, version, 0] += 1
                want[source, lang, version, 1] += n
    assert found == {k[:3]: (want[(*k[:3], 0)], want[(*k[:3], 1)]) for k in want}


def test_totals_are_folded(spark, tmp_path, monkeypatch):
    """However many batches there were, totals read one folded part and few others."""
    monkeypatch.setattr(token_counts, "FOLD", 5)
    one = spark.createDataFrame([("s", "en", "words", 1, 7)], "source string, lang string, version string, docs long, tokens long")
    rollup = token_counts.Rollup(spark, str(tmp_path / "totals"))
    for n in range(23):
        assert rollup.apply(f"batch {n}/é", one)
        assert totals(rollup) == {("s", "en", "words"): (n + 1, 7 * (n + 1))}
    assert all(not rollup.apply(f"batch {n}/é", one) for n in (0, 4, 5, 21, 22))
    part, folded, rest, folds = rollup._state()
    assert (len(folded), len(rest), folds) == (20, 3, 4) and part
    assert len(rollup.totals().inputFiles()) <= 5 and rollup.commits().count() == 23


def test_token_query_counts_rows(spark):
    """Null, repeated and equal rows against plain sums."""
    from spendtide.llm.queries import _token_totals
    rows = [(1, "a b c", "s", "en"), (2, "x y", "s", "en"), (2, "x y", "t", "en"), (2, "x y", "s", "en"),
            (None, "n n n n", "s", None), (None, "n n n n", "s", None), (None, None, None, None), (3, "", "s", "en"),
            (4, "X Y", "s", "de"), (2, "other - text", "s", "en"), (5, "same id " * 3, "u", "en"), (5, "same id " * 3, "u", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    wide = docs.withColumns({c: F.lit(1) for c in ("row", "kept", "digest", "words", "n_pieces", "id")})
    best = {}
    for k, (key, text, *_) in enumerate(rows):
        same = (text or "").lower()
        best[same] = max(best.get(same, (-2, 0)), (-1 if key is None else key, k))
    for frame in (docs.coalesce(1), wide.coalesce(1)):
        found = {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in _token_totals(spark, frame).collect()}
        pieces, want = sentencepieces.Pieces.load(), Counter()
        for _, k in best.values():
            _, text, source, lang = rows[k]
            words = sum(any(c.isalpha() or c.isdecimal() for c in w) for w in (text or "").split())
            for version, n in (("words", words), ("pieces", len(sentencepieces.encode_texts(pieces, [text or ""])[0]))):
                want[source, lang, version, 0] += 1
                want[source, lang, version, 1] += n
        assert found == {k[:3]: (want[(*k[:3], 0)], want[(*k[:3], 1)]) for k in want}


def plain_boundaries(text):
    """Ends by the definition, place for place."""
    sums = []
    for k in range(len(text)):
        h = 0
        for byte in text[max(0, k - 15) : k + 1]:
            h = (2 * h + int(substring_dedup.GEAR[byte])) % 65536
        sums.append(h)
    r = substring_dedup.RADIUS
    ends = []
    for k, h in enumerate(sums):
        if all(h <= x for x in sums[max(0, k - r) : k] + sums[k + 1 : k + 1 + r]):
            if not ends or k + 1 - ends[-1] >= r:
                ends.append(k + 1)
    return ends if ends[-1:] == [len(text)] else ends + [len(text)]


def test_boundaries():
    rng = random.Random(5)
    for size in [1, 2, 15, 16, 17, 33, 40, 300, 1000]:
        text = bytes(rng.randrange(97, 102) for _ in range(size))
        assert substring_dedup.boundaries(np.frombuffer(text, np.uint8)).tolist() == plain_boundaries(text)
    assert substring_dedup.boundaries(np.frombuffer(b"", np.uint8)).tolist() == []
    assert substring_dedup.boundaries(np.frombuffer(b"a" * 5000, np.uint8))[-1] == 5000


def test_passages(spark):
    """All repeated passages of more than 50 words are found, and no document without one."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    rng = random.Random(2)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(51))
    rows += [(5000 + k, " ".join(f"w{rng.random()}" for _ in range(k * 7)) + f" {passage} end{k}") for k in range(30)]
    rows += [(6000, passage), (6001, "alone " * 300), (6002, None), (6003, ""), (None, passage), (6004, "x" * 9000)]
    found = substring_dedup.repeated_passages(documents(spark, rows)).collect()
    mine = {r.doc_id for r in found}

    def shared(size):
        seen = {}
        for key, text in rows:
            words = (text or "").split()
            for k in range(len(words) - size + 1):
                seen.setdefault(tuple(words[k : k + size]), []).append(key)
        return {key for keys in seen.values() if len(keys) > 1 for key in keys}

    assert shared(51) - mine == set()
    assert mine <= shared(20)
    texts = {key: (text or "").encode() for key, text in rows}
    assert all(r.start + r.size <= len(texts[r.doc_id]) and r.words >= 20 for r in found)
    (own,) = [r for r in found if r.doc_id == 6001]  # repeats itself
    assert own.words > 250 and 0 < own.kept_bytes < own.size
    of_passage = [r for r in found if r.doc_id is None or r.doc_id >= 5000 and r.doc_id != 6001]
    assert len(of_passage) == 32 and {r.copies for r in of_passage} == {32}
    assert 1 <= sum(r.kept_bytes > 0 for r in of_passage) <= 6  # chunks at its ends differ


def test_passage_edge_cases(spark):
    assert substring_dedup.repeated_passages(documents(spark, [])).isEmpty()
    text = " ".join(f"v{k * k}" for k in range(80))
    for rows in ([(1, text), (1, text)], [(None, text), (None, text)]):  # equal rows repeat each other
        found = substring_dedup.repeated_passages(documents(spark, rows)).collect()
        assert len(found) == 2 and sorted(r.kept_bytes for r in found) == [0, len(text)]
    found = substring_dedup.repeated_passages(documents(spark, [(1, text), (1, text), (1, text + " more")])).collect()
    assert len(found) == 3 and {r.words for r in found} <= set(range(60, 81))
    assert sum(r.kept_bytes > 0 for r in found) in (1, 2)  # the last chunk may differ


def test_passages_inside_one_document(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(70))
    other = [" ".join(f"o{rng.random()}" for _ in range(40)) for _ in range(3)]
    found = substring_dedup.repeated_passages(documents(spark, [(1, f"{other[0]} {passage} {other[1]} {passage} {other[2]}")])).collect()
    assert len(found) == 2 and all(55 <= r.words <= 70 for r in found)
    first, second = sorted(found, key=lambda r: r.start)
    assert first.kept_bytes == first.size and second.kept_bytes == 0


def test_periodic_passages(spark):
    """Passages that repeat one word, of any short period, in different surroundings."""
    rng = random.Random(10)
    for word in ("a", "der", "equal", "sixteen chars ok", "ab ab abc", "longer than sixteen bytes"):
        passage = " ".join([word] * 60)
        rows = [(k, " ".join(f"x{rng.random()}" for _ in range(rng.randrange(3, 30))) + f" {passage} y{rng.random()}")
                for k in range(4)]
        found = substring_dedup.repeated_passages(documents(spark, rows)).collect()
        words = Counter()
        for r in found:
            words[r.doc_id] += r.words
        assert set(words) == {0, 1, 2, 3}, word
        assert all(n >= len(passage.split()) - 30 for n in words.values()), (word, words)

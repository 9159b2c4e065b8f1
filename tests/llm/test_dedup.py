"""Exact and near duplicates against brute force."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from spendtide.llm import exact_dedup, simhash
from spendtide.llm.components import components

FOLDER = "/root/testdata/sf0.001"
CASES = [
    (5, "Same Text"), (9, "same text"), (9, "same text"), (None, "SAME text"), (2, ""),
    (3, None), (4, "Été"), (8, "été"), (None, None), (7, "x" * 30_000), (6, "X" * 30_000),
]


def documents(spark, rows):
    """Rows (id, text) with columns that operators use as names of their own."""
    named = "doc_id long, text string, id string, digest string, fp long, keep_id long, row int, check int"
    return spark.createDataFrame([(*r, "a", "b", 1, 2, 3, 4) for r in rows], named)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected_copies(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[lower(text)].append(-1 if key is None else key)
    found = []
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        keep = max(ids)
        seen = False
        for key in sorted(ids, reverse=True):
            found.append((key, keep, len(ids), not seen, sha))
            seen = True
    return sorted(found)


@pytest.mark.parametrize("heavy", [1024, 1])
def test_exact_dedup(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    rows = CASES + [(k, "Many Copies") for k in range(100, 400)]
    found = exact_dedup.exact_dedup(documents(spark, rows)).collect()
    mine = sorted(
        (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], *r[2:]) for r in found
    )
    assert mine == expected_copies(rows)
    kept = exact_dedup.drop_copies(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(
        r[0] for r in expected_copies(rows) if r[3]
    )


def test_heavy_groups_are_found(spark):
    rows = [(k, f"t{k}") for k in range(300)] + [(k, "hot") for k in range(300, 600)]
    digests = documents(spark, rows).select("doc_id", "text")
    digests = digests.selectExpr("doc_id AS id", "sha2(text, 256) AS digest")
    heavy = exact_dedup.heavy_digests(digests).collect()
    assert (599, 300) in [(r.keep_id, r.group_size) for r in heavy]


def test_empty_tables(spark):
    none = documents(spark, [])
    assert exact_dedup.exact_dedup(none).isEmpty() and exact_dedup.drop_copies(none).isEmpty()
    assert simhash.near_duplicates(none).isEmpty() and simhash.drop_near_duplicates(none).isEmpty()


def plain_fingerprint(text, words=3):
    parts = [w for w in lower(text).replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(parts[k : k + words]) for k in range(len(parts) - words + 1)]
    shingles = shingles or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def reach(nodes, linked):
    """Smallest node in reach of each node."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def test_fingerprints():
    for text in ["", " \t", "one", "One two", "a b c", "a b\x0bc d e", "É a b c É" * 9]:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def pairs_within(fps, radius=3):
    fps = sorted(fps)
    values = np.array(fps, np.uint64)
    return [
        (a, fps[j]) for i, a in enumerate(fps)
        for j in i + 1 + np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius)
    ]


def test_components_of_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    rows += CASES[:3] + [(1000, "a"), (1001, "")]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    fps = {text: plain_fingerprint(text) for _, text in rows}
    top = reach(set(fps.values()), pairs_within(set(fps.values())))
    least = {}
    for key, text in rows:
        least[top[fps[text]]] = min(key, least.get(top[fps[text]], key))
    assert sorted(map(tuple, found)) == sorted(
        (key, f"{fps[text]:016x}", least[top[fps[text]]]) for key, text in rows
    )


def test_links_reach_all_and_only_near_fingerprints(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    fps = set(map(int, base))
    for value in map(int, base):
        for flips in (1, 2, 3, 3, 3, 4, 4, 6):
            for bit in rng.choice(64, flips, replace=False):
                value ^= 1 << int(bit)
            fps.add(value)
    ball = int(base[0])
    fps |= {ball ^ 1 << a ^ 1 << b for a in range(12) for b in range(40, 52)}  # one dense group
    signed = [v - (1 << 64) if v >> 63 else v for v in fps]
    linked = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    edges = [(r.a % 2**64, r.b % 2**64) for r in linked.collect()]
    assert all((a ^ b).bit_count() <= 3 and a != b for a, b in edges)
    assert reach(fps, edges) == reach(fps, pairs_within(fps))
    assert len(edges) < 20 * len(fps)


def test_long_chain_is_one_component(spark):
    chain = spark.range(1, 400).selectExpr("id AS a", "id + 1 AS b")
    ring = spark.createDataFrame([(-5, -4), (-4, -3), (-3, -5), (900, 900)], "a long, b long")
    roots = {r.node: r.root for r in components(chain.union(ring)).collect()}
    assert set(roots) == set(range(1, 401)) | {-5, -4, -3}
    assert all(root == (1 if node > 0 else -5) for node, root in roots.items())


def test_near_duplicates_edge_cases(spark):
    found = simhash.near_duplicates(documents(spark, CASES)).collect()
    assert len(found) == len(CASES)
    by_id = {r.doc_id: r.component_id for r in found if r.doc_id is not None}
    assert by_id[5] == by_id[9] == 5  # the null id is in the group, but below no other
    assert by_id[2] == by_id[3] == 2 and by_id[6] == by_id[7] == 6
    kept = simhash.drop_near_duplicates(documents(spark, CASES))
    assert kept.columns == documents(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 8]
    twice = documents(spark, [(1, "a b c d"), (1, "a b c d"), (None, "q r s"), (None, "q r s")])
    assert len(simhash.drop_near_duplicates(twice).collect()) == 2


def test_components_without_an_id_of_their_own_stay_apart(spark):
    texts = ["a b c d e f", "q r s t u v", "k l m n o p"]
    rows = [(None, t) for t in texts] + [(1, "one two three four five"), (1, "six seven eight nine ten")]
    rows += [(None, texts[0]), (None, "one two three four five"), (2, "eleven twelve thirteen")]
    kept = simhash.drop_near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted(
        [(0, t) for t in texts] + [(k, t) for k, t in rows if k]
    )

"""The pipeline against a plain version, and its stages on awkward rows."""

import corpus_pipeline
import duckdb
import numpy as np
from pyspark.sql import functions as F

from spendtide.llm import decontaminate, quality, sentencepieces

from test_dedup import documents, lower, pairs_within, plain_fingerprint, reach

FOLDER = "/root/testdata/sf0.001"


def plain_pipeline(model):
    """Ids of the documents that stay, by loops over plain rows."""
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())

    def good(text):
        words = quality.Words()
        row = words.of(text.encode())
        owner, flat = words.features()
        outs = [model.margin[flat[owner == w]].astype(float) for w in row]
        out = sum(o.sum() for o in outs) / sum(map(len, outs)) if outs else 0.0
        return 1 / (1 + np.exp(-(out + model.offset))) >= quality.KEEP_FROM

    docs = {k: t for k, t in docs.items() if good(t)}
    last = {}
    for key, text in docs.items():
        last[lower(text)] = max(key, last.get(lower(text), key))
    docs = {k: docs[k] for k in last.values()}
    fps = {k: plain_fingerprint(t) for k, t in docs.items()}
    top = reach(set(fps.values()), pairs_within(set(fps.values())))
    first = {}
    for key in docs:
        first[top[fps[key]]] = min(key, first.get(top[fps[key]], key))
    docs = {k: docs[k] for k in first.values()}
    items = [decontaminate.words_of(t.encode()) for t, in
             duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()]
    return {
        k for k, t in docs.items()
        if not any(
            decontaminate.distance_within(i, decontaminate.words_of(t.encode()), decontaminate.edits_allowed(len(i)))
            for i in items
        )
    }


def test_pipeline_against_plain_loops(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = found.collect()
    assert {r.doc_id for r in rows} == plain_pipeline(model) and len({r.doc_id for r in rows}) == len(rows)
    assert found.columns[: len(docs.columns)] == docs.columns
    pieces = sentencepieces.Pieces.load()
    assert all(r.round_trip for r in rows)
    for r in rows[:40]:
        assert r.piece_ids == sentencepieces.encode_texts(pieces, [r.text])[0].tolist()


def test_stages_on_awkward_rows(spark):
    prose = duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet' WHERE doc_id = 1").fetchall()[0][0]
    rows = [(1, prose), (1, prose), (2, prose.upper()), (None, prose + " x"), (None, None), (3, None), (4, ""),
            (5, prose * 300)]
    docs = documents(spark, rows)
    docs = docs.withColumns({c: F.lit(1) for c in ("n", "_row", "k", "score", "edits", "component_id", "piece")})
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept.columns
        kept = stage(spark, kept, FOLDER)
        assert kept.columns[: len(before)] == before, name
        kept = kept.drop("piece_ids", "n_pieces", "round_trip")
    texts = [r.text for r in kept.collect()]
    assert len(texts) == len({lower(t) for t in texts}) and set(texts) <= {t for _, t in rows}

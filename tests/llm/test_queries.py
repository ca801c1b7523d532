"""The registered queries against their SQL, and the pipeline stage by stage against brute force."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from pricemart.llm.queries import QUERIES, SQL
from brute import brute_near


def plain(value):
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, name):
    db = duckdb.connect()
    for path in Path(tables).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, tables)
    result = db.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    assert rows == sorted(tuple(map(plain, r)) for r in result.fetchall()) and rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_every_document_once(spark, tables, name):
    rows = QUERIES[name](spark, tables).collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    if name == "op9_sentencepiece":
        assert all(r["exact"] for r in rows)
    if name == "op4_quality_classifier":
        assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_pipeline_stage_by_stage(spark, tables, tmp_path):
    docs = before = spark.read.parquet(f"{tables}/documents.parquet")
    seen = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tables).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        seen[name] = docs.collect()
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
    assert list(seen) == ["quality classifier", "exact dedup", "minhash near-dedup", "source mix", "sentencepiece"]

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    good = {r["doc_id"] for r in seen["quality classifier"]}
    assert sum((i in good) == (q == 1) for i, q in labels.items()) >= 0.97 * len(labels)

    best = {}
    for r in seen["quality classifier"]:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"])
        best[key] = min(best.get(key, (0, 10**9)), (-len(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in seen["exact dedup"]) == sorted(i for _, i in best.values())

    rows = sorted(seen["exact dedup"], key=lambda r: r["doc_id"])
    kept = [r["doc_id"] for r, (_, _, k) in zip(rows, brute_near([r["text"] for r in rows], 5, 80)) if k]
    assert sorted(r["doc_id"] for r in seen["minhash near-dedup"]) == kept

    assert {r["doc_id"] for r in seen["source mix"]} <= set(kept)
    assert sorted(r["doc_id"] for r in seen["sentencepiece"]) == sorted(r["doc_id"] for r in seen["source mix"])
    assert all(r["exact"] and r["ids"] for r in seen["sentencepiece"])


def test_pipeline_of_nothing(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0

"""Queries of the subpackage against their SQL, and the pipeline."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from pagewright.llm.queries import ORACLE, QUERIES

TABLES = "documents labels benchmark".split()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, folder, name):
    frame = QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    ours = Counter(tuple(repr(v) for v in row) for row in frame.select(*columns).collect())
    relation = duck.execute(ORACLE[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(repr(row[names.index(c)]) for c in columns) for row in relation.fetchall())
    assert ours == theirs


def test_every_dealt_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_pipeline_stages_take_effect(spark, folder, documents):
    import corpus_pipeline

    before = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = corpus_pipeline.run(spark, folder).collect()
    kept = [r["text"] for r in rows]
    assert 0 < len(set(kept)) < len(before)
    assert all(before[r["doc_id"]] == r["text"] and len(r["pieces"]) > 0 for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(set(kept))
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 2

"""Every registered query against its SQL counterpart on the same tables."""

import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from pagewright import plans
from pagewright.plans import stream_queries, views

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = plans.QUERIES, plans.ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return repr(value) if isinstance(value, (bool, float)) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = Counter(tuple(plain(v) for v in row) for row in frame.select(*columns).collect())
    relation = duck.execute(SQL[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in places) for row in relation.fetchall())
    assert ours == theirs


def test_parts_grow_with_the_rows(spark, duck, monkeypatch):
    """What a task holds depends on the rows per part, not on the size of the table."""
    monkeypatch.setattr(views, "ROWS_PER_TASK", 8)
    documents = views.Views(spark, FOLDER).documents
    assert documents.rdd.getNumPartitions() == -(-documents.count() // 8)
    for name in ("fidelity_exploded", "page_rotation", "doc_rotation", "rotation_audit", "rotated_top"):
        test_same_rows(spark, duck, name)


def test_batches_of_many_files(spark, duck, monkeypatch):
    """A batch arrives in as many files as its rows ask for, files without a row included, and none of the next batch with it."""
    monkeypatch.setattr(stream_queries, "ROWS_PER_FILE", 3)
    names, schema = [], stream_queries.DOCUMENTS
    monkeypatch.setattr(stream_queries.flows, "read_table_stream", lambda spark, path, *rest, **options: names.append((path, options)))
    stream_queries._arrivals(views.Views(spark, FOLDER), "documents", schema, "doc_id", "doc_id")
    (path, options), rows = names[0], spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    files = -(-rows // 15)
    assert options["files_per_trigger"] == files and len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 5 * files
    arrived = sorted((os.stat(f"{path}/{f}").st_mtime_ns, f) for f in os.listdir(path) if f.endswith(".parquet"))
    batches = [[f"{path}/{f}" for _, f in arrived[i * files:(i + 1) * files]] for i in range(5)]
    ends = [spark.read.schema(schema).parquet(*b).selectExpr("min(doc_id)", "max(doc_id)").first() for b in batches]
    places = [end for pair in ends for end in pair if end is not None]
    assert len(places) > 2 and places == sorted(places)
    monkeypatch.undo()
    monkeypatch.setattr(stream_queries, "ROWS_PER_FILE", 50)
    for name in ("stream_quarantine", "stream_budget", "stream_usage_daily"):
        test_same_rows(spark, duck, name)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())

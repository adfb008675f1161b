from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from pagewright.llm import exact_dedup, mixing, near_dedup, pieces, queries, token_rollup
from pagewright.session import workspace


def test_exact_groups_of_odd_rows(odd, nothing):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == 11
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["keep_id"] == 6 and by_id[3]["group_size"] == 3 and not by_id[3]["kept"]
    assert by_id[1]["keep_id"] == 2 and by_id[2]["kept"]
    assert by_id[None]["keep_id"] is None and by_id[None]["kept"]
    assert exact_dedup.exact_groups(nothing).count() == 0


@pytest.mark.parametrize("runs,fan_in", [(1, 2), (7, 2), (64, 8)])
def test_tree_shape_does_not_matter(documents, runs, fan_in):
    small = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(documents, "smallest", runs, fan_in).collect()}
    least = defaultdict(list)
    rows = documents.select("doc_id", "text").collect()
    for r in rows:
        least[r["text"] or ""].append(r["doc_id"])
    assert small == {r["doc_id"]: min(least[r["text"] or ""]) for r in rows}


def test_drop_exact_copies_keeps_columns(odd):
    left = exact_dedup.drop_exact_copies(odd)
    assert left.columns == odd.columns
    texts = [r["text"] or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) == 7


def brute_targets(sizes, weights=(5, 2, 1)):
    """Shares by weight; what lies above twice a source's size is dealt out again until none is above."""
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    target, open_, left = {}, set(sources), 1.5 * sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if share * weight[s] >= 2 * sizes[s]}
        if not above:
            target.update({s: share * weight[s] for s in open_})
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_mix_against_brute_force(documents):
    rows = mixing.mix_plan(documents).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    wanted = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(wanted[s]) and taken[s] == int(target[s])
    assert rows and sorted(rows) == sorted(mixing.mix_plan(documents.repartition(5)).collect())


def test_mix_of_odd_rows(odd, nothing):
    rows = mixing.mix_plan(odd).collect()
    assert len(rows) == 11 and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix_plan(nothing).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_rollup_is_additive_and_idempotent(spark, odd):
    store = workspace(spark, "rollup")
    first = token_rollup.upserts(odd, "v1")
    gone = token_rollup.deletes(odd.filter("doc_id = 7"))
    more = token_rollup.upserts(odd.filter("doc_id = 5").selectExpr("doc_id", "'a b c d' AS text", "lang", "source"), "v1")
    for batch, changes in ((1, first), (2, gone), (3, more), (2, gone), (3, more), (3, more)):
        token_rollup.commit(spark, store, batch, changes)
    rows = {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in token_rollup.totals(spark, store).collect()}
    assert rows[("b", "de")] == (1, 4)
    assert rows[("c", "en")] == (1, 30_000)
    assert rows[(None, "en")] == (1, 1)
    assert rows[("a", None)] == (1, 0)


def test_rollup_without_batches(spark):
    assert token_rollup.totals(spark, workspace(spark, "rollup")).count() == 0


def test_rollup_counts_rows_without_id(spark):
    store = workspace(spark, "rollup")
    schema = "doc_id long, text string, lang string, source string"
    rows = spark.createDataFrame([(None, "a b c", "en", "s"), (None, "a b c", "en", "s"), (1, "a", "en", "s")], schema)
    later = spark.createDataFrame([(None, "d", "en", "s"), (1, "a b", "en", "s")], schema)
    for batch, docs in ((1, rows), (2, later), (2, later)):
        token_rollup.commit(spark, store, batch, token_rollup.upserts(docs, "v1"))
    assert [(r["docs"], r["tokens"]) for r in token_rollup.totals(spark, store).collect()] == [(4, 9)]


def test_stages_keep_columns_of_any_name(spark):
    """Every helper name of the pipeline's stages as an extra column."""
    names = "_id _sha _kept_id _kept_sha _name _n _own _times _epoch _text kept digest rep band block key cell start size target taken times shard NAME_".split()
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, base, "a"), (3, base + " x", "b"), (4, "other words " * 9, None), (None, "no id here", "a"), (5, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", *[F.lit(f"v{k}").alias(n) for k, n in enumerate(names)])
    stages = [
        exact_dedup.drop_exact_copies(docs), near_dedup.drop_near_copies(docs, width=5, similarity=0.8), mixing.mixed_documents(docs),
        pieces.encode_documents(docs).drop("pieces"),
    ]
    for out, ids in zip(stages, [{2, 3, 4, None, 5}, {1, 4, None, 5}, {1, 2, 3, 4, None}, {1, 2, 3, 4, None, 5}], strict=True):
        got = out.collect()
        assert out.columns == docs.columns and {r["doc_id"] for r in got} <= ids and len({r["doc_id"] for r in got}) >= len(ids) - 2
        assert all(r[n] == f"v{k}" for r in got for k, n in enumerate(names))


def test_rollup_query_and_sql_agree_on_repeated_ids(spark, tmp_path):
    """Equal rows, rows of one id that differ, rows without id and a deleted document: one rule in the query and in its SQL."""
    rows = [
        (1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, "a b c", "en", "s"), (2, "a b", "de", "t"), (3, "x!!y z", "en", "s"), (3, "q w e r", "en", "t"),
        (4, "a|b", None, "s"), (4, "a|b", "en", None), (None, "n!!o", "en", "s"), (None, "n!!o", "en", "s"), (5, "gone", "en", "s"), (6, None, "en", "s"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, 0), (1, 1)], "doc_id long, quality long").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op4(spark, str(tmp_path)).select("source", "lang", "version", "docs", "tokens").collect()
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    wanted = duck.execute(f"select source, lang, version, docs, tokens from ({token_rollup.SQL})").fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted))


def test_a_commit_reads_the_ledger_by_the_batch_only(spark, odd):
    """Documents that a batch does not name keep their rows; the batch's own part holds nothing of them."""
    store = workspace(spark, "rollup")
    token_rollup.commit(spark, store, 1, token_rollup.upserts(odd, "v1"))
    token_rollup.commit(spark, store, 2, token_rollup.deletes(odd.filter("doc_id = 7")))
    assert {r["doc_id"] for r in spark.read.parquet(f"{store}/ledger/batch=2").collect()} <= {7}

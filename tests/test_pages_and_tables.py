import pytest
from pyspark.sql import functions as F

from pagewright.operators import pagestore as B
from pagewright.session import workspace
from pagewright.sources import tables

HEAD = "---\nsha: s\npage: 1\nsource_key: k\nsubject_key: j\n---\n"


def check(spark, md):
    return B.check_pages(spark.createDataFrame([("s", 1, md)], "sha string, page int, md string")).first().why


@pytest.mark.parametrize("md, want", [
    ("no head", "no front matter"), (HEAD.replace("page: 1\n", "").replace("source_key: k\n", ""), "missing keys: page,source_key"),
    (HEAD.replace("sha: s", "sha: t") + "x", "sha mismatch"), (HEAD.replace("page: 1", "page: 11") + "x" * 50, "page mismatch"),
    (HEAD + "x" * 39, "body 39 chars"), (HEAD + "\n" + "x" * 40 + " \n", "ok"),
    (HEAD + "SORRY, " + "x" * 40, "refusal"), (HEAD.replace("\n", "\r\n") + "x" * 40, "ok"), (HEAD.replace("page: 1", "page:  1 ") + "x" * 40, "ok"),
])
def test_check_pages(spark, md, want):
    assert check(spark, md) == want


@pytest.mark.parametrize("md, want", [
    (HEAD + "\n\nbody", HEAD + "\nbody"), (HEAD + "body", HEAD + "body"), ("\n\nbody", "\n\nbody"),
    (HEAD.replace("\n", "\r\n") + "\r\nbody", HEAD.replace("\n", "\r\n") + "body"),
])
def test_drop_leading_blank(spark, md, want):
    assert B.drop_leading_blank(spark.createDataFrame([(md,)], "md string")).first().md == want


def test_strip_label_and_count_guard(spark):
    df = spark.createDataFrame([(HEAD + "\nC. 표\nbody\n",), (HEAD + "body\nC. 표",), ("C. 표\nx",)], "md string")
    out = B.strip_leaked_label(df)
    assert [r.stripped for r in out.collect()] == [True, False, False] and out.first().md == HEAD + "\nbody\n"
    assert B.assert_count(out, F.col("stripped"), 1).count() == 3
    with pytest.raises(Exception, match="expected 2 rows, found 1"):
        B.assert_count(out, F.col("stripped"), 2).count()


def test_incremental_write_is_idempotent_and_force_rebuilds(spark):
    path = workspace(spark, "t")
    first = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (2, "b", 0)], "k int, v string, part int")
    for _ in range(2):
        store = tables.incremental_write(first, path, ["k"], ["part"])
        assert store.count() == 2
    newer = spark.createDataFrame([(1, "new", 0), (3, "c", 1)], "k int, v string, part int")
    assert {r.k: r.v for r in tables.incremental_write(newer, path, ["k"], ["part"]).collect()} == {1: "a", 2: "b", 3: "c"}
    forced = tables.incremental_write(newer, path, ["k"], ["part"], force=True)
    assert {r.k: r.v for r in forced.collect()} == {1: "new", 2: "b", 3: "c"}
    whole = workspace(spark, "t")
    tables.incremental_write(first.drop("part"), whole, ["k"])
    forced = tables.incremental_write(newer.drop("part"), whole, ["k"], force=True)
    assert {r.k: r.v for r in forced.collect()} == {1: "new", 2: "b", 3: "c"}


def test_survivor_of_a_batch_is_fixed(spark):
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "z", 1)], "k int, v string, t int")
    for parts in (1, 3):
        store = tables.incremental_write(rows.repartition(parts), workspace(spark, "t"), ["k"], order=["t"])
        assert {r.k: r.v for r in store.collect()} == {1: "b", 2: "z"}


def test_named_partitions_are_rewritten(spark):
    path = workspace(spark, "t")
    rows = [(1, "a:b"), (2, "x"), (3, "x"), (4, None), (5, "p/q r"), (6, "y=z%"), (7, None)]
    store = tables.incremental_write(spark.createDataFrame(rows, "k int, part string"), path, ["k"], ["part"])
    gone = spark.createDataFrame([(1,), (2,), (4,), (5,), (6,), (7,)], "k int")
    touched = store.join(gone, "k", "left_semi").select("part")
    tables.rewrite_partitions(spark, path, B.invalidate(store, gone, ("k",)), touched, "part")
    assert [tuple(r) for r in tables.read_store(spark, path, store.schema).collect()] == [(3, "x")]


def test_rewrite_removes_emptied_partitions(spark):
    path = workspace(spark, "t")
    store = tables.incremental_write(spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 2)], "k int, part int"), path, ["k"], ["part"])
    gone = spark.createDataFrame([(1,), (2,)], "k int")
    touched = store.join(gone, "k", "left_semi").select("part")
    tables.rewrite_partitions(spark, path, B.invalidate(store, gone, ("k",)), touched, "part")
    assert sorted(r.k for r in tables.read_store(spark, path, store.schema).collect()) == [3, 4]


def test_map_pages_carries_errors_and_stops_when_told(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0)], "key string, n int")

    def body(row):
        return {"half": 10 // row["n"]}

    good, bad = B.split_errors(B.map_pages(df, body, "key string, half long"), "g", "key")
    assert [tuple(r) for r in good.collect()] == [("a", 10)]
    assert [(r.goal, r.key) for r in bad.collect()] == [("g", "b")] and "zero" in bad.first().error
    pair = B.map_pages(df, lambda row: {"s": {"a": row["n"], "b": 2}}, "key string, s struct<a:int,b:int>").filter("error is null")
    assert sorted((r.key, r.s.a, r.s.b) for r in pair.collect()) == [("a", 1, 2), ("b", 0, 2)]

    def fatal(row):
        problem = RuntimeError("over budget")
        problem.stop_pipeline = True
        raise problem

    with pytest.raises(Exception, match="over budget"):
        B.map_pages(df, fatal, "key string, half long").count()


def test_front_matter_round_trip(spark):
    df = spark.createDataFrame([("s", 3, "text \n\n")], "sha string, page int, body string")
    row = B.parse_front_matter(B.split_front_matter(B.compose_page(df, ("sha", "page")))).first()
    assert row.fields == {"sha": "s", "page": "3"} and row.body == "text\n" and row.head == "---\nsha: s\npage: 3\n---\n"


def test_bucketed_stores_join_without_shuffle(spark):
    left = spark.range(200).selectExpr("cast(id as string) as sha", "cast(id % 7 as int) as page", "id")
    a = tables.write_bucketed(left, "pages_a", workspace(spark, "a"), ["sha", "page"], 4)
    b = tables.write_bucketed(left.filter("id % 2 = 0").drop("id"), "pages_b", workspace(spark, "b"), ["sha", "page"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = a.join(b, ["sha", "page"], "left_anti")
        assert rest.count() == 100
        assert "Exchange hashpartitioning" not in rest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table pages_a")
        spark.sql("drop table pages_b")


def test_only_touched_partitions_are_searched(spark):
    path = workspace(spark, "t")
    rows = spark.range(40).selectExpr("id as k", "cast(id % 8 as int) as part")
    tables.incremental_write(rows, path, ["k"], ["part"])
    batch = spark.createDataFrame([(3, 3), (43, 3), (51, 3)], rows.schema)
    fresh = tables.unstored(batch, path, ["k"], ["part"])
    assert sorted(r.k for r in fresh.collect()) == [43, 51]
    scan = [line for line in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert scan and all("part#" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scan)
    assert tables.incremental_write(batch, path, ["k"], ["part"]).count() == 42

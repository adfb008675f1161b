"""Versions of a store, its key index, and writers that stop half-way."""

import pytest
from pyspark.sql import functions as F

from pagewright.session import workspace
from pagewright.sources import tables, versions


def rows(store):
    return sorted(tuple(r) for r in store.collect())


def opened(frame):
    """Parquet scans of commits in the plan of a frame."""
    return sum("commit=" in line for line in frame.inputFiles())


def test_a_writer_that_stops_leaves_the_old_version(spark, monkeypatch):
    path = workspace(spark, "t")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)], "k int, v string, part string")
    store = tables.incremental_write(first, path, ["k"], ["part"])
    before = rows(store)
    more = spark.createDataFrame([(2, "new", "y"), (4, "d", "x")], first.schema)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", stop)
        for attempt in (
            lambda: tables.incremental_write(more, path, ["k"], ["part"]),
            lambda: tables.incremental_write(more, path, ["k"], ["part"], force=True),
            lambda: tables.rewrite_partitions(spark, path, store.filter("k = 99"), store.select("part"), "part"),
        ):
            with pytest.raises(RuntimeError, match="stopped"):
                attempt()
            assert rows(tables.read_store(spark, path, first.schema)) == before and versions.latest(spark, path) == 0
    forced = tables.incremental_write(more, path, ["k"], ["part"], force=True)
    assert {r.k: r.v for r in forced.collect()} == {1: "a", 2: "new", 3: "c", 4: "d"}
    assert {r.k: r.v for r in versions.read_version(spark, path, first.schema, 0).collect()} == {1: "a", 2: "b", 3: "c"}
    removed = versions.vacuum(spark, path, keep=1)
    assert sum(name.startswith("commit=") for name in removed) >= 3 and any("_staged" in name for name in removed)
    assert {r.k: r.v for r in tables.read_store(spark, path, first.schema).collect()} == {1: "a", 2: "new", 3: "c", 4: "d"}


def test_two_writers_cannot_publish_one_version(spark):
    path = workspace(spark, "t")
    frame = spark.createDataFrame([(1,)], "k int")
    tables.incremental_write(frame, path, ["k"])
    staged = f"{path}/_versions/_staged-other"
    versions.version_table(spark, path, 0).write.parquet(staged)
    with pytest.raises(Exception, match="exist"):
        versions._publish(spark, path, staged, 0)
    assert tables.read_store(spark, path, frame.schema).count() == 1


def test_new_keys_open_no_old_file(spark):
    path = workspace(spark, "t")
    old = spark.range(5000).select((F.col("id") * 2).alias("k"), F.lit(None).cast("string").alias("s"), F.repeat(F.lit("v"), 50).alias("v"))
    tables.incremental_write(old.withColumn("k", F.col("k") + 10_001), path, ["k", "s"])
    tables.incremental_write(old.withColumn("k", F.col("k") + 10_000), path, ["k", "s"])
    store = tables.incremental_write(old, path, ["k", "s"])
    later = old.withColumn("k", F.col("k") + 100_000)
    assert opened(tables.unstored(later, path, ["k", "s"])) == 0
    between = old.withColumn("k", F.col("k") + 1).limit(20)
    fresh = tables.unstored(between, path, ["k", "s"])
    assert opened(fresh) <= 1 and fresh.count() == 20
    mixed = tables.unstored(old.withColumn("k", F.when(F.col("k") < 9000, F.col("k") + 50_001).otherwise(F.col("k") + 10_000)), path, ["k", "s"])
    assert mixed.count() == 4500 and opened(mixed) < opened(store)
    again = tables.unstored(old.filter("k = 4000"), path, ["k", "s"])
    assert again.count() == 0 and 1 <= opened(again) < opened(store)
    assert tables.incremental_write(later.unionByName(old), path, ["k", "s"]).count() == 20_000


def test_every_stored_key_is_suspected(spark):
    path = workspace(spark, "t")
    parts = [spark.range(a, a + 3000).selectExpr("cast(id as string) as k", "id % 3 as part") for a in (0, 3000, 6000)]
    for part in parts:
        tables.incremental_write(part, path, ["k"], ["part"])
    table = versions.version_table(spark, path, versions.latest(spark, path))
    asked = spark.range(20_000).selectExpr("cast(id as string) as k", "id % 3 as part")
    hits = versions.suspects(spark, path, table, asked, ["k", "part"]).select("k").distinct()
    known = hits.filter("cast(k as int) < 9000").count()
    assert known == 9000 and hits.count() - known < 0.02 * 11_000


def test_a_plain_folder_becomes_a_store(spark):
    path = workspace(spark, "t")
    spark.createDataFrame([(1, 0), (2, 1)], "k int, part int").write.partitionBy("part").parquet(path)
    more = spark.createDataFrame([(2, 1), (3, 1)], "k int, part int")
    assert rows(tables.incremental_write(more, path, ["k"], ["part"])) == [(1, 0), (2, 1), (3, 1)]
    assert rows(tables.incremental_write(more, path, ["k"], ["part"], force=True)) == [(1, 0), (2, 1), (3, 1)]
    tables.rewrite_partitions(spark, path, tables.read_store(spark, path, more.schema).filter("k > 2"), spark.createDataFrame([(1,)], "part int"), "part")
    assert rows(tables.read_store(spark, path, more.schema)) == [(1, 0), (3, 1)]


def test_empty_batches(spark):
    path = workspace(spark, "t")
    none = spark.createDataFrame([], "k int, v string")
    assert tables.incremental_write(none, path, ["k"]).count() == 0
    some = spark.createDataFrame([(1, "a")], none.schema)
    assert tables.incremental_write(some, path, ["k"]).count() == 1
    assert tables.incremental_write(none, path, ["k"]).count() == 1
    assert tables.incremental_write(none, path, ["k"], force=True).count() == 1

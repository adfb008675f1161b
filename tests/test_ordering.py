import random

from pyspark.sql import functions as F

from pagewright.operators import ordering as O


def test_global_index_follows_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    rows = O.with_global_index(df, ["k"]).collect()
    assert all(r.idx == r.k for r in rows) and len(rows) == 1000


def test_running_sum_is_exact_over_partitions(spark):
    rows = [(i, random.Random(i).randrange(100)) for i in range(500)]
    out = {r.k: r.upto for r in O.with_running_sum(spark.createDataFrame(rows, "k int, v long").repartition(7), ["k"], "v", "upto").collect()}
    total = 0
    for k, v in rows:
        total += v
        assert out[k] == total


def test_group_index_of_a_large_group(spark):
    rows = [("hot" if i % 3 else f"g{i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(5)
    places = {(r.g, r.i): r.idx for r in O.with_group_index(df, ["g"], ["i"]).collect()}
    hot = sorted(i for g, i in rows if g == "hot")
    assert all(places["hot", i] == k for k, i in enumerate(hot)) and all(v == 0 for (g, _), v in places.items() if g != "hot")


def test_group_facts_reach_every_row(spark):
    rows = [("hot" if i % 3 else f"g{i}", i) for i in range(300)] + [("none", -1), (None, -2)]
    df = spark.createDataFrame(rows, "g string, i int")
    facts = df.filter("g <> 'none'").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"))
    out = O.attach_group_facts(df, facts, ["g"], ["i"]).collect()
    assert len(out) == 302
    assert all(
        (r.n, r.first) == ((200, 1) if r.g == "hot" else (None, None) if r.g in ("none", None) else (1, r.i)) for r in out
    )


def test_positions_by_stretches(spark):
    rows = [("a", i * 3) for i in range(100)] + [("b", 5), ("c", 1), ("c", 900)]
    df = spark.createDataFrame(rows, "g string, page int").repartition(6)
    wanted = F.array(F.lit(0).cast("long"), F.floor(F.col("n") / 2), F.col("n") - 1)
    got = sorted(O.at_positions(df, ["g"], "page", wanted, width=7).collect())
    assert [tuple(r) for r in got] == [("a", 0), ("a", 150), ("a", 297), ("b", 5), ("c", 1), ("c", 900)]


def test_hot_rows_are_spread_by_the_join(spark):
    rows = [("hot", i) for i in range(900)] + [(None, i) for i in range(100)] + [(f"g{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, i int")
    facts = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = O.attach_group_facts(df, facts, ["g"], ["i"])
        sizes = [len(p) for p in joined.rdd.glom().collect()]
        assert sum(sizes) == 1050 and max(sizes) < 450
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prefix_sums_without_stored_rows(spark):
    """Composite keys with nulls, unsorted input and any number of ranges against a plain loop."""
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "a", "b", "é", ""]), i if i % 9 else None, rnd.randrange(50)) for i in range(700)]
    rows = list({(a, b): (a, b, n) for a, b, n in rows}.values())
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "a string, b int, n long")
    key = lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0)
    expected, total = {}, 0
    for place, (a, b, n) in enumerate(sorted(rows, key=key)):
        total += n
        expected[a, b] = (place, total)
    for ranges in (None, 1, 2, 7, 64):
        out = O.with_prefix_index(O.with_prefix_sum(df.repartition(6), ["a", "b"], F.col("n"), "upto", ranges), ["a", "b"], "idx", ranges)
        assert {(r.a, r.b): (r.idx, r.upto) for r in out.collect()} == expected
    assert O.with_prefix_index(df.limit(0), ["a", "b"]).count() == 0


def test_range_bounds_are_even_and_store_nothing(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20000).alias("k"))
    bounds = O.key_bounds(df, ["k"], 8)
    sizes = [r["count"] for r in df.groupBy(O.range_number(df, ["k"], bounds).alias("r")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8
    plan = O.with_prefix_sum(df, ["k"], F.lit(1), "upto")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan

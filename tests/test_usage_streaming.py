import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.operators import audit as G
from pagewright.operators import usage as U
from pagewright.session import workspace
from pagewright.sources import versions
from pagewright.streaming import flows

LOG = "event_id long, t timestamp, tag string, tok_in long, tok_out long, cached long"


def log(spark, rows):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, start + dt.timedelta(hours=h), tag, a, b, c) for i, (h, tag, a, b, c) in enumerate(rows)], LOG)


def test_costs(spark):
    rows = log(spark, [(0, "x", 1_000_000, 0, 500_000), (1, None, 0, 1_000_000, None)])
    assert tuple(U.usage_cost(rows).first()) == (2, 500_000, 1_000_000, 500_000, 1.31)
    assert [(r.tag, r.usd) for r in U.cost_by_tag(rows).collect()] == [("text", 1.2), ("x", 0.11)]


@pytest.mark.parametrize("limit, allowed", [("0.2", 1), ("0.200001", 2), ("0", 3)])
def test_budget_stops_at_the_limit(spark, limit, allowed):
    rows = log(spark, [(h, "x", 1_000_000, 0, 0) for h in range(3)])
    row = U.first_blocked(U.budget_cutoff(rows, limit)).first()
    assert (row.allowed, row.first_blocked) == (allowed, None if allowed == 3 else allowed)


def test_remaining_is_never_negative(spark):
    assert tuple(U.project_remaining(spark.range(2), spark.range(5)).first()) == (2, 5, 0, 0.0)


def test_gates_and_log(spark):
    one = lambda ok: spark.createDataFrame([(ok, "d")], "ok boolean, detail string")
    report = G.gate_report([G.check("a", one(True)), G.check("b", one(None)), G.check("c", one(False), "why")])
    assert [tuple(r) for r in report.collect()] == [("a", "pass", "d"), ("b", "skip", "d"), ("c", "fail", "why")]
    assert tuple(G.gate_totals(report).first()) == (3, 1, 1, 1, True)
    bad = spark.createDataFrame([("g", "1"), ("g", "1"), ("g", "2")], "goal string, key string")
    done = spark.createDataFrame([("1",)], "key string")
    assert sorted((r.key, r.state) for r in G.log_reconcile(bad, done).collect()) == [("1", "solved"), ("2", "open")]


def test_leak_rules(spark):
    docs = spark.createDataFrame([
        ("l1/a.pdf", "fine"), ("b.md", "---\nsource: q\nsha: 0123456789abcdef\n---\n"), ("c", "x" * 30 + " fileId"), ("d", "C:\\Users\\me"),
        ("e", "sk-" + "a" * 20), ("f", "y" * 30), ("g", "uses fileId here\n" + "z" * 30), ("h", "fileId " + "z" * 30),
    ], "path string, content string")
    hits = G.leak_scan(docs)
    assert sorted((r.path, r.rule) for r in hits.collect()) == [
        ("b.md", "l1-content"), ("c", "drive-id"), ("d", "local-path"), ("e", "api-key"), ("l1/a.pdf", "output-dir"), ("l1/a.pdf", "study-ext")]
    allowed = G.leak_scan(docs, allow=docs.filter("path = 'e'"), allow_by_rule=spark.createDataFrame([("study-ext", "l1/a.pdf")], "rule string, path string"))
    assert allowed.count() == 4
    extra = G.leak_scan(spark.createDataFrame([("p", "see D:\\Courses and /Courses/x")], "path string, content string"), rules=[G.source_folder_rule("Courses")])
    assert [r.rule for r in extra.collect()] == ["drive-path"]


def batches(spark, folder, parts):
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(folder) if i else part.coalesce(1).write.parquet(folder)


def test_budget_ledger_over_batches_and_restart(spark):
    folder, out, ledger, marks = (workspace(spark, n) for n in ("in", "out", "ledger", "offsets"))
    rows = [(h, "xyx"[h % 3], 1_000_000, 0, 0) for h in range(12)]
    frame = log(spark, rows).withColumnRenamed("tag", "budget")
    batches(spark, folder, [frame.filter("event_id < 4"), frame.filter("event_id between 4 and 7")])

    def run():
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)
        flows.stream_budget(stream, out, ledger, marks, "0.5", ["t", "event_id"]).awaitTermination()

    run()
    frame.filter("event_id > 7").coalesce(1).write.mode("append").parquet(folder)
    run()
    got = {r.event_id: (r.spent_before, r.blocked) for r in spark.read.parquet(out).collect()}
    spent = {}
    assert len(got) == 12
    for i, (_, budget, *_rest) in enumerate(rows):
        before = spent.get(budget, Decimal(0))
        assert got[i] == (before, before >= 500_000)
        spent[budget] = before + 200_000


def test_daily_usage_over_folded_batches(spark):
    """Seven batches with late rows and a restart, folded every two: the same table as one aggregation, read from one snapshot and the tail."""
    folder, out, marks = (workspace(spark, n) for n in ("in", "out", "offsets"))
    rows = [(h % 30, "xy"[h % 2], h, 1, 0) for h in range(70)]
    frame = log(spark, rows)
    numbered = frame.withColumn("n", F.row_number().over(Window.orderBy("tok_in")))
    files = [numbered.filter(F.col("n") % 7 == k).drop("n") for k in range(7)]
    keys = ["day", "tag"]

    def run():
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)
        flows.stream_usage_daily(stream, out, marks, "40 days", fold_every=2).awaitTermination()

    batches(spark, folder, files[:4])
    run()
    for part in files[4:]:
        part.coalesce(1).write.mode("append").parquet(folder)
    run()
    kept = versions.folder_names(spark, out)
    assert sum(n.startswith("batch_id=") for n in kept) <= 3 and len(flows._snapshots(spark, out)) == 1
    schema = flows.daily_usage(frame).schema
    got = {(r.day, r.tag): (r.calls, r.tok_in, r.tok_out) for r in flows.read_latest(spark, out, schema, keys).collect()}
    want = frame.groupBy(F.to_date("t").alias("day"), "tag").agg(F.count("*").alias("c"), F.sum("tok_in").alias("i"), F.sum("tok_out").alias("o"))
    assert got == {(r.day, r.tag): (r.c, r.i, r.o) for r in want.collect()}


def test_a_fold_that_stops_changes_nothing(spark, monkeypatch):
    path = workspace(spark, "daily")
    shape = spark.createDataFrame([], "k int, v string")
    for number, rows in enumerate([[(1, "a"), (2, "b")], [(2, "c")], [(3, "d")]]):
        spark.createDataFrame(rows, shape.schema).write.parquet(f"{path}/batch_id={number}")

    def stop(*_):
        raise RuntimeError("stopped")

    def latest():
        return {r.k: r.v for r in flows.read_latest(spark, path, shape.schema, ["k"]).collect()}

    want = {1: "a", 2: "c", 3: "d"}
    for name in ("publish_folder", "folder_names"):
        with monkeypatch.context() as patch:
            whole = getattr(versions, name)
            patch.setattr(versions, name, stop if name == "publish_folder" else lambda s, p: whole(s, p) if "_snapshots" in p else stop())
            with pytest.raises(RuntimeError, match="stopped"):
                flows.fold_batches(spark, path, shape.schema, ["k"], 1)
        assert latest() == want
    flows.fold_batches(spark, path, shape.schema, ["k"], 2)
    assert latest() == want and not [n for n in versions.folder_names(spark, path) if n.startswith("batch_id=2")]


def test_pages_streamed_once_over_restarts(spark):
    folder, store, marks = (workspace(spark, n) for n in ("in", "store", "offsets"))
    first = spark.createDataFrame([("a", 1, "old"), ("a", 1, "old"), ("a", 2, "old")], "sha string, page int, body string")
    first.coalesce(1).write.parquet(folder)

    def run():
        stream = spark.readStream.schema(first.schema).parquet(folder)
        flows.stream_pages(stream, store, ["sha", "page"], marks).awaitTermination()

    run()
    spark.createDataFrame([("a", 2, "new"), ("a", 3, "new")], first.schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    run()
    assert sorted((r.page, r.body) for r in spark.read.parquet(store).collect()) == [(1, "old"), (2, "old"), (3, "new")]


def test_repeats_within_the_horizon(spark):
    folder, store, marks = (workspace(spark, n) for n in ("in", "store", "offsets"))
    rows = log(spark, [(0, "a", 1, 1, 0), (0, "a", 2, 2, 0), (1, "b", 1, 1, 0)])
    rows.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(rows.schema).parquet(folder)
    flows.stream_pages(stream, store, ["tag"], marks, horizon=("t", "1 hour")).awaitTermination()
    assert sorted(r.tag for r in spark.read.parquet(store).collect()) == ["a", "b"]


def test_samples(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("s"), F.col("id").alias("k"))
    first = sorted(map(tuple, G.stratified_sample(df, "s", "k", 5, 1).collect()))
    again = sorted(map(tuple, G.stratified_sample(df.repartition(7), "s", "k", 5, 1).collect()))
    other = sorted(map(tuple, G.stratified_sample(df, "s", "k", 5, 2).collect()))
    assert first == again != other and len(first) == 15

"""Queries that run a stream to its end and read its sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.plans.registry import query
from pagewright.plans.sql_views import squeeze
from pagewright.plans.views import Views
from pagewright.functions import text
from pagewright.session import workspace
from pagewright.sources import tables, versions
from pagewright.streaming import flows

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


BATCHES = 5
#: Rows of an arriving file at most on average.
ROWS_PER_FILE = 32768


def _arrivals(v: Views, table: str, schema: T.StructType, order: str, key: str):
    """A stream over the table in ``BATCHES`` batches of files that arrive one after the other, in the order of a column.

    Rows of a batch are dealt over its files by ``key``, so no task reads or writes more than a file. A batch takes as many
    files as each part has.
    """
    path = workspace(v.spark, f"arriving-{table}")
    rows = v.table(table).select(*schema.fieldNames())
    files = -(-rows.count() // (BATCHES * ROWS_PER_FILE)) or 1
    place = F.ntile(BATCHES).over(Window.orderBy("day"))
    # Whole stretches of the order per file: counts per stretch are few, the rows themselves are only filtered.
    stretch = F.date_trunc("hour", order) if schema[order].dataType.typeName().startswith("timestamp") else F.floor(F.col(order) / 64)
    stretches = rows.select(stretch.alias("day")).distinct().withColumn("part", place)
    dealt = rows.withColumn("day", stretch).join(stretches, "day")
    for part in range(1, BATCHES + 1):
        chosen = dealt.filter(F.col("part") == part).select(*schema.fieldNames())
        chosen.repartition(files, key).write.mode("append").parquet(path)
        # A file that got no row is not written; empty ones in its stead keep the batches apart.
        written = sum(name.endswith(".parquet") for name in versions.folder_names(v.spark, path))
        for _ in range(part * files - written):
            v.spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return flows.read_table_stream(v.spark, path, table, schema, files_per_trigger=files, pattern="*.parquet")


def _usage(v: Views):
    events = _arrivals(v, "events", EVENTS, "ts", "event_id")
    tok_in = F.floor(F.col("value") * 10).cast("long")
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("t"), F.col("event_type").alias("tag"), tok_in.alias("tok_in"),
        F.floor("value").cast("long").alias("tok_out"),
        F.least(F.get_json_object("props", "$.k").cast("long"), tok_in).alias("cached"),
    )


@query("stream_pages", "select doc_id, sha256(case when doc_id % 4 = 1 then 'stored before' else text end) as text_sha from documents")
def stream_pages(v: Views):
    """A store that holds some keys already, then a stream of every document, run twice."""
    path, checkpoint = workspace(v.spark, "store"), workspace(v.spark, "offsets")
    before = v.table("documents").filter("doc_id % 4 = 1").select("doc_id", F.lit("stored before").alias("text"))
    tables.incremental_write(before, path, ["doc_id"])
    for run in ("first", "second"):
        stream = _arrivals(v, "documents", DOCUMENTS, "doc_id", "doc_id").select("doc_id", "text")
        flows.stream_pages(stream, path, ["doc_id"], f"{checkpoint}/{run}").awaitTermination()
    stored = tables.read_store(v.spark, path, before.schema)
    return stored.select("doc_id", F.sha2("text", 256).alias("text_sha"))


def _quarantine(v: Views):
    good, bad, checkpoint = (workspace(v.spark, name) for name in ("good", "bad", "offsets"))
    docs = _arrivals(v, "documents", DOCUMENTS, "doc_id", "doc_id")
    dense = F.length(text.squeeze_out(F.col("text")))
    failed = docs.select("doc_id", F.when(dense < 200, F.concat(F.lit("short: "), "text")).alias("error"))
    flows.stream_quarantine(failed, "documents", "doc_id", good, bad, checkpoint).awaitTermination()
    return v.spark.read.parquet(good), v.spark.read.parquet(bad)


@query("stream_quarantine", f"""
    select 'documents' as goal, cast(doc_id as varchar) as key, substr(concat('short: ', text), 1, 300) as error from documents where length({squeeze("text")}) < 200""")
def stream_quarantine(v: Views):
    return _quarantine(v)[1].select("goal", "key", "error")


@query("stream_quarantine_rest", f"select doc_id from documents where length({squeeze('text')}) >= 200")
def stream_quarantine_rest(v: Views):
    return _quarantine(v)[0].select("doc_id")


@query("stream_usage_daily", """
    select cast(t as date) as day, tag, count(*) as calls, cast(sum(tok_in) as bigint) as tok_in, cast(sum(tok_out) as bigint) as tok_out,
      cast(sum(cast(tok_in - cached as decimal(18,0)) * 0.2000 + cast(tok_out as decimal(18,0)) * 1.2000 + cast(cached as decimal(18,0)) * 0.0200) as double) as micro
    from fx_usage group by 1, 2""")
def stream_usage_daily(v: Views):
    path, checkpoint = workspace(v.spark, "daily"), workspace(v.spark, "offsets")
    flows.stream_usage_daily(_usage(v), path, checkpoint).awaitTermination()
    schema = T.StructType([
        T.StructField("day", T.DateType()), T.StructField("tag", T.StringType()), T.StructField("calls", T.LongType()),
        T.StructField("tok_in", T.LongType()), T.StructField("tok_out", T.LongType()), T.StructField("micro", T.DecimalType(38, 4)),
    ])
    latest = flows.read_latest(v.spark, path, schema, ["day", "tag"])
    return latest.withColumn("micro", F.col("micro").cast("double"))


@query("stream_budget", """
    select event_id, budget, cast(before as double) as spent_before, before >= 80000 as blocked from (
      select event_id, tag as budget, coalesce(sum(cast(tok_in - cached as decimal(18,0)) * 0.2000 + cast(tok_out as decimal(18,0)) * 1.2000)
        over (partition by tag order by t, event_id rows between unbounded preceding and 1 preceding), 0) as before from fx_usage)""")
def stream_budget(v: Views):
    path, ledger, checkpoint = (workspace(v.spark, name) for name in ("calls", "ledger", "offsets"))
    calls = _usage(v).withColumnRenamed("tag", "budget")
    flows.stream_budget(calls, path, ledger, checkpoint, "0.08", ["t", "event_id"]).awaitTermination()
    flagged = v.spark.read.parquet(path)
    return flagged.select("event_id", "budget", F.col("spent_before").cast("double").alias("spent_before"), "blocked")

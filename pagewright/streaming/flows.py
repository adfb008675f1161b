"""Streaming forms of the append-only flows: pages, quarantine, usage, budget."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators.ordering import attach_group_facts, with_running_sum
from pagewright.operators.pagestore import split_errors
from pagewright.operators.usage import Prices, micro_usd
from pagewright.sources import versions
from pagewright.sources.tables import incremental_write, read_store, remove_folder


def read_table_stream(
    spark: SparkSession, folder: str, table: str, schema: T.StructType, files_per_trigger: int = 100, pattern: str | None = None
) -> DataFrame:
    """File-source stream over one Parquet table of a folder, or over the files that match ``pattern``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern or f"{table}.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def _start(stream: DataFrame, sink, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_pages(
    stream: DataFrame, path: str, keys, checkpoint: str, horizon: tuple[str, str] | None = None, partition_by=()
) -> StreamingQuery:
    """Append each page key once, ever: a key already in the store is skipped.

    With ``partition_by``, columns that follow from the key, a batch searches its own partitions only.
    ``horizon`` (time column, watermark) also drops repeats that arrive close together before
    they reach the store.
    """
    if horizon:
        stream = stream.withWatermark(*horizon).dropDuplicatesWithinWatermark(list(keys))

    def sink(batch: DataFrame, _: int) -> None:
        incremental_write(batch, path, keys, partition_by)

    return _start(stream, sink, checkpoint)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch: a repeated batch replaces its own rows only."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_quarantine(stream: DataFrame, goal: str, key: str, good_path: str, bad_path: str, checkpoint: str) -> StreamingQuery:
    """Rows without error to one sink, dead letters to the other."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()   # read by both sinks
        good, bad = split_errors(rows, goal, key)
        _write_batch(good, good_path, batch_id)
        _write_batch(bad, bad_path, batch_id)
        rows.unpersist()

    return _start(stream, sink, checkpoint)


def daily_usage(stream: DataFrame, watermark: str = "1 day", prices: Prices = Prices()) -> DataFrame:
    """Calls, tokens and cost per tag and day; rows later than the watermark are dropped."""
    timed = stream.withColumn("t", F.col("t").cast("timestamp")).withWatermark("t", watermark)
    cost = F.sum(micro_usd(prices)).alias("micro")
    out = timed.groupBy(F.window("t", "1 day").alias("_w"), "tag").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("tok_in").alias("tok_in"), F.sum("tok_out").alias("tok_out"), cost
    )
    return out.select(F.col("_w.start").cast("date").alias("day"), "tag", "calls", "tok_in", "tok_out", "micro")


def stream_usage_daily(stream: DataFrame, path: str, checkpoint: str, watermark: str = "1 day", fold_every: int = 16) -> StreamingQuery:
    """Changed (day, tag) rows per batch; :func:`read_latest` gives the current table. Every ``fold_every`` batches the
    finished ones are folded into a snapshot."""
    counts = daily_usage(stream, watermark)

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)
        if batch_id and batch_id % fold_every == 0:
            # This batch may be repeated after a crash, so it stays out of the snapshot.
            fold_batches(batch.sparkSession, path, counts.schema, ["day", "tag"], batch_id - 1)

    return _start(counts, sink, checkpoint, "update")


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in versions.folder_names(spark, f"{path}/_snapshots") if n.isdigit())


def _latest_rows(spark: SparkSession, path: str, schema: T.StructType, keys, upto: int | None = None) -> DataFrame:
    """The row of the last batch for each key, with its batch: the newest snapshot and the batches after it."""
    numbered = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField("batch_id", T.LongType())])
    rows, done = read_store(spark, path, numbered), _snapshots(spark, path)
    if upto is not None:
        rows = rows.filter(F.col("batch_id") <= upto)
    if done:
        rows = rows.filter(F.col("batch_id") > done[-1]).unionByName(read_store(spark, f"{path}/_snapshots/{done[-1]:010d}", numbered))
    rest = [f.name for f in numbered.fields if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row")).select(*keys, "_row.*")


def fold_batches(spark: SparkSession, path: str, schema: T.StructType, keys, upto: int) -> None:
    """Put the rows that count after batch ``upto`` into one snapshot and remove what it replaces.

    The snapshot is published by one rename; batches that it holds are left out of reading, whether they are removed yet or not.
    """
    done = _snapshots(spark, path)
    if done and done[-1] >= upto:
        return
    staged = f"{path}/_snapshots/_staged-{uuid.uuid4().hex[:12]}"
    _latest_rows(spark, path, schema, keys, upto).write.parquet(staged)
    versions.publish_folder(spark, staged, f"{path}/_snapshots/{upto:010d}")
    for name in versions.folder_names(spark, path):
        number = name.removeprefix("batch_id=")
        if number != name and int(number) <= upto:
            remove_folder(spark, f"{path}/{name}")
    for number in done:
        remove_folder(spark, f"{path}/_snapshots/{number:010d}")


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys) -> DataFrame:
    """The row of the last batch for each key, from the newest snapshot and the batches after it."""
    return _latest_rows(spark, path, schema, keys).select(*[f.name for f in schema.fields])


LEDGER = T.StructType([
    T.StructField("budget", T.StringType()),
    T.StructField("spent", T.DecimalType(28, 4)),
    T.StructField("batch_id", T.LongType()),
])


def spend_flags(batch: DataFrame, prior: DataFrame, limit_usd: str, order, prices: Prices) -> DataFrame:
    """Spend of each call's budget before the call, earlier batches included, and the blocked flag.

    The running total follows (budget, order) over ranges of rows, so one busy budget is summed by
    many tasks; what each budget spent before comes back as one fact row per budget.
    """
    priced = batch.withColumn("_cost", micro_usd(prices))
    summed = with_running_sum(priced, ["budget", *order], "_cost", "_upto")
    facts = summed.groupBy("budget").agg(F.min(F.col("_upto") - F.col("_cost")).alias("_base")).join(prior.select("budget", "spent"), "budget", "left")
    placed = attach_group_facts(summed, facts, ["budget"], order)
    before = F.col("_upto") - F.col("_cost") - F.col("_base") + F.coalesce("spent", F.lit(0).cast("decimal(28,4)"))
    limit = F.lit(limit_usd).cast("decimal(18,6)") * 1000000
    return (
        placed.withColumn("spent_before", before.cast("decimal(28,4)"))
        .withColumn("blocked", (limit > 0) & (F.col("spent_before") >= limit))
        .drop("_upto", "_base", "spent")
        .withColumnRenamed("_cost", "cost")
    )


def stream_budget(stream: DataFrame, path: str, ledger_path: str, checkpoint: str, limit_usd: str, order, prices: Prices = Prices(cached="0")) -> StreamingQuery:
    """Flag calls once a budget's spend has reached the limit; totals carry over in a ledger table.

    Each batch writes the totals of all budgets, reads the snapshot before its own only, and removes what lies before that
    one: a batch that is repeated still finds its predecessor.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = LEDGER.fieldNames()[:-1]
        prior = read_store(spark, f"{ledger_path}/batch_id={batch_id - 1}", T.StructType(LEDGER.fields[:-1])).select(*before)
        flagged = spend_flags(batch, prior, limit_usd, order, prices)
        _write_batch(flagged, path, batch_id)
        written = spark.read.parquet(f"{path}/batch_id={batch_id}")
        totals = written.groupBy("budget").agg(F.sum("cost").alias("_new")).join(prior, "budget", "full")
        zero = F.lit(0).cast("decimal(28,4)")
        spent = (F.coalesce("_new", zero) + F.coalesce("spent", zero)).cast("decimal(28,4)")
        _write_batch(totals.select("budget", spent.alias("spent")), ledger_path, batch_id)
        remove_folder(spark, f"{ledger_path}/batch_id={batch_id - 2}")

    return _start(stream, sink, checkpoint)

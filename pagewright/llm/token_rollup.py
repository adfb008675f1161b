"""Delta-maintained token counts.

A batch of changes (inserts, revised counts, deletes) becomes signed contributions: what a document counted
for so far is taken back, what it counts for now is added. Contributions are kept in a ledger, their sums by
source, language and tokenizer version in a table of deltas. Totals are the sum of the deltas. Every batch
owns one folder in either table and looks only at earlier batches, so a batch that is committed again replaces
itself and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm.common import space_words, whole_text
from pagewright.sources.tables import read_store

GROUP = ["source", "lang", "version"]
LEDGER = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("sign", T.LongType()),
    T.StructField("batch", T.LongType()),
])
DELTAS = T.StructType([
    *[T.StructField(c, T.StringType()) for c in GROUP],
    *[T.StructField(c, T.LongType()) for c in ("docs", "tokens", "batch")],
])


def space_count(text: Column) -> Column:
    return F.size(space_words(text)).cast("long")


def upserts(docs: DataFrame, version: str, count=space_count, text_column: str = "text") -> DataFrame:
    """Changes that set each document's count under a tokenizer version; a null text counts 0 tokens."""
    return docs.select(
        "doc_id", "source", "lang", F.lit(version).alias("version"),
        count(whole_text(text_column)).alias("tokens"), F.lit(False).alias("deleted"),
    )


def deletes(docs: DataFrame) -> DataFrame:
    """Changes that take documents out under every version."""
    empty = F.lit(None).cast("string")
    return docs.select(
        "doc_id", empty.alias("source"), empty.alias("lang"), empty.alias("version"),
        F.lit(0).cast("long").alias("tokens"), F.lit(True).alias("deleted"),
    )


def commit(spark: SparkSession, store: str, batch: int, changes: DataFrame) -> None:
    """Commit one batch of changes; the same batch committed again leaves the totals as they are.

    Only ledger rows of documents that the batch names are shuffled and summed. Batches count upwards. Within a batch an upsert of a document and version that occurs more than once
    takes the largest (tokens, source, lang), and a delete applies before the upserts. Rows without
    doc_id are plain insertions of their batch: each counts, and later batches never revise it.
    """
    known = changes.filter(F.col("doc_id").isNotNull())
    fresh = (
        known.filter(~F.col("deleted"))
        .groupBy("doc_id", "version")
        .agg(F.max(F.struct("tokens", "source", "lang")).alias("m"))
        .select("doc_id", "m.source", "m.lang", "version", "m.tokens", F.lit(1).cast("long").alias("sign"))
    )
    gone = known.filter("deleted").select(F.col("doc_id").alias("gone_id")).distinct()
    renewed = fresh.select(F.col("doc_id").alias("new_id"), F.col("version").alias("new_version"))
    changed = gone.select(F.col("gone_id").alias("doc_id")).unionByName(fresh.select("doc_id")).distinct()
    held = (
        read_store(spark, f"{store}/ledger", LEDGER).filter(F.col("batch") < batch).join(changed, "doc_id", "left_semi")
        .groupBy("doc_id", *GROUP, "tokens").agg(F.sum("sign").alias("sign")).filter("sign > 0")
    )
    touched = (
        held.join(gone, held["doc_id"] == gone["gone_id"], "left")
        .join(renewed, (held["doc_id"] == renewed["new_id"]) & (held["version"] == renewed["new_version"]), "left")
        .filter(F.col("gone_id").isNotNull() | F.col("new_id").isNotNull())
        .select("doc_id", *GROUP, "tokens", (-F.col("sign")).alias("sign"))
    )
    order = [f.name for f in LEDGER.fields if f.name != "batch"]
    nameless = changes.filter(F.col("doc_id").isNull() & ~F.col("deleted")).withColumn("sign", F.lit(1).cast("long"))
    signed = fresh.select(*order).unionByName(touched.select(*order)).unionByName(nameless.select(*order))
    signed.write.mode("overwrite").parquet(f"{store}/ledger/batch={batch}")
    written = spark.read.parquet(f"{store}/ledger/batch={batch}")
    written.groupBy(*GROUP).agg(
        F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens")
    ).write.mode("overwrite").parquet(f"{store}/deltas/batch={batch}")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """source, lang, version, docs, tokens; groups whose documents are all gone have no row."""
    deltas = read_store(spark, f"{store}/deltas", DELTAS)
    return (
        deltas.groupBy(*GROUP)
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .filter("docs > 0")
    )


SQL = """
WITH counted AS (
  SELECT d.doc_id, d.source, d.lang, t.version,
         len(list_filter(string_split_regex(
           CASE WHEN t.version = 'space-2' THEN replace(coalesce(d.text, ''), '|', ' ') ELSE coalesce(d.text, '') END,
           '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS tokens,
         t.version = 'space-1' AND contains(coalesce(d.text, ''), '!!') AS revised,
         len(list_filter(string_split_regex(replace(coalesce(d.text, ''), '!!', ' '), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS quiet
  FROM documents d CROSS JOIN (VALUES ('space-1'), ('space-2')) t(version)
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0)),
valued AS (SELECT doc_id, source, lang, version, revised, CASE WHEN revised THEN quiet ELSE tokens END AS tokens FROM counted),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY doc_id, version ORDER BY revised DESC, tokens DESC, source DESC NULLS LAST, lang DESC NULLS LAST) AS place FROM valued)
SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM ranked WHERE doc_id IS NULL OR place = 1 GROUP BY source, lang, version
"""

"""Exact duplicates by a tree-merge of sorted digest runs.

Rows are dealt into runs by a hash of their id; a run holds each of its digests once, with the chosen identifier and the row count. In each round
every run exchanges with ``fan_in - 1`` partners: it hands each partner the digests whose digit of that round is the partner's, and
merges what it gets. Merging sorts the parts by digest and identifier and keeps the first row of each stretch of equal digests. A round
settles one digit, so after the last one all copies of a digest have met, each run holds its share of all digests and no run holds everything.
The way back down tells every run of the round before the winner.

A digest is matched at most ``fan_in`` times per merged run, so a group that holds a third of all rows is never gathered: its rows meet
only inside their own run.

A group is identified by SHA-256, byte length and a second 64-bit hash of the text together; two texts
count as equal only if all three agree, at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import unused, whole_text
from pagewright.session import durable

KEY = ["digest", "n_bytes", "mark"]


def digest_runs(docs: DataFrame, runs: int, id_column: str, text_column: str) -> DataFrame:
    text = whole_text(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("mark"),
        F.pmod(F.xxhash64(id_column), F.lit(runs)).cast("int").alias("run"),
    )


def _exchanged(place: int, fan_in: int) -> Column:
    """The run that a row goes to: its own, with the digit at ``place`` taken from the digest."""
    def digit(number: Column) -> Column:
        return F.floor(number / place) % fan_in

    share = F.pmod("mark", F.lit(place * fan_in).cast("long"))
    return (F.col("run") + (digit(share) - digit(F.col("run"))) * place).cast("int")


def _merged(parts: DataFrame, best: Column) -> DataFrame:
    """Sorted runs of the exchanged parts: of each stretch of equal digests the best identifier and the rows of all."""
    stretch = Window.partitionBy("run", *KEY).orderBy(best)
    whole = stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = parts.repartition("run").select(
        "run", *KEY, "keep_id", F.sum("group_size").over(whole).alias("group_size"), F.row_number().over(stretch).alias("place")
    )
    return ranked.filter("place = 1").drop("place")


def exact_groups(
    docs: DataFrame, keep: str = "largest", runs: int = 64, fan_in: int = 4, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` is ``largest`` or ``smallest``. A null text equals the empty text. A null id is never
    chosen unless the group has no other; rows repeated with id and text are all reported, each with
    kept = true if their id is the one that stays. An empty table gives no rows, and other columns
    are not read, whatever their names.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    pick, best = {"largest": (F.max, F.desc_nulls_last("keep_id")), "smallest": (F.min, F.asc_nulls_last("keep_id"))}[keep]
    rows = durable(digest_runs(docs, runs, id_column, text_column))
    settled = rows.groupBy("run", *KEY).agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    levels, place = [], 1
    while place < runs:
        up = _exchanged(place, fan_in)
        levels.append((settled.select("run", *KEY), up))
        settled = _merged(settled.withColumn("run", up), best)
        place *= fan_in
    while levels:
        lower, up = levels.pop()
        settled = lower.withColumn("up", up).join(settled.withColumnRenamed("run", "up"), ["up", *KEY]).drop("up")
    return rows.join(settled, ["run", *KEY]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, keep: str = "largest", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with all their columns.

    Rows that repeat both id and text are one document, of which one row stays. A null text counts as empty; columns of any name are kept.
    """
    own_id, own_sha, kept_id, kept_sha = unused(docs, "_id", "_sha", "_kept_id", "_kept_sha")
    groups = exact_groups(docs, keep, **options)
    stay = groups.filter("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha)).distinct()
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    marked = docs.withColumn(own_sha, F.sha2(whole_text(text_column), 256)).withColumn(own_id, F.col(id_column))
    match = F.col(own_id).eqNullSafe(F.col(kept_id)) & (F.col(own_sha) == F.col(kept_sha))
    return marked.join(stay, match, "left_semi").dropDuplicates([own_id, own_sha]).select(*docs.columns)


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""

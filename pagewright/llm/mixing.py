"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source, documents lie in key order; cells are ranges
of keys (the leading hex digits). Token counts are summed per cell, prefix sums over the cells of a source
and within a cell give each document its start, and the source is cut exactly where its budget ends. A
budget above the source's size repeats the whole source first. A hot source is spread over all its cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import space_words, unused, whole_text
from pagewright.operators.ordering import with_global_index, with_running_sum
from pagewright.session import durable

CELL_DIGITS = 3


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Targets per source from (no_source, source_key, size) rows.

    Sources by code point, null last, take the weights in turn. The total target is ``share`` of all sizes; a
    source stops at ``most`` times its size and the excess goes to the others by weight. That fills every
    source to least(most * size, level * weight), where the level is the largest of
    (total - sizes already capped) / (weights left) along the order of size per weight.
    """
    totals = sizes.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"))
    ranked = with_global_index(totals, ["no_source", "source_key"], "place")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.select(
        "no_source", "source_key", "source_size", (F.col("source_size") * most).alias("cap"),
        F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).cast("long").alias("weight"),
    )
    order = [F.col("cap") / F.col("weight"), F.col("no_source"), F.col("source_key")]
    upto = with_running_sum(with_running_sum(weighed, order, "cap", "caps"), order, "weight", "weights")
    total = (sizes.select((F.sum("size") * F.lit(float(share))).alias("t"))).scalar()
    all_weights = weighed.select(F.sum("weight").alias("w")).scalar()
    levels = upto.withColumn(
        "level", (total - (F.col("caps") - F.col("cap"))) / (all_weights - (F.col("weights") - F.col("weight")))
    )
    level = levels.agg(F.max("level")).scalar()
    return weighed.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight")))


def mix_plan(
    docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2, id_column: str = "doc_id",
    text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, times.

    ``size`` counts words (null text: 0). ``taken`` is exact: in every source the taken words sum up to the
    target, rounded down; the document at the cut gives its first words. ``times`` counts whole documents
    instead: the epochs, and one more for every document that starts before the cut; an empty document is
    never taken. The order is by md5 of the id, then id and size, so reruns agree and repeated rows
    are each counted. A row without id goes by md5 of its text, so such rows spread over the cells; an empty table gives no rows.
    """
    sized = durable(docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).isNull().alias("no_source"),
        F.coalesce(F.col(source_column), F.lit("")).alias("source_key"),
        F.size(space_words(whole_text(text_column))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit(" "), whole_text(text_column))).cast("binary")).alias("key"),
    ).withColumn("cell", F.substring("key", 1, CELL_DIGITS)))
    source = ["no_source", "source_key"]
    targets = durable(source_targets(sized.select(*source, "size"), weights, share, most))
    cells = sized.groupBy(*source, "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy(*source).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_start", F.coalesce(F.sum("cell_size").over(before), F.lit(0))).join(targets, source)
    within = Window.partitionBy(*source, "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(cells, [*source, "cell"]).withColumn(
        "start", F.col("cell_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    budget = F.floor("target")
    safe = F.greatest(F.col("source_size"), F.lit(1))
    epochs, rest = F.floor(budget / safe), budget % safe
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        F.when(F.col("size") > 0, epochs + (part > 0).cast("long")).otherwise(0).cast("int").alias("times"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, a row per epoch in which a document is taken.

    Rows that repeat an id share the largest number of times among them. A null text has no words, so it is never taken; columns of any name are kept.
    """
    own, planned, times, epoch = unused(docs, "_own", "_id", "_times", "_epoch")
    plan = mix_plan(docs, **options).groupBy(F.col("doc_id").alias(planned)).agg(F.max("times").alias(times))
    taken = plan.filter(F.col(times) > 0)
    joined = docs.withColumn(own, F.col(options.get("id_column", "doc_id")))
    return (
        joined.join(taken, F.col(own).eqNullSafe(F.col(planned)))
        .withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*docs.columns)
    )


SQL = """
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS k,
         len(list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM totals),
summed AS (
  SELECT *, CAST(sum(cap) OVER o AS BIGINT) AS caps, CAST(sum(weight) OVER o AS BIGINT) AS weights FROM weighed
  WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT max((1.5::DOUBLE * (SELECT CAST(sum(source_size) AS BIGINT) FROM totals) - (caps - cap))
             / ((SELECT CAST(sum(weight) AS BIGINT) FROM weighed) - (weights - weight))) AS v FROM summed),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT v FROM level) * weight) AS target FROM weighed),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         greatest(t.source_size, 1) AS whole,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((budget // whole) * size + greatest(0, least(size, budget % whole - start)) AS BIGINT) AS taken
FROM placed
"""

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import (
    collocations, context_mixing, exact_dedup, license_scan, mixing, near_dedup, periodic_runs, pieces, positional_index, quality_classifier, quality_rules,
    substring_dedup, token_rollup,
)
from pagewright.llm.common import documents, space_words, whole_text
from pagewright.session import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


@register("op1_license_scan", license_scan.SQL)
def op1(spark, folder):
    return license_scan.license_scan(documents(spark, folder))


@register("op2_sentencepiece")
def op2(spark, folder):
    return pieces.piece_digests(documents(spark, folder))


@register("op3_near_dedup")
def op3(spark, folder):
    return near_dedup.near_classes(documents(spark, folder), width=3, similarity=0.85)


@register("op4_token_counts", token_rollup.SQL)
def op4(spark, folder):
    """All documents under two tokenizer versions, then deletes (poor quality) and revised counts (shouting marks
    taken out), each batch committed, the last two committed twice. Rows without id, which no batch can revise, come
    with the revised text at once."""
    docs, store = documents(spark, folder), workspace(spark, "token-counts")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    poor = labels.filter("quality = 0").select("doc_id")
    loud = F.contains(F.coalesce("text", F.lit("")), F.lit("!!"))
    quiet = docs.filter(loud).withColumn("text", F.replace("text", F.lit("!!"), F.lit(" ")))
    revised = quiet.filter("doc_id IS NOT NULL").join(poor, "doc_id", "left_anti")
    first = docs.withColumn("text", F.when(F.col("doc_id").isNull(), F.replace("text", F.lit("!!"), F.lit(" "))).otherwise(F.col("text")))
    plain = docs.withColumn("text", F.replace("text", F.lit("|"), F.lit(" ")))
    batches = {
        1: token_rollup.upserts(first, "space-1").unionByName(token_rollup.upserts(plain, "space-2")),
        2: token_rollup.deletes(poor),
        3: token_rollup.upserts(revised, "space-1"),
    }
    for batch in (1, 2, 3, 2, 3):
        token_rollup.commit(spark, store, batch, batches[batch])
    return token_rollup.totals(spark, store)


@register("op5_quality_classifier")
def op5(spark, folder):
    docs = documents(spark, folder)
    model = quality_classifier.fit_quality_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality_classifier.score_quality(docs, model)


@register("op6_exact_dedup", exact_dedup.SQL)
def op6(spark, folder):
    return exact_dedup.exact_groups(documents(spark, folder), keep="largest")


@register("op7_lm_scoring")
def op7(spark, folder):
    return context_mixing.score_texts(documents(spark, folder))


@register("op8_source_mix", mixing.SQL)
def op8(spark, folder):
    return mixing.mix_plan(documents(spark, folder)).drop("times")


@register("op9_substring_dedup", substring_dedup.SQL)
def op9(spark, folder):
    return substring_dedup.repeated_passages(documents(spark, folder)).drop("kept_text")


@register("op10_quality_rules")
def op10(spark, folder):
    return quality_rules.quality_rules(documents(spark, folder))


@register("op11_benchmark_decontamination", positional_index.SQL)
def op11(spark, folder):
    return positional_index.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def looped_tails(docs: DataFrame) -> DataFrame:
    """``docs`` where the text of some ids ends in a loop of its own words: with h = crc32 of the id, h % 10 = 0 and g = h // 10, each word
    i >= a = g % n becomes word a + (i - a) % p with p = 1 + (n - a) // (3 + g % 8). Texts without id or words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = space_words(whole_text())
    shaped = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    shaped = shaped.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("w"))
    shaped = shaped.withColumn("a", F.expr("IF(n > 0, g % n, NULL)")).withColumn("p", F.expr("IF(n > 0, 1 + (n - a) div (3 + g % 8), NULL)"))
    looped = F.expr("array_join(transform(sequence(0, n - 1), i -> element_at(w, CAST(IF(i < a, i, a + (i - a) % p) AS INT) + 1)), ' ')")
    return shaped.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


@register("op12_periodic_runs")
def op12(spark, folder):
    return periodic_runs.run_digests(periodic_runs.find_runs(looped_tails(documents(spark, folder))))


@register("op13_collocations", collocations.SQL)
def op13(spark, folder):
    return collocations.mine_collocations(documents(spark, folder))

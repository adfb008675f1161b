"""License scans: exact set-similarity join of text blocks with license templates.

A block is a stretch of ``BLOCK`` words; blocks start every half block, so a notice of up to half a block lies whole
in one. A block matches a template when it holds at least ``threshold`` of the template's distinct tokens, and the template's mark, a few
words that tell it from its kin, starts in the block. Tokens are
ordered by how many documents hold them, rare first. A matching block must hold one of the template's first
n - need + 1 tokens in that order (prefix), have at least ``need`` template tokens (length), and from the first shared
token on there must be enough tokens left on both sides (position). Survivors are counted exactly, so the
filters lose nothing. All of it is DataFrame operations; what is broadcast is the fixed template list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import pinned
from pagewright.llm.common import whole_text
from pagewright.session import durable

BLOCK = 64
THRESHOLD = 0.8
#: Phrases that must stand word by word, and the label of each.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices by label, as words, and the words that must stand together in a block for the notice to be meant: they tell
#: licenses apart whose notices share nearly all words. A notice has at most half a block of words.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that", "source and binary forms"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights", "waived all copyright"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("proprietary", "all rights reserved no part of this work may be reproduced without written permission", "all rights reserved"),
)
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def license_words(text: Column) -> Column:
    """Words in lower case: runs of ASCII letters, digits and everything beyond ASCII.

    Only A-Z change what a word can equal: letters beyond ASCII never turn into ASCII ones, except the Kelvin sign,
    which is moved out of the way first.
    """
    lowered = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\ue000")))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _places(words: Column, phrase: str) -> Column:
    """0-based starts of a phrase in an array of words."""
    parts = phrase.split(" ")
    found = F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(f" {phrase} "))

    def here(i):
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(words, i + k) == part)
        return test

    steps = F.sequence(F.lit(0), F.size(words) - 1)
    return F.when(found, F.filter(steps, here)).otherwise(F.array().cast("array<int>"))


def _templates(spark, templates, threshold: float) -> DataFrame:
    rows = [
        (k, label, sorted(set(notice.split(" "))), f"# {mark}")
        for k, (label, notice, mark) in enumerate(templates)
    ]
    frame = spark.createDataFrame(rows, "template int, label string, tokens array<string>, mark string")
    n = F.size("tokens")
    return frame.withColumn("n", n).withColumn("need", F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int"))


def license_matches(keyed: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Blocks that meet the threshold: doc_id, text_key, block, template, label, shared, n.

    ``keyed`` has doc_id, text_key and words.
    """
    assert all(len(notice.split(" ")) <= block // 2 for _, notice, _ in templates)
    spark = keyed.sparkSession
    notices = _templates(spark, templates, threshold)
    vocabulary = F.array(*[F.lit(t) for t in sorted({t for _, notice, _ in templates for t in notice.split(" ")})])
    tokens = notices.select(F.explode("tokens").alias("token")).distinct()
    held = keyed.select(F.explode(F.array_intersect("words", vocabulary)).alias("token")).groupBy("token").count()
    # One row per token of the fixed templates, so one window over all of them is bounded.
    ranks = durable(tokens.join(held, "token", "left").select(
        "token", F.row_number().over(Window.orderBy(F.coalesce("count", F.lit(0)), "token")).alias("rank")
    ))
    ordered = durable(
        notices.select("template", "label", "mark", "n", "need", F.explode("tokens").alias("token"))
        .join(ranks, "token")
        .groupBy("template", "label", "mark", "n", "need").agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    )
    prefix = ordered.select(
        "*", F.posexplode(F.slice("ranks", F.lit(1), F.col("n") - F.col("need") + 1)).alias("at", "rank")
    )
    rare = prefix.join(ranks, "rank").agg(F.collect_set("token")).scalar()
    half = block // 2
    # The words of the notices with their places, and the places of the marks, which no word can equal.
    spots = F.filter(F.transform("words", lambda t, i: F.struct(i.alias("pos"), t.alias("token"))), lambda x: F.array_contains(vocabulary, x["token"]))
    def places(mark: str) -> Column:
        return F.transform(_places(F.col("words"), mark), lambda i: F.struct(i.alias("pos"), F.lit(f"# {mark}").alias("token")))

    marks = [places(mark) for mark in sorted({mark for *_, mark in templates})]
    hits = (
        keyed.filter(F.arrays_overlap("words", rare))
        .select("doc_id", "text_key", F.inline(F.concat(spots, *marks)))
        .join(F.broadcast(ranks), "token", "left")
        .withColumn("mark", F.when(F.col("rank").isNull(), F.col("token")))
        .withColumn("last", F.floor(F.col("pos") / half))
        .select("doc_id", "text_key", "rank", "mark", F.explode(F.array("last", F.col("last") - 1)).alias("block"))
        .filter("block >= 0")
        .groupBy("doc_id", "text_key", "block")
        .agg(F.sort_array(F.collect_set("rank")).alias("held"), F.collect_set("mark").alias("marks"))
    )
    probes = hits.select("*", F.posexplode("held").alias("place", "rank"))
    left = F.least(F.col("n") - F.col("at"), F.size("held") - F.col("place"))
    shared = F.size(F.array_intersect("held", "ranks"))
    return (
        probes.join(F.broadcast(prefix), "rank")
        .filter((F.size("held") >= F.col("need")) & (left >= F.col("need")))
        .withColumn("shared", shared)
        .filter("shared >= need AND array_contains(marks, mark)")
        .select("doc_id", "text_key", "block", "template", "label", "shared", "n")
        .distinct()
    )


def license_scan(
    docs: DataFrame, phrases=None, templates=TEMPLATES, threshold: float = THRESHOLD, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts every place of every phrase, first and last word are the smallest and largest start. ``labels`` adds
    the labels of matching notices to the base ones. ``score`` is 1 where a phrase stands, else the largest
    share of a template's tokens among the matches, else 0. A null or empty text has no words and no labels; repeated
    rows are each reported; texts of rows that share an id are kept apart; other columns are not read.
    """
    phrases = PHRASES if phrases is None else phrases
    text = whole_text(text_column)
    keyed = pinned(
        docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("_text")),
        words=license_words(F.col("_text")),
    ).drop("_text")
    facts = license_matches(keyed, templates, threshold).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("n")).alias("share")
    )
    with_places = pinned(keyed, **{f"at_{k}": _places(F.col("words"), p) for k, p in enumerate(phrases)})
    every = F.concat(*[F.col(f"at_{k}") for k in range(len(phrases))])
    base = F.array_distinct(F.array_compact(F.array(*[
        F.when(F.size(f"at_{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values())
    ])))
    rows = with_places.select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
        F.size("words").cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        base.alias("base"),
    )
    match = rows["_id"].eqNullSafe(facts["doc_id"]) & (rows["_key"] == facts["text_key"])
    both = F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>"))))
    return rows.join(facts, match, "left").select(
        F.col("_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    def quoted(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    phrases = ", ".join(f"({quoted(p.split(' '))}, '{label}')" for p, label in PHRASES.items())
    notices = ", ".join(
        f"({quoted(sorted(set(n.split(' '))))}, '{label}', {math.ceil(len(set(n.split(' '))) * THRESHOLD - 1e-9)}, {quoted(mark.split(' '))})"
        for label, n, mark in TEMPLATES
    )
    return f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents),
base AS (
  SELECT doc_id, p.label, i FROM w, (VALUES {phrases}) p(phrase, label), unnest(range(len(words))) t(i)
  WHERE words[i + 1 : i + len(phrase)] = phrase),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS base FROM base GROUP BY doc_id),
m AS (
  SELECT doc_id, n.label, n.tokens, n.need, n.mark, words[s + 1 : s + {BLOCK} + 8] AS own,
         len(list_intersect(list_distinct(words[s + 1 : s + {BLOCK}]), n.tokens)) AS shared
  FROM w, unnest(range(0, len(words), {BLOCK // 2})) t(s), (VALUES {notices}) n(tokens, label, need, mark)),
f AS (
  SELECT doc_id, list(DISTINCT label) AS found, max(shared / len(tokens)) AS share FROM m
  WHERE shared >= need AND len(list_filter(range({BLOCK}), lambda i: own[i + 1 : i + len(mark)] = mark)) > 0 GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(coalesce(base, []) || coalesce(found, []))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)
"""


SQL = _sql()

"""Benchmark decontamination by a distributed positional inverted index.

Texts are gathered into blocks of bounded size. For every word of a block, the index stores one posting list: the places where the word stands in the
block, ascending, as differences. Between two texts one place stays empty, so no phrase reaches over the end of a text. The index is a Parquet table that
grows with the corpus and is written without a shuffle; a word that holds a third of all places is one list per block.

A phrase is looked up from its rarest words: its two rarest words decide which blocks are asked at all, and in such a block the lists are shifted by the
word's offset and intersected, rarest first, until no start is left. With ``slack`` a word may stand that many places off (proximity matches).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, text_bytes, whole_text, word_codes
from pagewright.operators.ordering import attach_group_facts, with_global_index
from pagewright.session import durable, workspace

WIDTH = 10
BLOCK_BYTES = 8 << 20
#: Terms of the looked-up phrases are broadcast up to so many bytes; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEX = "block long, term string, n int, places binary, row int, doc_id long, first int"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _is_word_byte(b: int) -> bool:
    return b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A


#: Lower-cases A-Z and turns every byte between words into a blank.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if _is_word_byte(b) else 0x20 for b in range(256))


def folded_words(text: Column) -> Column:
    """The words of a text, as ``FOLD`` gives them on executors."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(PATTERN), F.lit(0))


def _posting_lists(codes: np.ndarray, places: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Differences of the places of every code, list after list, and where each list starts."""
    keyed = np.sort(codes << 32 | places)
    starts = np.zeros(terms + 1, np.int64)
    np.cumsum(np.bincount(codes, minlength=terms), out=starts[1:])
    flat = (keyed & 0xFFFFFFFF).astype(np.int32)
    steps = np.diff(flat, prepend=np.int32(0))
    steps[starts[:-1]] = flat[starts[:-1]]
    return steps, starts


def places_of(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<i4"), dtype=np.int64)


def write_index(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the index of whole texts to ``path``: posting lists, and one record (``term`` null) per text.

    A null or empty text has a record without words; repeated and missing ids are kept, every row has a record of its own.
    Other columns are not read. A text of any length lies in one block.
    """

    def build(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            raw = text_bytes(batch["text"])
            for start, end in chunks(raw, BLOCK_BYTES):
                codes, starts, distinct = word_codes([t.translate(FOLD) for t in raw[start:end]])
                rows = end - start
                firsts = starts[:-1] + np.arange(rows)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(block, pa.int64()), rows), pa.nulls(rows, pa.string()), pa.array(np.diff(starts).astype(np.int32)),
                    pa.nulls(rows, pa.binary()), pa.array(np.arange(rows, dtype=np.int32)), batch["doc_id"].slice(start, rows),
                    pa.array(firsts.astype(np.int32)),
                ], names)
                if distinct:
                    places = np.arange(len(codes)) + np.repeat(np.arange(rows), np.diff(starts))
                    steps, cuts = _posting_lists(codes, places, len(distinct))
                    blobs = pa.Array.from_buffers(pa.binary(), len(distinct), [None, pa.py_buffer((cuts * 4).astype("<i4").tobytes()), pa.py_buffer(steps.tobytes())])
                    some = len(distinct)
                    yield pa.RecordBatch.from_arrays([
                        pa.repeat(pa.scalar(block, pa.int64()), some), pa.array(distinct, pa.binary()).cast(pa.string()),
                        pa.array(np.diff(cuts).astype(np.int32)), blobs, pa.nulls(some, pa.int32()), pa.nulls(some, pa.int64()), pa.nulls(some, pa.int32()),
                    ], names)
                block += 1

    names = [part.split(" ")[0] for part in INDEX.split(", ")]
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    texts.mapInArrow(build, INDEX).write.option("compression", "zstd").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


def text_rows(index: DataFrame) -> DataFrame:
    """One row per indexed text: block, row, doc_id, n_words."""
    return index.filter("term IS NULL").select("block", "row", "doc_id", F.col("n").cast("long").alias("n_words"))


def phrases_of(texts: DataFrame, width: int = WIDTH, id_column: str = "item_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows of ``width`` words as (phrase, words), and which text holds which: (phrase, item_id as string).

    A text of fewer words is one window; a text without words has none. A missing id reads as the empty string.
    """
    words = texts.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"), folded_words(whole_text(text_column)).alias("all"))
    firsts = F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)))
    windows = durable(
        words.filter(F.size("all") > 0)
        .select("item_id", F.explode(F.transform(firsts, lambda i: F.array_join(F.slice("all", i + 1, width), " "))).alias("joined"))
        .distinct()
    )
    numbered = durable(with_global_index(windows.select("joined").distinct(), ["joined"], "phrase"))
    held = attach_group_facts(windows, numbered, ["joined"], ["item_id"]).select("phrase", "item_id")
    return numbered.select("phrase", F.split("joined", " ").alias("words")), held


def _lookup(lists: pa.Table, asked: pa.Table, slack: int) -> pa.Table:
    """Matches of the asked phrases in one block; ``lists`` holds its posting lists and its texts."""
    out = {"block": [], "row": [], "doc_id": [], "phrase": [], "start": []}
    terms = lists["term"].to_pylist()
    texts = [k for k, t in enumerate(terms) if t is None]
    held = {t: k for k, t in enumerate(terms) if t is not None}
    blobs, decoded = lists["places"], {}
    firsts = np.asarray(lists["first"].take(pa.array(texts, pa.int64())).to_pylist(), np.int64)
    order = np.argsort(firsts)
    firsts, texts = firsts[order], np.asarray(texts)[order]
    ends = firsts + np.asarray(lists["n"].take(pa.array(texts, pa.int64())).to_pylist(), np.int64)
    for phrase, words, offsets in zip(*(asked[c].to_pylist() for c in ("phrase", "words", "offsets")), strict=True):
        if any(w not in held for w in words):
            continue
        starts = low = high = None
        for word, offset in zip(words, offsets, strict=True):
            if word not in decoded:
                decoded[word] = places_of(blobs[held[word]].as_py())
            places = decoded[word]
            if starts is None:
                shifts = np.arange(-slack, slack + 1)
                own = np.searchsorted(firsts, places, "right") - 1
                starts = ((places - offset)[:, None] + shifts).ravel()
                low, high = np.repeat(firsts[own], len(shifts)), np.repeat(ends[own], len(shifts))
                continue
            at = np.searchsorted(places, np.maximum(starts + offset - slack, low))
            nearest = places[np.minimum(at, len(places) - 1)]
            fits = (at < len(places)) & (nearest <= np.minimum(starts + offset + slack, high - 1))
            starts, low, high = starts[fits], low[fits], high[fits]
            if not len(starts):
                break
        if len(starts):
            pairs = np.unique(np.stack([low, starts]), axis=1)
            out["row"].append(texts[np.searchsorted(firsts, pairs[0])])
            out["start"].append(pairs[1] - pairs[0])
            out["phrase"].append(np.full(pairs.shape[1], phrase, np.int64))
    rows = np.concatenate(out["row"]) if out["row"] else np.zeros(0, np.int64)
    take = pa.array(rows, pa.int64())
    return pa.table({
        "block": lists["block"].take(take), "row": lists["row"].take(take), "doc_id": lists["doc_id"].take(take),
        "phrase": pa.array(np.concatenate(out["phrase"]) if out["phrase"] else rows, pa.int64()),
        "start": pa.array((np.concatenate(out["start"]) if out["start"] else rows).astype(np.int32)),
    })


def find_phrases(index: DataFrame, phrases: DataFrame, slack: int = 0) -> DataFrame:
    """Every place where a phrase stands: block, row, doc_id, phrase, start (word number in its text).

    ``phrases`` has a unique ``phrase`` number and its ``words``. With ``slack`` 0 the words stand consecutively. Otherwise a start
    matches if every word of the phrase occurs in the same text at most ``slack`` places from its own place after that start (the
    start may then lie up to ``slack`` places outside of the text). Phrases that hold a word without postings match nowhere.
    """
    spelled = phrases.select("phrase", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    terms = durable(spelled.select("term").distinct())
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 24), F.lit(0))).first()[0]
    wanted = index.filter("term IS NOT NULL").join(F.broadcast(terms) if size <= BROADCAST_BYTES else terms, "term", "left_semi")
    known = durable(wanted.groupBy("term").agg(F.sum("n").alias("times")))
    ranked = (
        attach_group_facts(spelled, known, ["term"], ["phrase", "offset"]).filter("times IS NOT NULL")
        .groupBy("phrase", "length").agg(F.sort_array(F.collect_list(F.struct("times", "term", "offset"))).alias("order"))
        .filter(F.size("order") == F.col("length"))
        .select("phrase", F.col("order.term").alias("words"), F.col("order.offset").alias("offsets"))
    )
    rarest = durable(ranked.withColumn("distinct", F.array_distinct("words")))
    held = wanted.select("term", "block")
    asked = rarest.select("*", F.col("distinct")[0].alias("term")).join(held, "term").drop("term")
    second = F.get("distinct", F.lit(1))
    both = asked.withColumn("term", F.coalesce(second, F.col("distinct")[0])).join(held, ["term", "block"], "left_semi")
    asked = both.select(F.col("block").alias("asked"), "phrase", "words", "offsets")
    texts = index.filter("term IS NULL")
    lists = wanted.select(*index.columns).unionAll(texts)
    return lists.groupBy("block").cogroup(asked.groupBy("asked")).applyInArrow(
        lambda left, right: _lookup(left, right, slack), "block long, row int, doc_id long, phrase long, start int"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of a window of ``width`` consecutive words of an item (a shorter item is one window). ``n_items`` counts
    the ids of items with such a window, ``items_sha256`` digests them, sorted as strings and joined by commas. Null and empty texts have no
    words; rows that repeat an id, or have none, are judged one by one; items that repeat an id count once. Other columns are not read.
    """
    spark = docs.sparkSession
    path = workspace(spark, "postings")
    write_index(docs, path, id_column, text_column)
    index = read_index(spark, path)
    phrases, held = phrases_of(benchmark, width, item_column, item_text)
    phrases = durable(phrases)
    found = workspace(spark, "matches")
    find_phrases(index, phrases).join(phrases.select("phrase", F.size("words").alias("length")), "phrase").write.parquet(found)
    matches = spark.read.parquet(found)

    row = ["block", "row"]
    earlier = W.partitionBy(*row).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    stretches = matches.groupBy(*row, "start").agg(F.max("length").alias("length")).withColumn("end", F.col("start") + F.col("length"))
    reached = stretches.withColumn("reached", F.greatest(F.coalesce(F.max("end").over(earlier), F.lit(0)), F.col("start")))
    hits = reached.groupBy(*row).agg(F.sum(F.greatest(F.col("end") - F.col("reached"), F.lit(0))).alias("n_hit"))

    # Documents with the same phrases hold the same items: the list of items is made once for each set of phrases.
    sets = matches.groupBy(*row).agg(F.sort_array(F.collect_set("phrase")).alias("phrases"))
    sets = durable(sets.withColumn("set", F.sha2(F.to_json("phrases"), 256)))
    items = (
        sets.groupBy("set").agg(F.first("phrases").alias("phrases")).select("set", F.explode("phrases").alias("phrase"))
        .join(held, "phrase").groupBy("set").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    listed = attach_group_facts(sets.select(*row, "set"), items, ["set"], row).drop("set")
    return text_rows(index).join(hits, row, "left").join(listed, row, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
asked AS (
  SELECT DISTINCT item, least(len(words), 10) AS width, array_to_string(words[i + 1 : i + 10], ' ') AS phrase
  FROM b, unnest(range(greatest(len(words) - 9, 1))) t(i) WHERE len(words) > 0),
widths AS (SELECT DISTINCT width FROM asked),
places AS (
  SELECT r, width, i, array_to_string(words[i + 1 : i + width], ' ') AS phrase FROM w, widths, unnest(range(len(words) - width + 1)) t(i)),
found AS (SELECT DISTINCT r, width, i, phrase FROM places SEMI JOIN asked USING (width, phrase)),
hits AS (SELECT r, count(DISTINCT p) AS n FROM found, unnest(range(i, i + width)) t(p) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM found JOIN asked USING (width, phrase)) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

"""Substring dedup by repeated-phrase automata.

A passage is a window of ``WINDOW`` consecutive words. Its phrase is the stretch of ``PHRASE`` words in it whose hash is smallest, so equal
passages have equal phrases, wherever they stand. Phrases found in more than one document are recurring. Documents are dealt into
shards of bounded size; each shard compiles an Aho-Corasick automaton of the recurring phrases its documents hold and streams these
documents through it, which locates every occurrence. Only windows around an occurrence are hashed (96 bits); the
smallest document of each window decides who keeps it.

Documents that repeat a smaller document word by word need none of this: all their windows are covered.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, mixed, text_bytes, whole_text, word_codes, word_hashes
from pagewright.session import durable, workspace

WINDOW = 50
PHRASE = 8
SHARD_WORDS = 1_000_000
_ODD = 0x9DDFEA08EB382D69
_OTHER = 0xD6E8FEB86659FD93


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every stretch of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(_ODD) + words[k:k + n]
    return mixed(out)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    extra = width - span
    return np.minimum(values[:len(values) - extra], values[extra:]) if extra else values


def _window_hashes(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes (64 and 32 bits) of every window, from prefix sums of a polynomial."""
    both = []
    for base in (_ODD, _OTHER):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(len(words), base, np.uint64)], dtype=np.uint64)
        inverse = pow(base, -1, 1 << 64)
        back = np.cumprod(np.r_[np.uint64(1), np.full(len(words), inverse, np.uint64)], dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(words * powers[:-1], dtype=np.uint64)]
        n = max(len(words) - window + 1, 0)
        both.append(mixed((sums[window:window + n] - sums[:n]) * back[:n]))
    return both[0].view(np.int64), (both[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a stretch of ``width`` that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(np.asarray(starts) + width, n), -1)
    return np.cumsum(change[:-1]) > 0


def _locate(body: str, ends: np.ndarray, automaton, phrase: int) -> np.ndarray:
    """First words of every phrase occurrence in `` w w w ``; ``ends`` are the places of the blanks after the words."""
    found = np.fromiter((end for end, _ in automaton.iter(body)), np.int64)
    return np.unique(np.searchsorted(ends, found)) - (phrase - 1) if len(found) else found


def _shard_windows(rows: pd.DataFrame, phrases: pd.DataFrame, window: int, phrase: int) -> pd.DataFrame:
    import ahocorasick

    out = {"doc_id": [], "digest": [], "body": [], "starts": [], "times": [], "h1": [], "h2": []}
    wanted = set(zip(phrases["doc_id"], phrases["digest"], strict=True))
    recurring = np.unique(phrases["phrase"].to_numpy(np.int64).view(np.uint64)) if len(phrases) else np.zeros(0, np.uint64)
    docs = []
    automaton = ahocorasick.Automaton()
    for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
        words = text.encode("utf-8", "surrogatepass").split()
        digest = xxhash.xxh3_128_digest(b" ".join(words))
        if (doc_id, digest) not in wanted:
            continue
        wanted.discard((doc_id, digest))
        hashes = word_hashes(words)
        rolled = _rolled(hashes, phrase)
        fresh = np.flatnonzero(np.isin(rolled, recurring))
        for at in fresh[np.unique(rolled[fresh], return_index=True)[1]].tolist():
            automaton.add_word(" " + b" ".join(words[at:at + phrase]).decode("utf-8", "surrogatepass") + " ", at)
        docs.append((doc_id, digest, words, hashes))
    if docs:
        automaton.make_automaton()
    for doc_id, digest, words, hashes in docs:
        body = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
        lengths = [len(w) for w in body[1:-1].split(" ")]
        ends = np.cumsum(np.asarray(lengths) + 1)
        places = _locate(body, ends, automaton, phrase)
        reach = window - phrase + 1
        first = np.maximum(places - (reach - 1), 0)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, places + 1, -1)
        near = np.flatnonzero(np.cumsum(change)[:max(len(words) - window + 1, 0)] > 0)
        h1, h2 = (h[near] for h in _window_hashes(hashes, window))
        # A window that a document repeats is one row: the starts follow in the order of the distinct windows.
        order = np.lexsort((near, h2, h1))
        h1, h2 = h1[order], h2[order]
        fresh = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]) if len(order) else order
        out["doc_id"].append(doc_id)
        out["digest"].append(digest)
        out["body"].append(body[1:-1])
        out["starts"].append(near[order].astype(np.int32))
        out["times"].append(np.diff(np.r_[fresh, len(order)]).astype(np.int32))
        out["h1"].append(h1[fresh])
        out["h2"].append(h2[fresh])
    return pd.DataFrame({name: pd.Series(values, dtype="int64" if name == "doc_id" else object) for name, values in out.items()})


def repeated_passages(
    docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, shard_words: int = SHARD_WORDS, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept_text.

    A word is removed if a window over it also starts in a document with a smaller id; windows are judged on the input. ``kept_text``
    are the words that stay, joined by one space; it is null where nothing is removed. A null text has no words. Rows that
    repeat an id do not take words from each other; a row without id neither loses words nor takes them. Other
    columns are not read.
    """

    def sketch(batches):
        for batch in batches:
            raw = text_bytes(batch["text"])
            counts, digests, shas, anchors = [], [], [], []
            for start, end in chunks(raw):
                codes, starts, distinct = word_codes(raw[start:end])
                words = word_hashes(distinct)[codes] if distinct else np.zeros(0, np.uint64)
                rolled = _rolled(words, phrase)
                for i in range(end - start):
                    a, b = starts[i], starts[i + 1]
                    joined = b" ".join((raw[start + i] or b"").split())
                    counts.append(int(b - a))
                    digests.append(xxhash.xxh3_128_digest(joined))
                    shas.append(hashlib.sha256(joined).hexdigest())
                    anchors.append(np.unique(_sliding_min(rolled[a:max(b - phrase + 1, a)], window - phrase + 1)).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(shas, pa.string()),
                pa.array(anchors, pa.list_(pa.int64())),
            ], ["doc_id", "n_words", "digest", "sha", "anchors"])

    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    sketches = durable(texts.mapInArrow(sketch, "doc_id long, n_words long, digest binary, sha string, anchors array<long>"))
    known = sketches.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    heads = durable(
        known.join(firsts, "digest").filter("doc_id = first_id").dropDuplicates(["digest"])
        .select("doc_id", "digest", "n_words", "anchors")
    )
    spread = heads.select("doc_id", "digest", F.explode("anchors").alias("phrase"))
    recurring = spread.groupBy("phrase").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("phrase")
    total = sketches.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards))
    held = spread.join(recurring, "phrase").select("doc_id", "digest", "phrase", shard.alias("shard"))
    located = texts.filter("doc_id IS NOT NULL").withColumn("shard", shard).groupBy("shard").cogroup(held.groupBy("shard")).applyInPandas(
        lambda rows, phrases: _shard_windows(rows, phrases, window, phrase),
        "doc_id long, digest binary, body string, starts array<int>, times array<int>, h1 array<long>, h2 array<int>",
    )
    path = workspace(spark, "passages")
    located.write.parquet(path)
    found = spark.read.parquet(path)
    places = F.sequence(F.lit(0), F.size("h1") - 1)
    windows = found.filter(F.size("h1") > 0).select(
        "doc_id", "digest", F.inline(F.arrays_zip(places.alias("place"), F.col("h1").alias("h1"), F.col("h2").alias("h2")))
    )
    smallest = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    gone = (
        windows.join(smallest, ["h1", "h2"]).filter("doc_id > least")
        .groupBy("doc_id", "digest").agg(F.collect_list("place").alias("gone"))
    )

    def cut(batches):
        for batch in batches:
            removed, shas, kept = [], [], []
            columns = [batch[c].to_pylist() for c in ("starts", "times", "gone")]
            for body, starts, times, gone in zip(text_bytes(batch["body"]), *columns, strict=True):
                words = body.split(b" ")
                chosen = np.zeros(len(times), bool)
                chosen[gone] = True
                drop = covered(np.asarray(starts, np.int64)[np.repeat(chosen, times)], window, len(words))
                rest = b" ".join(w for w, d in zip(words, drop.tolist(), strict=True) if not d)
                removed.append(int(drop.sum()))
                shas.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["digest"], pa.array(removed, pa.int64()), pa.array(shas), pa.array(kept, pa.binary()).cast(pa.string()),
            ], ["doc_id", "digest", "n_removed", "new_sha", "kept_text"])

    texts_left = found.select("doc_id", "digest", "body", "starts", "times").join(gone, ["doc_id", "digest"])
    cuts = texts_left.select("doc_id", "digest", "body", "starts", "times", "gone").mapInArrow(
        cut, "doc_id long, digest binary, n_removed long, new_sha string, kept_text string"
    )
    placed = sketches.drop("anchors").join(firsts, "digest", "left").join(cuts, ["doc_id", "digest"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return placed.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("new_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(words[i + 1 : i + 50], ' ')) AS h FROM w, unnest(range(len(words) - 49)) t(i)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM win JOIN least USING (h), unnest(range(i, i + 50)) t(p) WHERE doc_id > m),
lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, array_to_string(list(words[j + 1] ORDER BY j), ' ') AS body
  FROM w, unnest(range(len(words))) t(j) WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = w.doc_id AND g.p = j) GROUP BY w.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

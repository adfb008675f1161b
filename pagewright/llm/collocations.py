"""Phrase collocations by best-first branch and bound over word prefixes.

Cutting a phrase after its first word gives at most 1000 * n / f(first word), cutting it before its last word at most 1000 * n / f(last word), because no
phrase is more frequent than its parts. So the frontier is ordered by the count of a word: words are opened from the rarest on (but for those that are too rare for
any candidate). In a round, phrases that start with an open word grow to the right and phrases that end with one grow to the left, first by one word; only
pairs that are frequent grow on. A language is settled when its last place is held by a score above the bound of all unopened words, so that ties
are in as well; then, or when no word is left, its table is exact. Otherwise the next round opens the words that the score found so far asks for.

Texts become streams of word numbers, a row for each block of texts and language; words that cannot be in a candidate become gaps. Everything that is
counted is summed within a block first, so a language or a phrase with most of all rows is spread over the blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, text_bytes, whole_text
from pagewright.operators.ordering import attach_group_facts
from pagewright.session import durable, workspace

WORDS = 5
LEAST = 100
TOP = 2000
#: Share of the words of a language, by occurrences, that the first round opens; each further round without a full table opens four times the share.
SHARE = 1 / 16
#: Tables of frequent words and pairs are broadcast up to so many rows; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 200_000
BLOCK_BYTES = 4 << 20
#: Bytes of text of a block whose words are Python objects at a time.
PIECE_BYTES = 1 << 20
GAP = b"\xff"
#: Lower-cases A-Z; the marks between pieces become a byte that no text holds.
FOLD = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
STREAM = "block long, lang string, words array<string>, times array<int>, codes binary"
FREQUENT = "block long, lang string, ids array<long>, f array<long>, codes binary"


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written frame with a broadcast hint if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def packed(codes: np.ndarray) -> bytes:
    return zstandard.compress(codes.astype("<i4").tobytes(), 3)


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), "<i4").astype(np.int64)


def _block_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The folded words of a block as codes into its distinct words; words become Arrow data piece by piece, so few Python objects live at a time."""
    parts = []
    for start, end in chunks(texts, PIECE_BYTES):
        folded = (t.translate(FOLD).replace(GAP, b" \xff ") + b" \xff" for t in texts[start:end])
        parts.append(pa.array([w for t in folded for w in t.split()], pa.large_binary()))
    coded = pa.concat_arrays(parts).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _coded_blocks(batch, block: int):
    """The blocks of a batch of texts, numbered from ``block`` on; only the texts of one block are Python objects at a time, and memory that
    a block has left free is given back."""
    langs = np.asarray(batch["lang"].to_pylist(), object)
    sizes = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)
    for lang in dict.fromkeys(langs.tolist()):
        own = np.flatnonzero(langs == lang)
        before = np.cumsum(sizes[own]) - sizes[own]
        for part in np.split(own, np.flatnonzero(np.diff(before // BLOCK_BYTES)) + 1):
            codes, distinct = _block_words(text_bytes(batch["text"].take(pa.array(part))))
            gap = pc.index(distinct, GAP).as_py()
            codes = np.where(codes == gap, -1, codes - (codes > gap))
            distinct = pa.concat_arrays([distinct[:gap], distinct[gap + 1:]]).cast(pa.binary()).cast(pa.string())
            times = np.bincount(codes[codes >= 0], minlength=len(distinct)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([lang], pa.string()),
                pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct),
                pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), pa.array(times)),
                pa.array([packed(codes)], pa.binary()),
            ], ["block", "lang", "words", "times", "codes"])
            block += 1
            del codes, distinct, times
            pa.default_memory_pool().release_unused()


def _streams(texts: DataFrame) -> DataFrame:
    def code(batches):
        block = 1 + (TaskContext.get().partitionId() << 32)
        for batch in batches:
            for row in _coded_blocks(batch, block):
                yield row
                block += 1

    return texts.mapInArrow(code, STREAM)


def _gapped(block: pa.Array, lang: pa.Array, blob: bytes, local: np.ndarray, ids: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """A stream with gaps for all words but those numbered ``local`` in the block."""
    codes = unpacked(blob)
    place = np.full(max(codes.max(initial=-1) + 2, 1), -1)
    place[local] = np.arange(len(local))
    kept = place[codes]
    kept = kept[np.r_[True, (kept[1:] >= 0) | (kept[:-1] >= 0)]] if len(kept) else kept
    whole = pa.array([0, len(ids)], pa.int32())
    return pa.RecordBatch.from_arrays([
        block, lang, pa.ListArray.from_arrays(whole, pa.array(ids, pa.int64())),
        pa.ListArray.from_arrays(whole, pa.array(times, pa.int64())), pa.array([packed(kept)], pa.binary()),
    ], ["block", "lang", "ids", "f", "codes"])


def _keep_frequent(rows):
    """The streams with gaps for all words that are not in ``known`` (structs of number in the block, id, f)."""
    for batch in rows:
        for k in range(batch.num_rows):
            known = batch["known"].slice(k, 1).flatten()
            local, ids, times = (known.field(j).to_numpy(zero_copy_only=False) for j in range(3))
            yield _gapped(batch["block"].slice(k, 1), batch["lang"].slice(k, 1), batch["codes"][k].as_py(), local, ids, times)


def _frequent_streams(streams: DataFrame, entries: DataFrame, vocabulary: DataFrame, most: int) -> DataFrame:
    """The streams with gaps for all words that are not in ``vocabulary``, blocks without any left out.

    A vocabulary of at most ``most`` words goes to every task, which looks its blocks up; a larger one is joined to the words of the blocks.
    """
    if vocabulary.count() > most:
        known = (
            entries.select("block", "lang", "local", "word").join(vocabulary, ["lang", "word"])
            .groupBy("block", "lang").agg(F.collect_list(F.struct("local", "id", "f")).alias("known"))
        )
        return streams.select("block", "lang", "codes").join(known, ["block", "lang"]).select("block", "lang", "known", "codes").mapInArrow(_keep_frequent, FREQUENT)
    table = vocabulary.select("lang", "word", "id", "f").toArrow()
    shared = streams.sparkSession.sparkContext.broadcast({
        lang: [table.filter(pc.equal(table["lang"], lang))[c].combine_chunks() for c in ("word", "id", "f")] for lang in table["lang"].unique().to_pylist()
    })

    def look_up(rows):
        for batch in rows:
            for k in range(batch.num_rows):
                own = shared.value.get(batch["lang"][k].as_py())
                if own is not None:
                    at = pc.index_in(batch["words"].slice(k, 1).flatten().cast(own[0].type), own[0])
                    local = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                    if len(local):
                        ids, times = (c.take(at.drop_null()).to_numpy(zero_copy_only=False) for c in own[1:])
                        yield _gapped(batch["block"].slice(k, 1), batch["lang"].slice(k, 1), batch["codes"][k].as_py(), local, ids, times)

    return streams.select("block", "lang", "words", "codes").mapInArrow(look_up, FREQUENT)


def _pairs(rows):
    """Counts of the neighbours of which at least one is open (``f`` up to ``most``)."""
    for batch in rows:
        for k in range(batch.num_rows):
            codes = unpacked(batch["codes"][k].as_py())
            ids, f = (batch[c].slice(k, 1).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "f"))
            opened = f <= batch["most"][k].as_py()
            a, b = codes[:-1], codes[1:]
            both = (a >= 0) & (b >= 0)
            a, b = a[both], b[both]
            near = opened[a] | opened[b]
            keys, times = np.unique(a[near] * len(ids) + b[near], return_counts=True)
            n = len(keys)
            yield pa.RecordBatch.from_arrays([
                pa.repeat(batch["block"][k], n), pa.repeat(batch["lang"][k], n), pa.array(ids[keys // max(len(ids), 1)], pa.int64()),
                pa.array(ids[keys % max(len(ids), 1)], pa.int64()), pa.array(times, pa.int64()),
            ], ["block", "lang", "a", "b", "times"])


def _grams(stream: pa.Table, frequent: pa.Table, words: int) -> pa.Table:
    """Counts of the longer phrases of one stream that start or end with an open word and hold no infrequent pair."""
    phrases, sizes, counted = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lang = stream["lang"][0].as_py() if stream.num_rows else None
    if stream.num_rows and frequent.num_rows:
        codes = unpacked(stream["codes"][0].as_py())
        ids, f = (stream[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("ids", "f"))
        opened = np.r_[f <= stream["most"][0].as_py(), False]
        order = np.argsort(ids)
        a, b = (order[np.searchsorted(ids, frequent[c].to_numpy(), sorter=order)] for c in ("a", "b"))
        good = np.sort(a * len(ids) + b)
        pairs = codes[:-1] * len(ids) + codes[1:]
        joined = (codes[:-1] >= 0) & (codes[1:] >= 0)
        near = np.minimum(np.searchsorted(good, pairs), len(good) - 1)
        hot = joined & (good[near] == pairs)
        # A pair without an open word was not counted; it may be frequent.
        allowed = hot | (joined & ~opened[codes[:-1]] & ~opened[codes[1:]])
        starts = np.flatnonzero(allowed)
        for size in range(3, words + 1):
            starts = starts[starts + size <= len(codes)]
            starts = starts[allowed[starts + size - 2]]
            wanted = starts[opened[codes[starts]] | opened[codes[starts + size - 1]]]
            if len(wanted):
                number = np.zeros(len(wanted), np.int64)
                for j in range(size):
                    number = np.unique(number * len(ids) + codes[wanted + j], return_inverse=True)[1]
                _, first, times = np.unique(number, return_index=True, return_counts=True)
                phrases.append(ids[codes[wanted[first][:, None] + np.arange(size)]].ravel())
                sizes.append(np.full(len(first), size))
                counted.append(times)
    ends, phrases, counted = np.r_[0, np.cumsum(np.concatenate(sizes))], np.concatenate(phrases), np.concatenate(counted)
    grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(phrases, pa.int64()))
    return pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(grams)), "gram": grams, "times": pa.array(counted, pa.int64())})


def _scored(counts: DataFrame, words: DataFrame, state: DataFrame, least: int) -> DataFrame:
    """Surviving candidates whose first and last words are open: lang, gram, a, l, r, n, score."""
    ends = words.select("lang", "id", "f")
    limit = state.select("lang", "n", "most")
    opened = attach_group_facts(ends, limit, ["lang"], ["id"]).filter("f <= most").select("lang", "id", "n")
    whole = counts.filter(F.size("gram") > 1)
    inner = (
        whole.withColumn("id", F.col("gram")[0]).join(opened.drop("n"), ["lang", "id"], "left_semi")
        .withColumn("id", F.element_at("gram", -1)).join(opened, ["lang", "id"]).select("lang", "gram", "a", "n")
    )
    longer = whole.filter(F.size("gram") > 2).select("lang", "a", F.explode(F.array(
        F.slice("gram", F.lit(1), F.size("gram") - 1), F.expr("slice(gram, 2, size(gram) - 1)")
    )).alias("gram")).distinct()
    survivors = inner.join(longer, ["lang", "gram", "a"], "left_anti")
    cuts = survivors.select("*", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    left = counts.select("lang", F.col("gram").alias("head"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("gram").alias("rest"), F.col("a").alias("r"))
    parts = (
        cuts.withColumn("head", F.expr("slice(gram, 1, k)")).withColumn("rest", F.expr("slice(gram, k + 1, size(gram) - k)"))
        .join(left, ["lang", "head"]).join(right, ["lang", "rest"])
    )
    exact = "(1000 * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
    return parts.groupBy("lang", "gram", "a", "n").agg(
        F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    ).select("lang", "gram", "a", "cut.l", "cut.r", "n", "cut.score")


def _ranked(scored: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language, spelled."""
    spelled = (
        scored.select("*", F.posexplode("gram").alias("at", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "gram", "a", "l", "r", "n", "score")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def mine_collocations(
    docs: DataFrame, words: int = WORDS, least: int = LEAST, top: int = TOP, text_column: str = "text", lang_column: str = "lang", share: float = SHARE,
) -> DataFrame:
    """The best phrases of 2 to ``words`` words per language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at punctuation and line ends into pieces, these at blanks and tabs into words. ``a`` counts the
    phrase (``least`` at least), ``l`` and ``r`` its parts at the cut that gives the lowest score floor(1000 * a * n / (l * r)), ties to the earliest; ``n`` counts the
    words of the language. A phrase inside a longer one (up to ``words``) of the same count is left out. Null and empty texts have no words, a null language counts as
    ``und``; repeated rows count each; other columns are not read. Languages without such a phrase have no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), whole_text(text_column).alias("text"))
    path = workspace(spark, "streams")
    _streams(texts).write.option("compression", "uncompressed").parquet(path)
    streams = spark.read.schema(STREAM).parquet(path)

    entries = streams.select("block", "lang", F.posexplode(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times"))).alias("local", "e"))
    entries = entries.select("block", "lang", "local", "e.word", F.col("e.times").cast("long").alias("times"))
    totals = durable(
        streams.select("lang", F.aggregate("times", F.lit(0).cast("long"), lambda s, x: s + x).alias("times")).groupBy("lang").agg(F.sum("times").alias("n"))
    )
    counted = entries.groupBy("lang", "word").agg(F.sum("times").alias("f")).filter(F.col("f") >= least)
    vocabulary = durable(durable(counted).withColumn("id", F.monotonically_increasing_id()))
    path = workspace(spark, "frequent")
    _frequent_streams(streams, entries, vocabulary, BROADCAST_ROWS).write.option("compression", "uncompressed").parquet(path)
    frequent = spark.read.schema(FREQUENT).parquet(path)

    # Occurrences of the words up to each count, to open a share of a language: one row for each language and count.
    steps = vocabulary.groupBy("lang", "f").agg((F.count(F.lit(1)) * F.col("f")).alias("mass"))
    upto = W.partitionBy("lang").orderBy("f")
    steps = durable(steps.withColumn("mass", F.sum("mass").over(upto)).withColumn("widest", F.max("f").over(W.partitionBy("lang"))))
    sizes = steps.join(totals, "lang")

    def opened(part: float, asked: DataFrame | None) -> DataFrame:
        """Per open language, the largest count of the words to open: those that make up a share, or those the found score asks for."""
        by_share = sizes.groupBy("lang", "n", "widest").agg(
            F.coalesce(F.min(F.when(F.col("mass") >= F.col("n") * part, F.col("f"))), F.col("widest")).alias("most")
        )
        if asked is None:
            return durable(by_share.select("lang", "n", "widest", "most"))
        wider = F.when(F.col("asked").isNotNull(), F.least("asked", "widest")).otherwise(F.col("most"))
        return durable(by_share.join(asked, "lang").select("lang", "n", "widest", wider.alias("most")))

    state, done, parts = opened(share, None), None, share
    while True:
        pairs_path = workspace(spark, "pairs")
        limits = state.select("lang", "most")
        limited = frequent.join(F.broadcast(limits), "lang") if limits.count() <= BROADCAST_ROWS else attach_group_facts(frequent, limits, ["lang"], ["block"]).filter("most IS NOT NULL")
        limited = limited.select("block", "lang", "ids", "f", "codes", "most")
        limited.mapInArrow(_pairs, "block long, lang string, a long, b long, times long").write.option("compression", "zstd").parquet(pairs_path)
        pairs = spark.read.parquet(pairs_path)
        good = durable(pairs.groupBy("lang", "a", "b").agg(F.sum("times").alias("times")).filter(F.col("times") >= least))
        where = pairs.join(small_side(good.select("lang", "a", "b")), ["lang", "a", "b"], "left_semi").select(F.col("block").alias("own"), "a", "b")
        grams = limited.groupBy("block").cogroup(where.groupBy("own")).applyInArrow(
            lambda left, right: _grams(left, right, words), "lang string, gram array<long>, times long"
        )
        grams = grams.groupBy("lang", "gram").agg(F.sum("times").alias("a")).filter(F.col("a") >= least)
        singles = vocabulary.select("lang", F.array("id").alias("gram"), F.col("f").alias("a"))
        doubles = good.select("lang", F.array("a", "b").alias("gram"), F.col("times").alias("a"))
        counts = durable(singles.unionByName(doubles).unionByName(grams))
        table = durable(_ranked(_scored(counts, vocabulary, state, least), vocabulary, top))
        # Unopened words bound every other phrase by floor(1000 * n / (most + 1)); the last place must be above.
        last = table.filter(F.col("rank") == top).select("lang", "score")
        judged = state.join(last, "lang", "left").withColumn("rest", F.expr("(1000 * CAST(n AS DECIMAL(19, 0))) div (most + 1)"))
        settled = (F.col("most") >= F.col("widest")) | F.coalesce(F.col("score") > F.col("rest"), F.lit(False))
        judged = durable(judged.withColumn("settled", settled))
        ready = table.join(judged.filter("settled").select("lang"), "lang", "left_semi")
        done = ready if done is None else done.unionByName(ready)
        left = judged.filter("NOT settled").select("lang", F.expr("CAST((1000 * CAST(n AS DECIMAL(19, 0))) div score AS LONG)").alias("asked"))
        if not left.count():
            return done
        parts = min(parts * 4, 2.0)
        state = opened(parts, left)


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents)),
w AS (SELECT lang, p, unnest(words) AS w, unnest(range(len(words))) AS i FROM pieces),
totals AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, w AS a, lead(w, 1) OVER x AS b, lead(w, 2) OVER x AS c, lead(w, 3) OVER x AS d, lead(w, 4) OVER x AS e
  FROM w WINDOW x AS (PARTITION BY p ORDER BY i)),
grams AS (
  SELECT lang, a AS phrase, 1 AS m, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, a || ' ' || b, 2, count(*) FROM g WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, concat_ws(' ', a, b, c), 3, count(*) FROM g WHERE c IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, concat_ws(' ', a, b, c, d), 4, count(*) FROM g WHERE d IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, concat_ws(' ', a, b, c, d, e), 5, count(*) FROM g WHERE e IS NOT NULL GROUP BY ALL),
cand AS (SELECT * FROM grams WHERE m > 1 AND f >= 100),
parts AS (SELECT c.lang, c.phrase, c.f, k, string_split(c.phrase, ' ') AS w FROM cand c, unnest(range(1, m)) t(k)),
keyed AS (SELECT lang || ': ' || phrase AS key, f FROM grams),
cuts AS (
  SELECT p.lang, p.phrase, p.f, k, l.f AS l, r.f AS r, (1000 * p.f::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score, n
  FROM parts p JOIN totals USING (lang)
  JOIN keyed l ON l.key = p.lang || ': ' || array_to_string(p.w[1 : k], ' ')
  JOIN keyed r ON r.key = p.lang || ': ' || array_to_string(p.w[k + 1 :], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT c.lang, array_to_string(string_split(c.phrase, ' ')[i + 1 : i + z], ' ') AS phrase, c.f
  FROM cand c, unnest(range(2, m)) s(z), unnest(range(m - z + 1)) t(i))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS BIGINT) AS rank, phrase, CAST(f AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best b WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND i.f = b.f)
QUALIFY rank <= 2000
"""

"""Positional index, periodic runs and collocations against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pagewright.llm import collocations, periodic_runs, positional_index
from pagewright.llm.queries import QUERIES, looped_tails
from pagewright.session import workspace


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- positional index

def index_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def plain_contamination(rows, items, width):
    out = []
    windows = defaultdict(set)
    for item, text in items:
        words = index_words(text)
        for i in range(max(len(words) - width + 1, 1) if words else 0):
            windows[tuple(words[i:i + width])].add(str(item) if item is not None else "")
    sizes = {len(w) for w in windows}
    for doc_id, text in rows:
        words, hit, found = index_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                window = tuple(words[i:i + size])
                if window in windows:
                    hit.update(range(i, i + size))
                    found |= windows[window]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), sha, bool(hit)))
    return Counter(out)


@pytest.fixture(scope="module")
def leaked(spark, documents, odd):
    rng = random.Random(3)
    items = [(k, " ".join(f"q{rng.randint(0, 60)}" for _ in range(rng.choice([1, 4, 9, 10, 11, 30])))) for k in range(40)]
    items += [(None, "q1 q2 q3 q1 q2 q3 q1 q2 q3 q1 q2 q3"), (7, ""), (8, None), (9, " .,-! "), (3, "é İ W7x7!"), (41, items[2][1]), (41, items[2][1])]
    texts = []
    for k in range(60):
        words = [f"Q{rng.randint(0, 60)}" for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = (items[rng.randint(0, 39)][1]).split()
        texts.append((k, rng.choice([" ", "-", "\n"]).join(words)))
    texts += [(k, "q1 q2 q3 " * 30) for k in (5, 5, None)]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()] + texts
    return rows, items


@pytest.mark.parametrize("width", [3, 10])
def test_contamination_against_plain_search(spark, leaked, width, monkeypatch):
    rows, items = leaked
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(positional_index, "BROADCAST_BYTES", 0 if width == 3 else 1 << 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("term", F.lit("x")).withColumn("block", F.lit(1)).repartition(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("phrase", F.lit(2)).repartition(3)
    out = positional_index.contamination(docs, benchmark, width)
    assert Counter(tuple(r) for r in out.collect()) == plain_contamination(rows, items, width)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def plain_near(words, phrase, slack):
    found = set()
    for s in range(-slack, len(words) + slack):
        if all(w in words[max(s + k - slack, 0):max(s + k + slack + 1, 0)] for k, w in enumerate(phrase)):
            found.add(s)
    return found


@pytest.mark.parametrize("slack", [0, 1, 3])
def test_phrases_and_proximity(spark, slack):
    rng = random.Random(slack)
    rows = [(k, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 40)))) for k in range(30)]
    phrases = [(k, [rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))]) for k in range(25)]
    path = workspace(spark, "test-index")
    positional_index.write_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path)
    index = positional_index.read_index(spark, path)
    found = positional_index.find_phrases(index, spark.createDataFrame(phrases, "phrase long, words array<string>"), slack).collect()
    ours = Counter((r["doc_id"], r["phrase"], r["start"]) for r in found)
    assert ours == Counter((i, p, s) for i, text in rows for p, words in phrases for s in plain_near(text.split(), words, slack))
    assert sum(r["n_words"] for r in positional_index.text_rows(index).collect()) == sum(len(t.split()) for _, t in rows)


def test_contamination_of_empty_tables(spark, nothing, odd):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert positional_index.contamination(nothing, bench).count() == 0
    clean = positional_index.contamination(odd, bench).collect()
    assert len(clean) == odd.count() and not any(r["contaminated"] for r in clean)


# --- periodic runs

def plain_runs(words, least, power):
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, power * q) and not any(all(words[x] == words[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                found.append((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(4)
    for _ in range(400):
        words = [rng.randint(1, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 30))]
        words += [rng.randint(1, 3) for _ in range(rng.randint(1, 6))] * rng.randint(1, 5) + words[:4]
        for least, power in ((2, 2), (5, 2), (6, 3)):
            assert periodic_runs.runs_of(words, least, power) == plain_runs(words, least, power)


def test_link_cut_access_tells_last_ends():
    """Every access must name, for each stretch of the path to the root, the last access that went through it."""
    rng = random.Random(6)
    parents = [0, 0] + [rng.randint(1, k) for k in range(1, 60)]
    tree, last = periodic_runs.LastEnds(parents), {}
    for time in range(1, 300):
        node = rng.randint(1, 60)
        path = [node]
        while parents[path[-1]]:
            path.append(parents[path[-1]])
        expected = [(x, last[x]) for k, x in enumerate(path) if x in last and (not k or last.get(path[k - 1]) != last[x])]
        assert tree.access(node, time) == expected
        last.update(dict.fromkeys(path, time))


def plain_run_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(words, 24, 3)
    gone = {p for s, size, q in runs for p in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lists = hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest()
    return doc_id, len(runs), *facts, lists, hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()


def plain_tail(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return text
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))


def test_periodic_runs_of_the_tables(spark, folder, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect() if len((r["text"] or "").split()) < 700]
    kept = {i for i, _ in rows}
    expected = Counter(plain_run_row(i, plain_tail(i, t)) for i, t in rows)
    ours = Counter(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, folder).collect() if r["doc_id"] in kept)
    assert ours == expected and any(r[1] for r in ours)


def test_periodic_runs_of_odd_rows(spark, odd, nothing):
    rng = random.Random(8)
    loops = []
    for k in range(40):
        words = []
        for _ in range(4):
            unit = [f"u{rng.randint(0, 5)}" for _ in range(rng.randint(1, 12))]
            words += [f"u{rng.randint(0, 5)}" for _ in range(rng.randint(0, 9))] + unit * rng.randint(1, 30) + unit[:rng.randint(0, len(unit))]
        loops.append((rng.choice([k, 5, None]), "\n ".join(words)))
    long = [(70, "x y z " * 40_000)]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 10_000] + loops
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("c")).repartition(3)
    out = periodic_runs.run_digests(periodic_runs.find_runs(frame))
    assert Counter(tuple(r) for r in out.collect()) == Counter(plain_run_row(i, t) for i, t in rows)
    whole = periodic_runs.find_runs(spark.createDataFrame(long, "doc_id long, text string")).first()
    assert [tuple(r) for r in whole["runs"]] == [(0, 120_000, 3)] and whole["collapsed"] == "x y z"
    assert periodic_runs.run_digests(periodic_runs.find_runs(nothing)).count() == 0


def test_looped_tails(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()] + [(k, f"a{k} b c\td e\nf g h i j k l m") for k in range(-50, 200)]
    out = looped_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, plain_tail(i, t)) for i, t in rows)


# --- collocations

def plain_collocations(rows, size, least, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, size + 1):
                counts[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        inside = {(g[i:i + m], c) for g, c in cand.items() for m in range(2, len(g)) for i in range(len(g) - m + 1)}
        rows = []
        for g, a in cand.items():
            if (g, a) not in inside:
                score, _, left, right = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return Counter(out)


@pytest.mark.parametrize("least,top,share,rows_broadcast", [(3, 15, 1 / 64, 0), (5, 200, 1 / 16, 1 << 20), (2, 40, 1 / 1000, 1 << 20)])
def test_collocations_against_plain_counts(spark, documents, odd, monkeypatch, least, top, share, rows_broadcast):
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", rows_broadcast)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 20_000)
    rng = random.Random(9)
    passages = [" ".join(f"p{rng.randint(0, 300)}" for _ in range(12)) for _ in range(20)]
    extra = [("en", "É; ".join(rng.choice(passages) for _ in range(6)) + " Tail\x0bTAIL tail\ttail") for _ in range(30)]
    extra += [(None, "same words here, same words here! same\r words here")] * 4 + [("und", "same words here")]
    rows = [(r["lang"], r["text"]) for r in documents.collect()] + [(r["lang"], r["text"]) for r in odd.collect()] + extra
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("id", F.lit(1)).withColumn("n", F.lit("n")).withColumn("codes", F.lit(0)).repartition(5)
    out = collocations.mine_collocations(docs, least=least, top=top, share=share)
    assert Counter(tuple(r) for r in out.collect()) == plain_collocations(rows, 5, least, top)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_of_large_counts(spark):
    """Products beyond 64 bits are exact."""
    big = 10**13
    counts = spark.createDataFrame([("x", [1], big + 7), ("x", [2], big + 9), ("x", [1, 2], big)], "lang string, gram array<long>, a long")
    words = spark.createDataFrame([("x", 1, "p", big + 7), ("x", 2, "q", big + 9)], "lang string, id long, word string, f long")
    state = spark.createDataFrame([("x", 99 * big, 2 * big)], "lang string, n long, most long")
    row = collocations._scored(counts, words, state, 100).first()
    assert row["score"] == 1000 * big * 99 * big // ((big + 7) * (big + 9))


def test_collocations_of_an_empty_table(nothing):
    assert collocations.mine_collocations(nothing).count() == 0


def test_looked_up_words_equal_joined_words(spark):
    """Streams keep the same words whether the vocabulary goes to every task or is joined; blocks without any word are left out by both."""
    from pyspark.sql import functions as F

    rows = [("en", "alpha beta, gamma alpha\nrare0 été beta"), ("fr", "beta beta été"), ("xx", "nothing known"), ("en", ""), (None, "alpha")]
    texts = spark.createDataFrame(rows, "lang string, text string").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").coalesce(1)
    streams = collocations._streams(texts)
    entries = streams.select("block", "lang", F.posexplode("words").alias("local", "word"))
    vocabulary = spark.createDataFrame(
        [("en", "alpha", 0, 120), ("en", "été", 1, 300), ("fr", "beta", 2, 100), ("en", "beta", 3, 101)], "lang string, word string, id long, f long"
    )

    def kept(most):
        out = {}
        for r in collocations._frequent_streams(streams, entries, vocabulary, most).collect():
            ids = [*r["ids"], None]
            out[r["block"], r["lang"]] = (sorted(zip(r["ids"], r["f"])), [ids[c] for c in collocations.unpacked(bytes(r["codes"]))])
        return out

    looked_up = kept(10)
    assert looked_up == kept(0)
    assert sorted(lang for _, lang in looked_up) == ["en", "fr"]
    assert [c for lang, (_, c) in sorted((k[1], v) for k, v in looked_up.items()) if lang == "fr"] == [[2, 2, None]]


def test_blocks_take_few_texts_at_a_time(monkeypatch):
    """A large batch is not held as Python objects, and its blocks hold every text once, by language."""
    import numpy as np
    import pyarrow as pa

    taken, plain = [], collocations.text_bytes
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(collocations, "text_bytes", lambda column: taken.append(sum(map(len, plain(column)))) or plain(column))
    texts = [f"word{k % 7} again{k}, " * (k % 9) for k in range(400)]
    langs = [("en", "de", "und")[k % 3] for k in range(400)]
    rows = [b.to_pylist()[0] for b in collocations._coded_blocks(pa.record_batch({"lang": langs, "text": texts}), 5)]
    assert [r["block"] for r in rows] == list(range(5, 5 + len(rows))) and max(taken) < 1000 + max(map(len, texts))
    for lang in set(langs):
        counted = Counter()
        for r in rows:
            if r["lang"] == lang:
                counted.update(dict(zip(r["words"], r["times"])))
                codes = collocations.unpacked(r["codes"])
                assert r["times"] == np.bincount(codes[codes >= 0]).tolist()
        assert counted == Counter(w for t, x in zip(texts, langs) if x == lang for w in t.replace(",", " ").split())


def test_grams_of_a_stream_without_frequent_pairs():
    import numpy as np
    import pyarrow as pa

    stream = pa.table({"lang": ["en"], "ids": [[4, 9]], "f": [[100, 200]], "most": [500], "codes": [collocations.packed(np.array([0, 1, 0, 1, -1]))]})
    none = collocations._grams(stream, pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())}), 5)
    some = collocations._grams(stream, pa.table({"a": [4, 9], "b": [9, 4]}), 5)
    assert none.num_rows == 0 and none.schema == some.schema
    assert sorted(map(str, some.to_pylist())) == sorted(
        str({"lang": "en", "gram": g, "times": 1}) for g in ([4, 9, 4], [9, 4, 9], [4, 9, 4, 9])
    )

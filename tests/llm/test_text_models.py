import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import context_mixing, near_dedup, pieces, quality_classifier, substring_dedup
from pagewright.session import shared_dir


# --- near copies

def plain_sets(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1)))


def plain_classes(rows, width, percent):
    sets = [(i, plain_sets(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=repr)


@pytest.mark.parametrize("width,percent,block", [(3, 85, near_dedup.BLOCK), (5, 80, 2)])
def test_near_classes_against_all_pairs(spark, documents, odd, width, percent, block):
    base = [r["text"] for r in documents.select("text").collect() if r["text"] and len(r["text"].split()) > 40][:25]
    rng = np.random.default_rng(5)
    family = []
    for k, text in enumerate(base):
        words = text.split()
        for copy in range(6):
            own = list(words)
            for at in rng.integers(0, len(own), 1 + copy * len(own) // 150):
                own[at] = f"edit{k}x{copy}x{at}"
            family.append((100_000 + k * 10 + copy, " ".join(own)))
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").union(odd.select("doc_id", "text")).collect()] + family
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = near_dedup.near_classes(frame, width, percent / 100, block).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr) == plain_classes(rows, width, percent)
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in out)


def test_estimates_are_close():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.9):
        a = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
        b = np.r_[a[: int(4000 * 2 * share / (1 + share))], rng.integers(0, 1 << 63, 4000).astype(np.uint64)][:4000]
        x, y = near_dedup.registers(a), near_dedup.registers(b)
        got = near_dedup.estimates(((x == y) & (x > 0)).sum(), ((x > 0) | (y > 0)).sum(), np.array(4000), np.array(4000))
        assert abs(got - share) < 0.13


def test_near_classes_of_an_empty_table(nothing):
    assert near_dedup.near_classes(nothing).count() == 0


def test_rows_without_id_stay(spark):
    """Unique ones stay, of copies without id one stays, and a copy with an id goes before one without."""
    def text(k):
        return " ".join(f"{k}w{i}" for i in range(80))

    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (None, text("c")), (5, text("c")), (6, text("d")), (None, "x"), (None, "x"), (None, ""), (None, "")]
    out = near_dedup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), width=5, similarity=0.8)
    assert out.columns == ["doc_id", "text"]
    assert Counter((r["doc_id"], r["text"][:1]) for r in out.collect()) == {(None, "a"): 1, (None, "b"): 1, (5, "c"): 1, (6, "d"): 1, (None, "x"): 1, (None, ""): 2}


def test_near_rows_sees_groups_that_batches_cut():
    import pyarrow as pa

    marks = near_dedup.narrow(np.arange(1, 257, dtype=np.uint16)).tobytes()
    table = pa.table({"band": [1] * 5 + [2] * 2 + [3] * 2, "low": [0] * 9, "high": [0] * 9, "block": [0] * 9, "rep": list(range(1, 10)),
                      "comp": [1, 1, 3, 4, 5, 6, 7, 8, 8], "n": [100] * 9, "marks": [marks] * 9})
    for size in (1, 2, 3, 9):
        found = [tuple(r.values()) for b in near_dedup._near_rows(table.to_batches(size), 0.85) for r in b.to_pylist()]
        assert sorted(found) == [(1, 1, 1), (2, 1, 1), (3, 3, 1), (4, 4, 1), (5, 5, 1), (6, 6, 6), (7, 7, 6)]


def test_set_links_stay_below_the_rows_of_a_block():
    """Every pair of thirty near copies is over the threshold; one link less than components comes out, whatever the batches."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 62, 200).astype(np.uint64))
    sets = [np.unique(np.r_[base, rng.integers(0, 1 << 62, 4).astype(np.uint64)]) for _ in range(30)]
    sets += [np.unique(np.r_[base[:150], rng.integers(0, 1 << 62, 50).astype(np.uint64)]) for _ in range(30)]
    table = pa.table({"cluster": [1] * 60, "low": [0] * 60, "high": [0] * 60, "rep": list(range(60)), "comp": [0, 0, *range(2, 60)],
                      "shingles": [x.tobytes() for x in sets]})
    for size in (1, 7, 60):
        found = [tuple(r.values()) for b in near_dedup._set_links(table.to_batches(size), 85) for r in b.to_pylist()]
        assert len(found) == 28 and all(u < v < 30 for u, v in found)


def test_set_links_of_several_blocks_name_their_own_rows():
    """Blocks that arrive in one table each link their own two copies, none the rows of the block before."""
    import pyarrow as pa

    sets = [np.arange(1000 * k, 1000 * k + 100, dtype=np.uint64).tobytes() for k in (1, 2, 3)]
    table = pa.table({"cluster": [1, 1, 2, 2, 3, 3], "low": [0] * 6, "high": [0] * 6, "rep": [10, 11, 20, 21, 30, 31], "comp": [10, 11, 20, 21, 30, 31],
                      "shingles": [x for x in sets for _ in range(2)]})
    for size in (1, 3, 6):
        found = [tuple(r.values()) for b in near_dedup._set_links(table.to_batches(size), 85) for r in b.to_pylist()]
        assert sorted(found) == [(10, 11), (20, 21), (30, 31)]


@pytest.mark.parametrize("part", [1 << 17, 7])
def test_components_of_chains_and_stars(spark, monkeypatch, part):
    from pagewright.llm import components

    monkeypatch.setattr(components, "PART_EDGES", part)
    chain, star, loose = [(k, k + 1) for k in range(100, 160)], [(500 + k, 500) for k in range(1, 40)], [(7, 3), (9, 7), (3, 9), (4, 4)]
    out = components.connected_components(spark.createDataFrame(chain + star + loose, "u long, v long")).collect()
    want = [(k, 100) for k in range(101, 161)] + [(500 + k, 500) for k in range(1, 40)] + [(7, 3), (9, 3)]
    assert sorted((r["u"], r["v"]) for r in out) == sorted(want)


def test_families_just_under_the_threshold(spark):
    """Copies that all lie near one another, but under the threshold, stay apart, chunked or not."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(30):
        own = list(words)
        for at in rng.choice(200, 4, replace=False):
            own[at] = f"e{k}x{at}"
        rows.append((k, " ".join(own)))
    rows += [(100 + k, rows[7][1] + f" tail{k}") for k in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (near_dedup.BLOCK, 5):
        out = near_dedup.near_classes(frame, 3, 0.85, block).collect()
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr) == plain_classes(rows, 3, 85)


# --- repeated passages

def plain_passages(rows, window):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s:s + window]), i)
    out = {}
    for i, own in words.items():
        gone = {p for s in range(len(own) - window + 1) if first[tuple(own[s:s + window])] < i for p in range(s, s + window)}
        out[i] = (len(own), len(gone), " ".join(w for p, w in enumerate(own) if p not in gone))
    return out


@pytest.mark.parametrize("window,phrase,shard_words", [(50, 8, 5000), (7, 3, 100_000)])
def test_passages_against_brute_force(spark, documents, window, phrase, shard_words):
    rng = np.random.default_rng(2)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    passage = " ".join(f"p{k}" for k in range(60))
    for k in range(12):
        at = rng.integers(5, 40)
        rows.append((900_000 + k, " ".join(f"own{k}x{j}" for j in range(at)) + "\n" + passage + f" tail{k} " + passage[: 40 + 20 * k]))
    rows += [(950_000, "to " * 300), (950_001, "x " + "to " * 120 + "y"), (950_002, None), (950_003, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = substring_dedup.repeated_passages(frame, window, phrase, shard_words).collect()
    wanted = plain_passages(rows, window)
    assert len(out) == len(rows)
    for r in out:
        n, gone, kept = wanted[r["doc_id"]]
        assert (r["n_words"], r["n_removed"]) == (n, gone)
        if gone:
            assert r["kept_text"] == kept


def test_passages_of_odd_rows(odd, nothing):
    rows = {}
    for r in substring_dedup.repeated_passages(odd).collect():
        rows.setdefault(r["doc_id"], []).append(r["n_removed"])
    assert rows[8] == [30_000] and rows[7] == [0] and rows[3] == [0, 0] and rows[None] == [0]
    assert substring_dedup.repeated_passages(nothing).count() == 0


# --- classifier

def test_classifier_on_held_out_rows(spark, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_classifier.fit_quality_model(documents, labels)
    scored = quality_classifier.score_quality(documents, model)
    judged = scored.join(labels, "doc_id").filter("held_out").select("quality", "predicted").collect()
    assert judged and np.mean([r["quality"] == r["predicted"] for r in judged]) > 0.9


def test_classifier_edges(spark, odd, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (9, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit_quality_model(odd, labels)
    rows = quality_classifier.score_quality(odd, model).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"]: r["held_out"] for r in rows if r["doc_id"]} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(1, 10)}
    assert quality_classifier.score_quality(nothing, model).count() == 0
    none = quality_classifier.fit_quality_model(odd, labels.limit(0))
    assert all(r["predicted"] == 1 for r in quality_classifier.score_quality(odd, none).collect())
    assert quality_classifier.keep_good(odd, none).columns == odd.columns


def test_dual_descent_reaches_the_optimum():
    """No coordinate of the dual can be improved any more."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8)).astype(np.int32) for _ in range(60)]
    good, scale = rng.random(60) < 0.5, np.ones(50)
    w = quality_classifier.dual_descent(rows, scale, good, 0.1, 400)
    x = np.zeros((60, 51))
    for i, r in enumerate(rows):
        x[i, r] = 1 / math.sqrt(len(r))
        x[i, 50] = 1
    y = np.where(good, 1.0, -1.0)
    cost = np.where(good, 0.1 * 60 / (2 * good.sum()), 0.1 * 60 / (2 * (~good).sum()))

    def loss(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()

    assert all(loss(w) <= loss(w + rng.normal(size=51) * s) + 1e-9 for s in (1e-1, 1e-2, 1e-3) for _ in range(50))


# --- language model

def plain_base(rows):
    token_lists = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for i, t in rows}
    training = [i for i in token_lists if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for i in training for w in token_lists[i])
    n, v = sum(counts.values()), len(counts)
    return n, {i: (len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in token_lists.items()}


@pytest.mark.parametrize("head", [10, 1 << 17])
def test_language_model(documents, head):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    n, base = plain_base(rows)
    out = context_mixing.score_texts(documents, head=head).collect()
    for r in out:
        tokens, known, score = base[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(score, rel=1e-9) and r["score"] < 0
    coded = {i: context_mixing.coded_text(t.encode()) for i, t in rows}
    byte_counts = Counter(b for i, t in coded.items() if zlib.crc32(str(i).encode()) % 5 != 1 for b in t)
    total = sum(byte_counts.values())
    held = [r for r in out if r["held_out"]]
    single = sum(math.log10((byte_counts[b] + 0.5) / (total + 128)) for r in held for b in coded[r["doc_id"]])
    assert sum(r["score"] for r in held) > 0.65 * single  # the order-0 model needs over half as much again
    assert all(r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / len(coded[r["doc_id"]])) for r in out)


def test_model_is_a_distribution(documents):
    """After any beginning, the chances of all next bytes sum up to one."""
    model = context_mixing.train_model(documents.select("text"))
    start = int.from_bytes(b"\nthe ", "big")
    grams = (np.uint64(start) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    prefix = np.full(256, context_mixing.byte_grams([b"the x"])[1][0], np.uint64)
    final, bits = model.final_odds(grams, prefix)
    final = final * np.where(bits == 1, 1, -1)
    for sharp in context_mixing.SHARPNESS:
        assert context_mixing.squash(sharp * final).prod(axis=1).sum() == pytest.approx(1, abs=1e-9)


def test_language_model_edges(odd, nothing):
    rows = context_mixing.score_texts(odd).collect()
    assert len(rows) == 11 and all(r["n_tokens"] >= 1 and r["score"] < 0 for r in rows)
    assert context_mixing.score_texts(nothing).count() == 0
    only_held = odd.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    assert all(r["train_tokens"] == 0 for r in context_mixing.score_texts(only_held).collect())


def test_language_model_counts_are_exact(spark):
    """Every predictor has the counts of its own context alone, whatever else the texts hold."""
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcdefgh "), 400)) for _ in range(60)] + ["the cat", "the cap", "", "the cat"]
    rows = spark.createDataFrame([(t, i % 4 == 0, i % 3) for i, t in enumerate(texts)], "text string, held_out boolean, chunk long").repartition(3)
    counted = context_mixing.with_counts(context_mixing._gram_table(rows)[1]).collect()
    grams, words = {k: Counter() for k in context_mixing.ORDERS}, Counter()
    seen = Counter()
    for i, text in enumerate(texts):
        raw, prefix, _ = context_mixing.byte_grams([text.encode()])
        for g, w in zip(raw.tolist(), prefix.view(np.int64).tolist()):
            seen[g, w] += i % 4 != 0
            words[w, g & 255] += i % 4 != 0
            for k in grams:
                grams[k][(g >> 8) & (256**k - 1), g & 255] += i % 4 != 0
    assert context_mixing.ORDERS[0] == 1 and len(counted) == len(seen)
    tables = [{} for _ in context_mixing.ORDERS] + [{}]
    for table, counts in zip(tables, [*grams.values(), words]):
        for (context, byte), n in counts.items():
            table.setdefault(context, []).append((byte, n))
    for r in counted:
        g, byte = r["gram"], r["gram"] & 255
        assert r["n"] == seen[g, r["prefix"]]
        got = np.frombuffer(r["counts"], np.float32).reshape(len(tables), -1)
        contexts = [(g >> 8) & (256**k - 1) for k in context_mixing.ORDERS] + [r["prefix"]]
        for row, table, context in zip(got, tables, contexts):
            beside = [sum(n for b, n in table[context] if b >> (8 - j) == byte >> (8 - j) and b >> (7 - j) != byte >> (7 - j)) for j in range(8)]
            assert row.tolist() == [*beside, sum(n for b, n in table[context] if b == byte)]


def written(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())


def test_language_model_writes_no_counts_per_gram(documents, spark):
    """What is written grows with the texts, not with distinct grams times predictors."""
    before = written(shared_dir(spark))
    context_mixing.score_texts(documents).collect()
    size = sum(len(r["text"] or "") for r in documents.select("text").collect())
    assert written(shared_dir(spark)) - before < 6 * size


def test_language_model_scores_against_counts_of_all_grams(spark, monkeypatch):
    """Costs that come back by word and by open gram, over many chunks, blocks and buckets, add up to those of every byte."""
    rng = np.random.default_rng(6)
    words = ["a", "of", "the", "abcde", "abcdef", "abcdefgh", "https://example.org/a", "https://example.org/b", "Über", "x" * 400]
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(80)] + ["", None, " \t ", "end", "the\x0eabcdefgh the\x0e"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    mixer = context_mixing.Mixer(rng.normal(0.3, 0.2, (context_mixing.GATES, context_mixing.INPUTS + 1)), rng.random((context_mixing.GATES, context_mixing.LEVELS, 2)) * 9)
    for name, value in (("LM_CHUNK", 900), ("SCORE_CHUNK", 2500), ("BLOCK_BYTES", 40), ("BUCKET_GRAMS", 150), ("_averaged", lambda *_: mixer)):
        monkeypatch.setattr(context_mixing, name, value)
    out = {r["doc_id"]: r for r in context_mixing.score_texts(frame).collect()}
    rows = spark.createDataFrame([(t or "", zlib.crc32(str(i).encode()) % 5 == 1, 0) for i, t in enumerate(texts)], "text string, held_out boolean, chunk long")
    counted = {(r["gram"], r["prefix"]): r["counts"] for r in context_mixing.with_counts(context_mixing._gram_table(rows)[1]).collect()}
    n, base = plain_base(list(enumerate(texts)))
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        grams, prefix, _ = context_mixing.byte_grams([(text or "").encode()])
        counts = context_mixing._numbers([counted[key] for key in zip(grams.view(np.int64).tolist(), prefix.view(np.int64).tolist())])
        sums = context_mixing.bit_costs(mixer, counts, grams & np.uint64(0xFF)).astype(float).sum(axis=0)
        assert out[i]["score"] == pytest.approx(sums.max() + math.log10((10 ** (sums - sums.max())).mean()), rel=1e-5)
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (*base[i][:2], n)
        assert out[i]["base_score"] == pytest.approx(base[i][2], rel=1e-9)


# --- pieces

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def plain_viterbi(text, vocabulary):
    """Best total score over the whole text, without cuts or sharing."""
    text = " " + text
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            hit = vocabulary.scores.get(text[start:end])
            if hit:
                best[end] = max(best[end], best[start] + hit[0])
        if best[end] == -math.inf:
            best[end] = best[end - 1] + vocabulary.byte_score * len(text[end - 1].encode())
    return best[-1]


def path_score(ids, vocabulary):
    known = {i: s for s, i in vocabulary.scores.values()}
    return sum(known[i] if i in known else vocabulary.byte_score for i in ids)


def test_pieces_reach_the_best_score(documents, vocabulary):
    texts = [r["text"] for r in documents.select("text").limit(40).collect() if r["text"]]
    texts += ["", " ", "  a  b ", "\n\n x\t", "▁ literal", "é\U0001f600 日本", "a" * 300]
    raw = [t.encode() for t in texts]
    ids, starts = pieces.encode_texts(raw, vocabulary)
    for i, text in enumerate(texts):
        own = ids[starts[i]:starts[i + 1]].tolist()
        assert pieces.decode_ids(own, vocabulary.spelled) == raw[i]
        if text:
            assert path_score(own, vocabulary) == pytest.approx(plain_viterbi(text, vocabulary))


def test_pieces_decode_in_the_library(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    text = "The quick  brown fox.\nÉté, naïve 日本"
    ids, _ = pieces.encode_texts([text.encode()], vocabulary)
    assert model.decode(ids.tolist()) == text


def test_piece_frames(odd, nothing):
    rows = pieces.piece_digests(odd).collect()
    assert len(rows) == 11 and all(r["round_trip"] for r in rows)
    back = pieces.decode_documents(pieces.encode_documents(odd)).select("text", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert pieces.piece_digests(nothing).count() == 0

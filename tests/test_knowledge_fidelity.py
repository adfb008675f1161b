import json
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright import schemas
from pagewright.functions import text
from pagewright.operators import fidelity as D
from pagewright.operators import knowledge as C
from pagewright.sources import tables
from pagewright.sources.cards import read_cards_csv


def test_cards_from_csv(spark, tmp_path):
    deck = tmp_path / "01to08_약치심혈관 카드.csv"
    deck.write_bytes('﻿front,back\r\n"two\r\nlines","say ""hi"""\r\n , \r\nonly,\r\n'.encode())
    rows = read_cards_csv(spark, str(deck))
    assert [(r.front, r.back) for r in rows.orderBy("row").collect()] == [("front", "back"), ("two\r\nlines", 'say "hi"'), ("only", None)]
    named = C.card_attributes(rows.withColumn("filename", F.lit(deck.name)).withColumn("subject_key", F.lit("s")))
    cards = C.clean_cards(named).orderBy("id").collect()
    assert [c.id for c in cards] == ["s-00001", "s-00002"] and (cards[0].chapter, cards[0].chapter_from, cards[0].chapter_to) == ("심혈관", 1, 8)
    assert tuple(C.cards_per_file(rows).first())[1:] == (3, 2)
    plain = spark.createDataFrame([("notes.v2.csv",)], "filename string")
    assert tuple(C.card_attributes(plain).first())[1:] == ("notes.v2", None, None)


@pytest.mark.parametrize("content, want", [
    ('a,b\r\n"x\ry","p\r\nq"\r\n', [(0, "a", "b"), (1, "x\ry", "p\r\nq")]), ('a\r\rb,"c"\r', [(0, "ab", "c")]),
    ('"","""",z\n""""""," "\n', [(0, None, '"'), (1, '""', " ")]), ('x"y,z"w,"a""b""c"\n\n,\nlast', [(0, "xy,zw", 'a"b"c'), (3, "last", None)]),
    ('"open\r\n,end', [(0, "open\r\n,end", None)]), ("", []),
])
def test_quotes_and_line_ends(spark, tmp_path, content, want):
    (tmp_path / "deck.csv").write_bytes(content.encode())
    assert [(r.row, r.front, r.back) for r in read_cards_csv(spark, str(tmp_path)).orderBy("row").collect()] == want


def test_cards_across_blocks(spark, tmp_path):
    """A file cut into many blocks, in the middle of quoted text as well, gives the rows of the whole file."""
    want, out = [], []
    for i in range(400):
        side = [f"f{i}", "a,\r\n" * (i % 5) + 'say "hi"' * (i % 3) + "x" * (i * 7 % 90) + "\n\ny"]
        out.append(",".join('"' + c.replace('"', '""') + '"' for c in side) + "\r\n")
        want.append((len(out) - 1, *side))
        if i % 9 == 4:
            out.append(" , \n")
    (tmp_path / "deck.csv").write_bytes("".join(out).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_cards_csv(spark, str(tmp_path))
        got = [(r.row, r.front, r.back) for r in rows.orderBy("row").collect()]
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want and blocks > 10


def test_many_quotes_take_linear_time(spark, tmp_path):
    """A file of 20,000 rows with doubled quotes took one cut of the whole file for every doubled quote."""
    (tmp_path / "deck.csv").write_text("".join(f'"{i} ""a"" ""b""","c ""d"""\n' for i in range(20_000)))
    start = time.perf_counter()
    rows = read_cards_csv(spark, str(tmp_path)).filter("back = 'c \"d\"' and front = concat(row, ' \"a\" \"b\"')").count()
    assert rows == 20_000 and time.perf_counter() - start < 20


def test_default_layout_and_lookup(spark):
    subjects = C.default_subjects(spark)
    totals = spark.createDataFrame(list(V.SESSION_TOTALS.items()), "session int, want int")
    assert C.assert_layout(subjects, totals, V.GRAND_TOTAL).count() == 0
    assert C.assert_layout(subjects, totals, 351).count() == 1
    asked = spark.createDataFrame([(4, n) for n in (0, 1, 27, 28, 83, 84)], "session int, number int")
    for bucket in (3, 64):
        got = {r.number: r.subject_key for r in C.range_lookup(asked, C.quota_ranges(subjects), bucket).collect()}
        assert got == {0: None, 1: "practice", 27: "practice", 28: "manufacturing", 83: "law", 84: None}


def test_first_last_and_repeats(spark):
    rows = [("a", 1, 1, 0, "x"), ("a", 1, 1, 1, "y"), ("a", 2, 1, 0, "z"), ("b", 1, 2, 0, "w")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "id string, paper int, page int, pos int, v string").repartition(parts)
        order = ["paper", "page", "pos"]
        assert sorted((r.id, r.v) for r in C.first_wins(df, ["id"], order).collect()) == [("a", "x"), ("b", "w")]
        assert sorted((r.id, r.v) for r in C.last_wins(df, ["id"], order).collect()) == [("a", "z"), ("b", "w")]
        assert sorted(r.v for r in C.repeats(df, ["id"], order).collect()) == ["y", "z"]


def test_papers_and_areas(spark):
    df = spark.createDataFrame([("제77회 2교시 전체 문제.pdf",), ("제77회 답안.pdf",)], "filename string")
    good, bad = C.paper_attributes(df)
    assert [(r.exam_round, r.session) for r in good.collect()] == [(77, 2)] and bad.count() == 1
    labels = spark.createDataFrame([("보건 임상",), ("임상 생명",), ("x",)], "l string")
    assert [r[0] for r in labels.select(C.area_of_label(F.col("l"))).collect()] == [4, 1, 0]


def grams(t):
    return {t[i:i + 3] for i in range(len(t) - 2)}


@pytest.mark.parametrize("truth, got, recall, precision", [
    ("", "", 10000, 10000), ("", "abcd", 10000, 0), ("ab", "abc", 10000, 0), ("abcd", "", 0, 0), ("abcd", "abcx", 5000, 5000), ("abc", "ab c", 10000, 10000),
])
def test_overlap_edges(spark, truth, got, recall, precision):
    row = D.fidelity(spark.createDataFrame([(1, truth, got)], "k int, truth string, got string")).first()
    assert (row.recall, row.precision) == (recall, precision)
    row = D.fidelity_exploded(spark.createDataFrame([(1, truth, got)], "k int, truth string, got string"), ["k"]).first()
    assert (row.recall, row.precision) == (recall, precision)


def test_normalisation(spark):
    raw = "A [FIGURE: x y] **b** [UNREADABLE] <br/>|c|　D–e"
    row = spark.createDataFrame([(raw,)], "t string").select(
        text.normalize_text(F.col("t")).alias("n"), text.shingle_source(F.col("t")).alias("s")).first()
    assert row.n == "ab<br/cde" and row.s == "abcde"


def test_character_lists_are_the_classes(spark):
    """Trimming and normalising by character lists does what the patterns of the same classes do, for every character."""
    chars = spark.range(1, 0xFFFF).filter("id not between 55296 and 57343").selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') as c")
    c, noise = F.concat("c", F.lit("x y"), "c", "c"), V.MARKUP_CHARS[:-1] + V.WS + "]+"
    ends = F.regexp_replace(c, f"[{V.WS}]+\\z", "")
    pairs = [(text.rtrim(c), ends), (text.trim(c), F.regexp_replace(ends, f"^[{V.WS}]+", "")), (text.normalize_text(c), F.lower(F.regexp_replace(c, noise, "")))]
    for ours, pattern in pairs:
        assert chars.filter(~ours.eqNullSafe(pattern)).count() == 0
    assert chars.filter(text.trim(F.col("c")) == "").count() == len(text.WS_CHARS)


def test_front_matter_of_many_lines(spark):
    """Every line used to be parsed again for every other line."""
    head = "\n".join(f"k{i % 3900}: v{i} " for i in range(4000))
    start = time.perf_counter()
    found = spark.createDataFrame([(head,)], "h string").select(text.front_matter_map(F.col("h")).alias("m")).first().m
    assert len(found) == 3900 and found["k7"] == "v7" and time.perf_counter() - start < 15


def levenshtein(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_edit_distance_of_long_texts(spark):
    """Near copies of 100,000 characters that differ at both ends take a narrow band, not the whole matrix."""
    rng = random.Random(7)
    body = "".join(rng.choice("abcdefgh ") for _ in range(100_000)).replace("  ", " x")
    rows = [(1, "q" + body + "q", "zz" + body[:50_000] + "k" + body[50_000:] + "z"), (2, body[:3000], body[3000:5000]), (3, body[:40], "q" * 40)]
    start = time.perf_counter()
    out = {r.k: r.distance for r in D.edit_distance(spark.createDataFrame(rows, "k int, truth string, got string")).collect()}
    assert out[1] == 4 and out[3] == 40 and time.perf_counter() - start < 20
    sides = spark.createDataFrame(rows[1:2], "k int, a string, b string").select(*[text.normalize_text(F.col(c)).alias(c) for c in "ab"])
    assert out[2] == sides.selectExpr("levenshtein(a, b)").first()[0]


def test_bands_against_the_whole_matrix(spark, monkeypatch):
    monkeypatch.setattr(D, "FIRST_BAND", 1)
    rng = random.Random(3)
    pairs = [("".join(rng.choice("abé") for _ in range(rng.randrange(30))), "".join(rng.choice("ab\U0001f600") for _ in range(rng.randrange(30)))) for _ in range(300)]
    pairs += [(a, a[:5] + "z" + a[7:]) for a, _ in pairs] + [("", ""), (None, "a")]
    frame = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", "levenshtein(a, b) as d").toPandas()
    got = D._banded_distance(frame["a"].where(frame["a"].notna(), None), frame["b"]).tolist()
    assert [None if g is pd.NA else g for g in got] == [None if d != d else int(d) for d in frame["d"].tolist()]


def test_edit_distance_against_brute_force(spark):
    rng = random.Random(3)
    letters = "abé폐"
    rows = []
    for k in range(150):
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        b = list(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(3)] = rng.choice(letters) * rng.randrange(3)
        rows.append((k, a, "".join(b)))
    df = spark.createDataFrame(rows, "k int, truth string, got string")
    out = {r.k: r for r in D.edit_distance(df).collect()}
    near = {r.k: r.distance for r in D.edit_distance(df, threshold=2).collect()}
    for k, a, b in rows:
        want = levenshtein(a, b)
        assert out[k].distance == want and out[k].truth_len == len(a)
        assert near[k] == (want if want <= 2 else -1)


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 37])
def test_order_stats(spark, n):
    values = [random.Random(n).randrange(5) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "m int")
    got = {r.stat: r.value for r in D.order_stats(df, ["m"], {"median": D.UPPER_MEDIAN, "p10": D.FLOOR_P10}).collect()}
    assert got == {"median": sorted(values)[n // 2], "p10": sorted(values)[n // 10]}


def test_round_robin_matches_the_loop(spark):
    docs = [(f"d{i}", p) for i, p in enumerate([1, 3, 8, 14, 0])]
    usable = [d for d in docs if d[1] > 0]
    want, i = [], 0
    while len(want) < 9 and i < len(usable) * 5:
        path, pages = usable[i % len(usable)]
        pick = (path, ((i // len(usable)) * 7 + 1) % pages + 1)
        if pick not in want:
            want.append(pick)
        i += 1
    frame = spark.createDataFrame(docs, "path string, pages int")
    assert [(r.path, r.page) for r in D.round_robin_sample(frame, 9).orderBy("place").collect()] == want


def test_recall_gate_compares_before_rounding(spark):
    df = spark.createDataFrame([(16999, 20000, 200)] * 3 + [(17000, 20000, 200)], "hits long, truth_tokens long, truth_len int")
    row = D.recall_gate(df.limit(3)).first()
    assert (row.usable, row.low_rows, row.median_recall, row.passed) == (3, 3, 8500.0, False)
    assert D.recall_gate(df.filter("hits = 17000")).first().passed and D.low_recall_rows(df).count() == 3


def test_extractions_from_json_lines_to_questions(spark, tmp_path):
    item = lambda n, stem: {"number": n, "stem": stem, "options": [{"n": i, "text": "o"} for i in range(1, 6)], "figure_withheld": False}
    pages = [
        {"sha": "p", "exam_round": 77, "session": 4, "page": 1, "page_questions": [item(1, "first"), item(28, "kept")]},
        {"sha": "p", "exam_round": 77, "session": 4, "page": 2, "page_questions": [item(28, "again"), item(99, "outside")]},
        {"sha": "p", "exam_round": 77, "session": 4, "page": 3, "page_questions": []},
    ]
    answers = [{"sha": "k", "exam_round": 77, "page": p, "answers": [{"session": 4, "number": 28, "answer": a, "area_label": "임상·실무약학"}]} for p, a in ((1, 2), (2, 5))]
    for name, rows in (("q", pages), ("a", answers)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    questions = tables.read_jsonl(spark, str(tmp_path / "q.jsonl"), schemas.QUESTION_PAGE)
    keys = tables.read_jsonl(spark, str(tmp_path / "a.jsonl"), schemas.ANSWER_PAGE)
    key = F.concat_ws("-", "exam_round", "session", "number")
    items = C.explode_items(questions, "page_questions").withColumn("id", key)
    first = C.first_wins(items, ["id"], ["sha", "page", "pos"])
    last = C.last_wins(C.explode_items(keys, "answers").withColumn("id", key), ["id"], ["sha", "page", "pos"])
    joined = C.join_answers(C.round_year(C.range_lookup(first, C.quota_ranges(C.default_subjects(spark))), C.default_rounds(spark)), last)
    got = {r.number: (r.stem, r.subject_key, r.exam_year, r.answer) for r in joined.collect()}
    assert got == {1: ("first", "practice", 2026, None), 28: ("kept", "manufacturing", 2026, 5), 99: ("outside", None, 2026, None)}
    gates = C.record_gates(joined).first()
    assert (gates["items"], gates.bad_options, gates.no_answer, gates.no_subject, gates.repeated_ids) == (3, 0, 2, 1, 0)
    assert tables.read_jsonl(spark, str(tmp_path / "none.jsonl"), schemas.QUESTION_PAGE).count() == 0


def test_guides_merge_in_document_order(spark):
    unit = {"unit": "u", "rank": 1, "note": None}
    docs = [("law", 2, ["b"], [], ["n"]), ("law", 1, ["a", "c"], [unit], []), ("social", 3, [], [unit], [])]
    df = spark.createDataFrame(docs, "subject_key string, ord int, study_order array<string>, unit_priority array<struct<unit:string,rank:int,note:string>>, notes array<string>")
    more = spark.createDataFrame([("law", 3, [], [], []), ("unlisted", 1, ["z"], [], []), ("practice", 1, [], [], [])], df.schema)
    df = df.unionByName(more).withColumn("sha", F.concat(F.lit("h"), "ord"))
    lists = ["study_order", "unit_priority", "notes"]
    entries = C.merge_by_subject(df, "subject_key", ["ord"], lists, C.default_subjects(spark), ("sha",))
    law = sorted((r.place, r.entry) for r in entries.filter("subject_key = 'law' and kind = 'study_order'").collect())
    assert law == [(0, "a"), (1, "c"), (2, "b")]
    gates = {r.subject_key: r for r in C.guide_gates(entries, C.default_subjects(spark)).collect()}
    assert gates["social"].no_content and not gates["law"].no_ranks and gates["physical"].missing
    assert gates["practice"].no_content and not gates["practice"].missing
    sources = sorted((r.place, r.entry) for r in entries.filter("subject_key = 'law' and kind = 'sources'").collect())
    assert sources == [(0, '{"sha":"h1"}'), (1, '{"sha":"h2"}'), (2, '{"sha":"h3"}')]
    heads = C.guide_heads(entries, [*lists, "sources"]).collect()
    assert [(r.subject_key, r.subject_order, r.area, r.session, r.n_study_order, r.n_sources) for r in heads] == [
        ("practice", 11, 3, 4, 0, 1), ("social", 13, 3, 4, 0, 1), ("law", 14, 4, 4, 3, 3),
    ]


def test_collation_is_an_option(spark):
    df = spark.createDataFrame([("b",), ("A",), ("a",), ("é",), ("f",)], "v string")
    assert [r.v for r in df.orderBy("v").collect()] == ["A", "a", "b", "f", "é"]
    assert [r.v for r in df.orderBy(text.collated(F.col("v"))).collect()] == ["a", "A", "b", "é", "f"]


def test_equal_texts_with_break_tags(spark):
    rows = [(1, "ab<br>cd", "ab<br>cd"), (2, "ab<br/>cd", "abcd"), (3, "abcd", "ab<BR >cd")]
    got = D.fidelity(spark.createDataFrame(rows, "k int, truth string, got string")).collect()
    assert [(r.truth_tokens, r.got_tokens, r.hits, r.recall) for r in got] == [(2, 2, 2, 10000)] * 3
    assert [(r.truth_len, r.got_len) for r in got] == [(7, 7), (8, 4), (4, 7)]

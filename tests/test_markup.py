import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import markup
from pagewright.operators import markup as E


def strip(spark, body):
    return spark.createDataFrame([(body,)], "b string").select(markup.strip_marks(F.col("b"))).first()[0]


@pytest.mark.parametrize("body, want", [
    ("<mark>**key**</mark> x", "key x"), ("**open x", "**open x"), ("**a\nb**", "**a\nb**"), ("[A] ======== [B]", "[A] ======== [B]"),
    ("<u>a\nb</u>", "a\nb"), ("<mark>x", "<mark>x"), ("****", "****"), ("<u><mark><u>q</u></mark></u>", "q"), ("a*b*c", "a*b*c"), ("price $1", "price $1"),
])
def test_strip(spark, body, want):
    assert strip(spark, body) == want


def test_counts_and_aliases(spark):
    row = spark.createDataFrame([("**a** **b** <u>c</u> <mark>d\n</mark> **", " RED ", "zz")], "b string, t string, u string").select(
        markup.count_marks(F.col("b")).alias("c"), markup.mark_type(F.col("t")).alias("t"), markup.mark_type(F.col("u")).alias("u")).first()
    assert tuple(row.c) == (2, 1, 1) and row.t == "color" and row.u is None


# --- brute force -------------------------------------------------------------


def without_marks(body):
    """Markers go in rounds, highlights first, with the patterns of the fixed values."""
    for _ in range(V.STRIP_ROUNDS):
        for pattern in (V.HL_MARK, V.UNDERLINE_MARK, V.COLOR_MARK):
            body = re.sub(pattern, r"\1", body)
    return body


def ruled_places(body, marks):
    """Status per mark and the marked body of one page, from the rule: a span is the set of places it covers; two spans cross
    when they share places and neither holds the other."""
    lines = without_marks(body).split("\n")
    status, spans = {}, {}
    for i, (line, words, kind) in enumerate(marks):
        holding = {n for n, own in enumerate(lines, 1) if words in own}
        asked = [line + d for d in V.LINE_OFFSETS if line + d in holding]
        if not words.strip() or "\n" in words:
            status[i] = "line break in text" if words.strip() else "empty text"
        elif asked:
            begin = lines[asked[0] - 1].find(words)
            spans[i] = (asked[0], frozenset(range(begin, begin + len(words))), V.MARK_ALIASES.get(kind.lower().strip(), "color"))
        else:
            status[i] = f"on line {min(holding)} instead" if holding else "not in the text"
    accepted = set()
    for i in sorted(spans, key=lambda i: (-len(spans[i][1]), i)):
        hit, places, kind = spans[i]
        others = [p for n, p, _ in accepted if n == hit]
        if any(p & places and not p <= places and not places <= p for p in others):
            status[i] = "partly overlaps another mark"
        else:
            status[i] = "duplicate" if spans[i] in accepted else "applied"
            accepted.add(spans[i])
    rank = list(E._NESTING)
    for number in {n for n, _, _ in accepted}:
        own = [(p, k) for n, p, k in accepted if n == number]
        out = ""
        for place in range(len(lines[number - 1]) + 1):
            closing = sorted((m for m in own if max(m[0]) + 1 == place), key=lambda m: (len(m[0]), -rank.index(m[1])))
            opening = sorted((m for m in own if min(m[0]) == place), key=lambda m: (-len(m[0]), rank.index(m[1])))
            out += "".join(V.MARKERS[k][1] for _, k in closing) + "".join(V.MARKERS[k][0] for _, k in opening)
            out += lines[number - 1][place:place + 1]
        lines[number - 1] = out
    return status, "\n".join(lines) if accepted else None


def random_pages(seed, n=60):
    rng = random.Random(seed)
    words = ["ab", "abc", "폐렴", "x", "bc d", "é", "cd"]
    for page in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 6))]
        body = "\n".join(f"**{t}**" if rng.random() < 0.2 else t for t in lines)
        marks = []
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(lines))
            s = rng.randrange(len(lines[at]))
            text = lines[at][s:s + rng.randrange(1, 8)]
            text = rng.choice([text] * 9 + ["nowhere", "", "a\nb"])
            marks.append((at + 1 + rng.choice([0, 0, 0, 1, -1, 2, -2, 3]), text, rng.choice(["red", "hl", "underline", "other", "H"])))
        yield page, body, marks


@pytest.mark.parametrize("seed", [1, 2])
def test_placing_against_brute_force(spark, seed):
    pages = list(random_pages(seed))
    frame = spark.createDataFrame([("s", p, body) for p, body, _ in pages], "sha string, page int, body string")
    marks = spark.createDataFrame(
        [("s", p, i, *m) for p, _, rows in pages for i, m in enumerate(rows)],
        "sha string, page int, seq int, line int, text string, type string",
    )
    resolved = E.resolve_overlaps(E.locate_marks(marks, frame))
    status = {(r.page, r.seq): r.status for r in resolved.collect()}
    applied = {r.page: r for r in E.apply_marks(frame, resolved).collect()}
    seen = set()
    for page, body, rows in pages:
        want, text = ruled_places(body, rows)
        seen |= set(want.values())
        assert {i: status[page, i] for i in want} == want
        assert applied[page].new_body == (body if text is None else text)
    assert {"applied", "duplicate", "partly overlaps another mark", "not in the text"} <= seen


def test_very_many_marks_on_one_page(spark):
    """100,000 marks on one page: found, lost and overlapping ones; the page's text does not travel with them."""
    lines = [f"line {n} " + "abcdefghij" * 20 for n in range(400)]
    frame = spark.createDataFrame([("s", 1, "\n".join(lines))], "sha string, page int, body string")
    place = F.pmod(F.xxhash64("id"), F.lit(400)).cast("int")
    words = F.when(F.col("id") % 10 == 0, F.concat(F.lit("lost "), F.col("id") % 5000)).when(F.col("id") % 10 == 1, F.concat(F.lit("line "), (place + 200) % 400, F.lit(" abc")))
    marks = spark.range(100_000).repartition(8).select(
        F.lit("s").alias("sha"), F.lit(1).alias("page"), F.col("id").cast("int").alias("seq"), (place + 1).alias("line"),
        F.coalesce(words, F.concat(F.lit("line "), place, F.lit(" "), F.expr("substr('abcdefghijabcdefghij', 1, cast(id % 17 as int) + 2)"))).alias("text"), F.lit("hl").alias("type"),
    )
    located = E.locate_marks(marks, frame)
    assert "_lines" not in located._jdf.queryExecution().optimizedPlan().toString()
    got = {r.status.split(" ")[0]: r["count"] for r in E.resolve_overlaps(located).groupBy(F.split("status", " ")[0].alias("status")).count().collect()}
    assert got["not"] == 10_000 and got["on"] == 10_000 and sum(got.values()) == 100_000 and 400 * 16 <= got["applied"] <= 400 * 17


def test_ten_thousand_spans_on_one_line(spark):
    rng = random.Random(5)
    spans = {(s, s + rng.choice([1, 2, 3, 5, 8, 40, 200])) for s in (rng.randrange(5000) for _ in range(12_000))}
    rows = [("s", 1, i, 1, s, e, "hl", None) for i, (s, e) in enumerate(sorted(spans, key=lambda x: hash(x)))]
    located = spark.createDataFrame(rows, "sha string, page int, seq int, hit_line int, start int, stop int, mark_type string, why string")
    status = {r.seq: r.status for r in E.resolve_overlaps(located).collect()}
    kept, cover = [], {}
    for _, _, i, _, s, e, _, _ in sorted(rows, key=lambda r: (r[4] - r[5], r[2])):
        # A place knows the accepted spans over it, longest first; a span is accepted if all its places know the same spans as its neighbours inside.
        over = [cover.get(p, frozenset()) for p in range(s, e)]
        common = frozenset.intersection(*over)
        crossing = any(o != common for o in over)
        assert status[i] == ("partly overlaps another mark" if crossing else "applied")
        if not crossing:
            kept.append(i)
            for p in range(s, e):
                cover[p] = cover.get(p, frozenset()) | {i}
    assert 1000 < len(kept) < len(rows)


def one_line(spark, line, marks):
    frame = spark.createDataFrame([("s", 1, line)], "sha string, page int, body string")
    rows = spark.createDataFrame([("s", 1, i, 1, t, k) for i, (t, k) in enumerate(marks)],
                                 "sha string, page int, seq int, line int, text string, type string")
    return E.apply_marks(frame, E.resolve_overlaps(E.locate_marks(rows, frame))).first()


def test_documented_nesting(spark):
    row = one_line(spark, "핵심 말", [("핵심", "color"), ("핵심", "hl")])
    assert row.new_body == "<mark>**핵심**</mark> 말" and row.intact and row.n_marks == 2
    assert one_line(spark, "abcd", [("abcd", "hl"), ("c", "color")]).new_body == "<mark>ab**c**d</mark>"
    assert one_line(spark, "abcd", [("cd", "u"), ("abcd", "hl")]).new_body == "<mark>ab<u>cd</u></mark>"


def test_applying_twice_changes_nothing(spark):
    first = one_line(spark, "abc def", [("abc", "hl"), ("b", "u")]).new_body
    assert one_line(spark, first, [("abc", "hl"), ("b", "u")]).new_body == first


def test_none_heavy_bounds(spark):
    rows = [("a", i < 3) for i in range(10)] + [("b", i < 2) for i in range(4)] + [("c", i < 31) for i in range(100)]
    state = spark.createDataFrame(rows, "sha string, marked boolean").withColumn("none", ~F.col("marked"))
    assert [(r.sha, r.none, r.reviewed) for r in E.none_heavy_docs(state).collect()] == [("a", 7, 10)]


def test_baseline_diff(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z")], "sha string, page int, fp string")
    new = spark.createDataFrame([("a", 1, "x"), ("a", 2, "Y"), ("a", 4, "w")], "sha string, page int, fp string")
    assert sorted((r.page, r.status) for r in E.baseline_diff(old, new).collect()) == [(2, "changed"), (3, "removed"), (4, "added")]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 50])
def test_centre_sample(spark, n):
    pages = list(range(10, 10 + 2 * n, 2))
    want = pages if n <= 3 else sorted({pages[int((i + .5) / 3 * n)] for i in range(3)})
    df = spark.createDataFrame([("d", p) for p in pages], "sha string, page int").repartition(3)
    assert sorted(r.page for r in E.centre_sample(df).collect()) == want


def test_none_heavy_share_is_exact(spark):
    rows = [("a", i < 2, i >= 2) for i in range(8)] + [("b", i < 7, i >= 7) for i in range(25)]
    state = spark.createDataFrame(rows, "sha string, marked boolean, none boolean")
    assert [r.sha for r in E.none_heavy_docs(state, reviewed=5, share=0.75).collect()] == ["a"]
    assert sorted(r.sha for r in E.none_heavy_docs(state, reviewed=5, share=0.72).collect()) == ["a", "b"]
    assert [r.sha for r in E.none_heavy_docs(state, reviewed=5, share=0.74).collect()] == ["a"]


def test_instructions_as_people_write_them(spark):
    raw = ['{"page":"10","marks":[{"line":"6","text":"x","type":"hl"}]}', '{"page":10,"marks":{}}', '{"page":"ten"}', '{"marks":"none","clear":1}',
           '{"clear":false,"none":"why"}', '{"page":10', '{"page":10.0,"marks":[{"line":"six","text":"y"}]}']
    out = E.parse_instructions(spark.createDataFrame([(r,) for r in raw], "raw string")).collect()
    assert [r.bad_json for r in out] == [False] * 5 + [True, False]
    assert [r.rec and r.rec.page for r in out] == [10, 10, -1, None, None, None, 10]
    assert out[0].rec.marks[0].line == 6 and out[1].rec.marks is None and out[3].rec.marks is None and out[6].rec.marks[0].line is None
    assert [bool(r.rec and r.rec.clear) for r in out] == [False, False, False, True, False, False, False]

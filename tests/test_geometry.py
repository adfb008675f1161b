import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagewright.functions import imaging
from pagewright.operators import geometry as X
from pagewright.operators.components import smallest_members


def flood(cells):
    left, out = set(cells), []
    while left:
        stack, group = [left.pop()], []
        while stack:
            x, y = stack.pop()
            group.append((x, y))
            for near in [(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if near in left:
                    left.remove(near)
                    stack.append(near)
        out.append(frozenset(group))
    return set(out)


@pytest.mark.parametrize("tile", [3, 256])
def test_components_do_not_depend_on_tiles(spark, tile):
    rng = random.Random(5)
    pages = {p: {(rng.randrange(14), rng.randrange(14)) for _ in range(70)} for p in range(4)}
    rows = [(p, x, y, 9) for p, cells in pages.items() for x, y in cells] + [(0, 50, 50, 1)]
    df = spark.createDataFrame(rows, "page int, cx int, cy int, ink int")
    groups = {}
    for r in X.label_components(df, "ink", 6, tile=tile).collect():
        groups.setdefault((r.page, r.component), set()).add((r.cx, r.cy))
    for p, cells in pages.items():
        assert {frozenset(g) for (q, _), g in groups.items() if q == p} == flood(cells)


def test_labels_of_dense_and_winding_tiles():
    """Spirals, combs, full and random tiles, many at once, against a flood fill."""
    rng = random.Random(2)
    spiral, (x, y), (dx, dy) = {(0, 0)}, (0, 0), (1, 0)
    for turn in range(1, 40):
        for _ in range(2 * (turn // 2 + turn % 2)):
            x, y = x + dx, y + dy
            spiral.add((x + 60, y + 60))
        dx, dy = -dy, dx
    shapes = [spiral, {(x, y) for x in range(0, 40, 2) for y in range(30)} | {(x, 30) for x in range(40)}, {(x, y) for x in range(30) for y in range(30)}, {(7, 9)}]
    shapes += [{(rng.randrange(40), rng.randrange(40)) for _ in range(k)} for k in (5, 300, 700, 1200)]
    shift = 1 << 30
    tiles = [sorted(((y + shift) << 32) + x + shift for x, y in cells) for cells in shapes]
    out = X._labels_of_tiles(pd.Series([np.array(t) for t in tiles]))
    for cells, ids, labels in zip(shapes, tiles, out, strict=True):
        groups = {}
        for cell, label in zip(ids, labels.tolist(), strict=True):
            groups.setdefault(label, set()).add(((cell & 0xFFFFFFFF) - shift, (cell >> 32) - shift))
        assert {frozenset(g) for g in groups.values()} == flood(cells)
        assert all(label == min(((y + shift) << 32) + x + shift for x, y in g) for label, g in groups.items())


def test_members_of_chains_and_stars(spark):
    """Chains (the worst case for hooking), stars, loops, and labels that recur under another key."""
    pairs = [(1, k, k + 1) for k in range(200)] + [(1, 1000, k) for k in range(1001, 1100)] + [(2, 5, 5), (2, 7, 6), (2, 6, 7), (2, 9, 3), (2, 9, 8)]
    out = {(r.page, r.label): r.merged for r in smallest_members(spark.createDataFrame(pairs, "page int, a long, b long"), ["page"]).collect()}
    want = {(1, k): 0 for k in range(201)} | {(1, k): 1000 for k in range(1000, 1100)} | {(2, 6): 6, (2, 7): 6, (2, 9): 3, (2, 8): 3, (2, 3): 3}
    assert out == want
    assert smallest_members(spark.createDataFrame([], "page int, a long, b long"), ["page"]).count() == 0


def test_rules_with_words_above(spark):
    """Rules of several lengths and places under rows of marks, against a pixel-by-pixel test."""
    rng = random.Random(11)
    dark = {}
    for page in range(6):
        own = dark.setdefault(page, set())
        for _ in range(8):
            x, y, size, thick = rng.randrange(0, 200), rng.randrange(0, 120), rng.choice([44, 45, 60, 130, 181]), rng.choice([1, 2, 4, 5])
            own |= {(x + i, y + j) for i in range(size) for j in range(thick)}
            for row in rng.sample(range(4, 35), rng.choice([7, 8, 20])):
                own |= {(x + rng.randrange(size), y - row) for _ in range(rng.choice([1, 3]))}
    rows = [(p, x, y, 0, 0, 0) for p, own in dark.items() for x, y in own if 0 <= y < 150 and x < 300]
    dark = {p: {(x, y) for q, x, y, *_ in rows if q == p} for p in dark}
    want = set()
    for p, own in dark.items():
        for x, y in own:
            size = next(n for n in range(1, 400) if (x + n, y) not in own)
            mid = x + size // 2
            if (x - 1, y) in own or not (2 <= y < 144 and 45 <= size <= 180) or (mid, y - 1) in own or all((mid, y + d) in own for d in (1, 2, 3, 4)):
                continue
            if sum(any((i, y - d) in own for i in range(x, x + size, 3)) for d in range(4, 35) if y >= d) >= 8:
                want.add((p, x, y, size))
    sizes = spark.createDataFrame([(p, 300, 150) for p in dark], "page int, width int, height int")
    got = X.underline_hints(spark.createDataFrame(rows, "page int, x int, y int, r int, g int, b int"), sizes)
    assert {(r.page, r.x, r.y, r.len) for r in got.collect()} == want and len(want) > 3


@pytest.mark.parametrize("rgb, kind", [
    ((109, 0, 0), "dark"), ((110, 110, 110), "none"), ((199, 100, 100), "ink"), ((200, 91, 91), "hl"), ((200, 90, 200), "none"), ((200, 145, 145), "none"),
])
def test_pixel_class(spark, rgb, kind):
    df = spark.createDataFrame([rgb], "r int, g int, b int")
    assert df.select(imaging.pixel_class(F.col("r"), F.col("g"), F.col("b"))).first()[0] == kind


@pytest.mark.parametrize("rgb, hue", [
    ((100, 90, 80), "gray"), ((200, 20, 20), "red"), ((200, 150, 20), "orange"), ((200, 20, 120), "pink"), ((20, 200, 20), "green"),
    ((120, 20, 200), "purple"), ((20, 20, 200), "blue"),
])
def test_hue(spark, rgb, hue):
    df = spark.createDataFrame([rgb], "r int, g int, b int")
    assert df.select(imaging.hue_name(F.col("r"), F.col("g"), F.col("b"))).first()[0] == hue


@pytest.mark.parametrize("w, h, px, want", [
    (100, 9, 60, False), (100, 10, 60, True), (100, 64, 60, True), (100, 65, 60, False), (100, 20, 59, False), (12, 20, 60, True), (11, 20, 60, False),
])
def test_text_shape(spark, w, h, px, want):
    df = spark.createDataFrame([(w, h, px)], "w int, h int, px int")
    assert df.select(imaging.text_shaped(F.col("w"), F.col("h"), F.col("px"))).first()[0] is want


def test_levels_and_pages_without_boxes(spark):
    box = "page int, x int, y int, w int, h int, px int"
    ink = spark.createDataFrame([(1, 0, 0, 40, 16, 90)] * 3 + [(2, 0, 0, 40, 16, 90)], box)
    hl = spark.createDataFrame([(3, 0, 0, 40, 16, 90)] * 2, box)
    pages = spark.createDataFrame([(p,) for p in (1, 2, 3, 4)], "page int")
    assert {r.page: r.level for r in X.page_levels(pages, ink, hl).collect()} == {1: "strong", 2: "weak", 3: "strong", 4: "none"}


def words(doc, n, tall, ys):
    return [(doc, 1, i + 1, 3, 10, 20 if i < tall else 5, ys(i)) for i in range(n)]


@pytest.mark.parametrize("stretch", [4, 4096])
def test_page_rotation(spark, stretch):
    rows = (
        words(1, 14, 14, lambda i: i * 9) + words(2, 15, 15, lambda i: i * 9) + words(3, 15, 15, lambda i: -i * 9)
        + words(4, 100, 69, lambda i: i * 9) + words(5, 100, 70, lambda i: i * 9) + words(6, 21, 21, lambda i: i % 2 * 9) + words(7, 20, 20, lambda i: -i * 0.5)
    )
    df = spark.createDataFrame(
        [(*r[:6], float(r[6])) for r in rows], "doc_id int, page int, seq int, n_chars int, w int, h int, y double")
    got = {r.doc_id: r.degrees for r in X.page_rotation(df, stretch=stretch).collect()}
    assert got == {1: 0, 2: 270, 3: 90, 4: 0, 5: 270, 6: 270, 7: 270}


def test_doc_rotation_majority_and_tie(spark):
    docs = spark.createDataFrame([(1, 3), (2, 2), (3, 1)], "doc_id int, pages int")
    turns = spark.createDataFrame([(1, 1, 0), (1, 2, 90), (1, 3, 90), (2, 1, 270), (2, 2, 0)], "doc_id int, page int, degrees int")
    assert {r.doc_id: r.degrees for r in X.doc_rotation(docs, turns).collect()} == {1: 90, 2: 270, 3: 0}


def underlines(px, w, h):
    """The scan of a whole page, pixel by pixel."""
    dark = lambda x, y: (x, y) in px
    found = []
    for y in range(2, h - 6):
        x = 0
        while x < w:
            if not dark(x, y):
                x += 1
                continue
            e = x
            while e < w and dark(e, y):
                e += 1
            mid = x + (e - x) // 2
            below = next((d for d in range(1, 6) if not dark(mid, y + d)), 6)
            if 45 <= e - x <= int(w * 0.6 + 0.5) and not dark(mid, y - 1) and below <= 4:
                above = sum(any(dark(c, y - d) for c in range(x, e, 3)) for d in range(4, 35) if y - d >= 0)
                if above >= 8:
                    found.append((x, y, e - x))
            x = e
    return sorted(found)


def test_underlines_against_scan(spark):
    rng = random.Random(9)
    w, h = 130, 90
    px = set()
    for top in (40, 60, 78, 85):
        x0, length, thick = rng.randrange(5, 30), rng.choice([44, 45, 60, 78, 79]), rng.choice([1, 2, 4, 5])
        px |= {(x, y) for x in range(x0, x0 + length) for y in range(top, top + thick)}
    px |= {(rng.randrange(w), rng.randrange(0, 36)) for _ in range(500)}
    px |= {(x, 50) for x in range(20, 80)} | {(x, 3) for x in range(0, 60)}
    df = spark.createDataFrame([(1, x, y, 0, 0, 0) for x, y in px], "page int, x int, y int, r int, g int, b int")
    sizes = spark.createDataFrame([(1, w, h)], "page int, width int, height int")
    got = sorted((r.x, r.y, r.len) for r in X.underline_hints(df, sizes).collect())
    assert got == underlines(px, w, h) and got


def test_turning_back_and_forth(spark):
    df = spark.createDataFrame([(1, x, y, x, y, 0) for x in range(3) for y in range(2)], "page int, x int, y int, r int, g int, b int")
    wide, high = (spark.createDataFrame([(1, *s)], "page int, width int, height int") for s in ((3, 2), (2, 3)))
    once = X.rotate_coords(df, wide, 90)
    assert {(r.x, r.y) for r in once.collect()} == {(x, y) for x in range(2) for y in range(3)}
    back = X.rotate_coords(once, high, -90)
    assert sorted(map(tuple, back.select("x", "y", "r", "g").collect())) == sorted((x, y, x, y) for x in range(3) for y in range(2))


def test_hues_over_the_largest_boxes(spark):
    rows = [(1, i, 0, 8, 8, 100 - i, "red" if i % 2 else "blue") for i in range(50)]
    totals = X.hue_totals(spark.createDataFrame(rows, "page int, x int, y int, w int, h int, px int, hue string"))
    assert X.hue_map(totals).first().hues == {"blue": sum(range(100, 60, -2)), "red": sum(range(99, 60, -2))}

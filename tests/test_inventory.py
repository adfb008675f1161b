
import pytest
from pyspark.sql import functions as F

from pagewright.functions import paths, text
from pagewright.operators import inventory as A
from pagewright.operators.knowledge import default_subjects
from pagewright.sources.files import scan_assets


def test_scan_lists_files_below_a_folder(spark, tmp_path):
    for name in ("a.pdf", "x/b.CSV", "x/y/c.txt", "node_modules/d.js", "x/desktop.ini"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(name.encode() * 3)
    listed = scan_assets(spark, str(tmp_path))
    assert {r.path: r.size_bytes for r in A.skip_assets(listed).collect()} == {"a.pdf": 15, "x/b.CSV": 21, "x/y/c.txt": 27}
    assert "content" not in listed.columns
    full = scan_assets(spark, str(tmp_path), content=True).select("path", A.content_hash(F.col("content")).alias("h"))
    assert len({r.h for r in full.collect()}) == 5


def test_path_fields(spark):
    df = spark.createDataFrame([("1-1. 생화학/교재/a.PDF",), ("other/b.txt",), ("c",)], "path string")
    got = {r.path: r for r in A.path_fields(df, default_subjects(spark)).collect()}
    assert got["1-1. 생화학/교재/a.PDF"].subject_key == "biochemistry" and got["1-1. 생화학/교재/a.PDF"].ext == ".pdf"
    assert got["other/b.txt"].source_key == "_root/other/b.txt" and got["other/b.txt"].area == 0
    assert got["c"].category is None and got["c"].ext == ""


@pytest.mark.parametrize("path, kind", [
    ("x/국시 기출문제/최종답안.pdf", "past-paper-answer"), ("x/국시 기출문제/a.pdf", "past-paper"), ("x/국시 기출문제/a.md", "note"),
    ("x/공부가이드.pdf", "study-guide"), ("x/a의 사본", "audio"), ("x/a.m4a", "audio"), ("주교재/a.zip", "goodnotes"),
    ("주교재/요약.pdf", "textbook"), ("x/요약 문제집.pdf", "workbook"), ("x/a.pdf", "etc"), ("x/a.numbers", "spreadsheet"),
])
def test_material_type(spark, path, kind):
    assert spark.createDataFrame([(path,)], "p string").select(paths.material_type(F.col("p"))).first()[0] == kind


@pytest.mark.parametrize("pages, want", [
    (1, [1]), (2, [1, 2]), (3, [1, 2, 3]), (8, list(range(1, 9))), (9, [1, 2, 3, 4, 6, 7, 8, 9]),
    (100, [1, 15, 29, 43, 58, 72, 86, 100]), (0, []), (None, []),
])
def test_even_pages(spark, pages, want):
    got = spark.createDataFrame([(pages,)], "p int").select(A.even_pages(F.col("p")).alias("s")).first().s
    assert list(got) == want


COMMON, RARE, ODD = "이", "뷁", "क"


@pytest.mark.parametrize("body, want", [
    ("a" * 59, "EMPTY"), (" a 　" * 59, "EMPTY"), ("a" * 60, "MOJIBAKE"),
    (COMMON * 20 + "a" * 40, "CLEAN"), (COMMON * 19 + "a" * 41, "MOJIBAKE"),
    (COMMON * 2 + RARE * 18 + "a" * 40, "MOJIBAKE"), (COMMON * 3 + RARE * 17 + "a" * 40, "CLEAN"),
    (COMMON * 50 + ODD * 10, "CLEAN"), (COMMON * 50 + ODD * 11, "MOJIBAKE"),
    (COMMON * 380 + ODD * 20, "CLEAN"), (COMMON * 379 + ODD * 21, "MOJIBAKE"),
])
def test_page_class(spark, body, want):
    assert A.text_class(spark.createDataFrame([(body,)], "body string")).first().page_class == want


@pytest.mark.parametrize("kinds, want", [
    (["EMPTY", "EMPTY"], "SCAN"), (["CLEAN", "MOJIBAKE"], "MOJIBAKE"), (["CLEAN", "EMPTY", "EMPTY"], "SCAN"), (["CLEAN", "EMPTY"], "CLEAN"),
])
def test_doc_layer(spark, kinds, want):
    df = spark.createDataFrame([(1, k) for k in kinds], "doc int, page_class string")
    assert A.doc_text_layer(df, ["doc"]).first().text_layer == want


def test_dup_groups_with_hot_group(spark):
    rows = [(f"p{i:03}", "x", 5) for i in range(40)] + [("q1", "y", 5), ("q0", "y", 5), ("r", "x", 6), ("s", "z", 5)]
    df = spark.createDataFrame(rows, "path string, content_sha string, size_bytes long")
    for parts in (1, 6):
        got = {r.path: (r.dup_group, r.is_primary) for r in A.dup_groups(df.repartition(parts)).collect()}
        assert got["p000"] == ("dup000", True) and got["p039"] == ("dup000", False)
        assert got["q0"] == ("dup001", True) and got["q1"] == ("dup001", False)
        assert got["r"] == (None, True) and got["s"] == (None, True)


def test_size_and_selection(spark):
    assert spark.range(1).select(A.size_mb(F.lit(1572864)).alias("s")).first().s == 1.5
    df = spark.createDataFrame([("b", "t", "vision", True), ("a", "t", "vision", True), ("c", "t", "vision", False)],
                               "path string, material_type string, extract_route string, is_primary boolean")
    assert [r.path for r in A.select_assets(df, limit=1).collect()] == ["a"]
    assert A.select_assets(df, limit=0).count() == 2 and A.select_assets(df, primary_only=False).count() == 3


def test_page_names(spark):
    df = spark.createDataFrame([("p-0012.png",), ("p-x.png",), ("12.png",)], "n string")
    assert [r[0] for r in df.select(text.page_of_name(F.col("n"))).collect()] == [12, None, None]
    keys = spark.createDataFrame([("s", 7), ("s", 12345)], "s string, p int").select(text.page_key(F.col("s"), F.col("p")))
    assert [r[0] for r in keys.collect()] == ["s-0007", "s-12345"]

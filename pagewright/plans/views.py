"""Views over the given tables that give the operators inputs of the shapes they expect.

Each view exists twice: as a DataFrame, and as SQL text for the side-by-side check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text
from pagewright.operators import inventory

LINES_PER_PAGE = 5
#: Rows of a table that one task takes at most on average, where a row may become thousands.
ROWS_PER_TASK = 2048


def pick(values, index: Column) -> Column:
    """Element of a literal list by a 0-based column."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


EXTENSIONS = (".pdf", ".csv", ".txt", ".zip", ".mp3", ".pdf")
FOLDERS = (
    "03. 주교재", "기본서", "부교재 모음", "문제집", "요약", "정리본 2권", "암기송", "생약송", "실습송",
    "말만들기", "플래시카드", "스터디", "정오표", "국시 기출문제 (2020-2026)", "00. 안내", "기타",
)
STEMS = ("최종답안", "공부가이드", "D등급", "노트", "요약", "의 사본")
AREA_LABELS = ("생명약학", "산업약학", "임상·실무약학", "보건·의약 관계 법규", "기타", "")
MARK_TYPES = ("color", "hl", "underline", "red", "other")
SESSIONS = {1: 100, 2: 90, 3: 77, 4: 83}


class Views:
    """The views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """A table for heavy per-row work, dealt out by key: a file may be one split whatever its size.

        The parts grow in number with the rows, which the files' footers tell, so what a task holds stays the same.
        """
        rows = self.table(name)
        parts = -(-rows.count() // ROWS_PER_TASK)
        return rows.repartition(parts, key) if parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else rows.repartition(key)

    @cached_property
    def documents(self) -> DataFrame:
        return self.spread("documents", "doc_id")

    @cached_property
    def lines(self) -> DataFrame:
        split = self.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        return split.select(
            "doc_id", (F.col("pos") + 1).alias("line_no"), "line",
            (F.floor(F.col("pos") / LINES_PER_PAGE) + 1).cast("int").alias("page"),
        )

    @cached_property
    def doc_page(self) -> DataFrame:
        """Five lines make a page; cut within the row, without a shuffle."""
        lines = self.documents.select("doc_id", F.split("text", "\n").alias("_l"))
        last = F.floor((F.size("_l") - 1) / LINES_PER_PAGE).cast("int")
        bodies = F.transform(
            F.sequence(F.lit(0), last),
            lambda p: F.array_join(F.slice("_l", p * LINES_PER_PAGE + 1, F.lit(LINES_PER_PAGE)), "\n"),
        )
        return lines.select("doc_id", F.posexplode(bodies).alias("pos", "body")).select(
            "doc_id", (F.col("pos") + 1).alias("page"), "body"
        )

    @cached_property
    def assets(self) -> DataFrame:
        doc = F.col("doc_id")
        breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
        name = F.concat_ws("/", "source", "lang", F.lpad(doc.cast("string"), 8, "0"))
        return self.documents.select(
            "doc_id",
            F.concat(name, pick(EXTENSIONS, doc % 6)).alias("path"),
            inventory.content_hash(F.col("text")).alias("content_sha"),
            F.octet_length("text").alias("size_bytes"),
            (F.floor(breaks / LINES_PER_PAGE) + 1).cast("int").alias("pages"),
        )

    @cached_property
    def subjects(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.table("nation").select(
            n.alias("ord"), F.concat(F.lit("src"), n).alias("folder"), F.lower("n_name").alias("key"),
            F.col("n_regionkey").alias("area"), (10 + n % 5).alias("quota"), (F.col("n_regionkey") + 1).alias("session"),
        )

    @cached_property
    def manifest(self) -> DataFrame:
        """Assets with every classified field."""
        with_type = inventory.path_fields(self.assets, self.subjects).withColumn(
            "material_type", material_of(F.col("doc_id"))
        )
        layered = with_type.withColumn("text_layer", F.when(F.col("doc_id") % 3 == 0, "CLEAN").otherwise("SCAN"))
        return inventory.dup_groups(inventory.with_extract_route(layered))

    @cached_property
    def doc_dim(self) -> DataFrame:
        """Document key with subject and material type, without the text."""
        d = F.col("doc_id")
        return self.table("documents").select(
            "doc_id", F.concat(F.lit("s"), d % 15).alias("subject_key"), material_of(d).alias("material_type")
        )

    @cached_property
    def stored(self) -> DataFrame:
        return self.doc_page.filter((F.col("doc_id") * 7 + F.col("page")) % 5 != 0)

    @cached_property
    def expected_docs(self) -> DataFrame:
        return self.assets.select(
            "doc_id", "path", "pages", F.concat(F.lit("s"), F.col("doc_id") % 15).alias("subject_key"),
            material_of(F.col("doc_id")).alias("material_type"),
            F.regexp_extract("path", r"(\.[a-z0-9]+)$", 1).alias("ext"),
        )

    @cached_property
    def page_md(self) -> DataFrame:
        d, p = F.col("doc_id"), F.col("page")
        nl = F.lit("\n")
        lead = F.when(d % 19 == 6, nl).when(d % 19 == 7, F.lit("C. 표\n")).otherwise("")
        body = F.when(d % 23 == 8, "Sorry, this page cannot be read and nothing was written down here.").otherwise(F.col("body"))
        md = F.concat(
            F.lit("---\nsha: "), F.lpad(F.when(d % 11 == 3, d + 1).otherwise(d).cast("string"), 16, "0"),
            F.lit("\npage: "), F.when(d % 13 == 4, p + 1).otherwise(p).cast("string"), nl,
            F.when(d % 17 == 5, "").otherwise(F.concat(F.lit("subject_key: s"), d % 15, nl)),
            F.lit("source_key: k"), d, F.lit("\n---\n"), lead, body,
        )
        return self.doc_page.select("doc_id", "page", F.lpad(d.cast("string"), 16, "0").alias("sha"), md.alias("md"))

    @cached_property
    def marked(self) -> DataFrame:
        kind = (F.col("doc_id") + F.col("page")) % 4
        body = (
            F.when(kind == 0, F.col("body"))
            .when(kind == 1, F.concat(F.lit("**key** "), "body"))
            .when(kind == 2, F.concat(F.lit("<mark>**key**</mark> "), "body"))
            .otherwise(F.concat(F.lit("<u>key</u> <mark>open "), "body"))
        )
        return self.doc_page.select("doc_id", "page", body.alias("body"))

    @cached_property
    def baseline_source(self) -> DataFrame:
        """Pages as they were frozen: some since changed, some not there yet."""
        d, p = F.col("doc_id"), F.col("page")
        body = F.when(d % 7 == 2, F.concat("body", F.lit(" x"))).otherwise(F.col("body"))
        return self.marked.filter((d + p) % 10 != 0).withColumn("body", body)

    @cached_property
    def good_instructions(self) -> DataFrame:
        """One JSON instruction record per page, with all kinds of flaws but readable."""
        d, p = F.col("doc_id"), F.col("page")
        words = F.split("body", "\n")

        def mark(line: Column, i: Column) -> Column:
            number = (p - 1) * LINES_PER_PAGE + i + 1
            first = F.substring_index(line, " ", 1)
            return F.struct(
                (i + 1 + pick((0, 1, -2, 4), (d + number) % 4)).alias("line"),
                F.when((d + number) % 7 == 0, "zzz not present")
                .when((d + number) % 5 == 0, F.substring(line, 1, 12))
                .when((d + number) % 5 == 1, F.substring(line, 6, 12))
                .otherwise(first).alias("text"),
                pick(MARK_TYPES, number % 5).alias("type"),
            )

        def chosen(line: Column, i: Column) -> Column:
            number = (p - 1) * LINES_PER_PAGE + i + 1
            return F.when((F.substring_index(line, " ", 1) != "") & ((d + number) % 3 != 0), mark(line, i))

        marks = F.filter(F.transform(words, chosen), lambda m: m.isNotNull())
        empty = F.array().cast("array<struct<line:bigint,text:string,type:string>>")
        record = F.struct(
            F.when(d % 31 == 7, d + 1).otherwise(d).cast("string").alias("sha"),
            F.when(d % 37 == 8, p + 1).otherwise(p).alias("page"),
            F.when((d + p) % 6 < 3, marks).otherwise(empty).alias("marks"),
            F.when(((d + p) % 6 == 3), pick(("no-emphasis", "figure-only", "header-only"), d % 3)).alias("none"),
            ((d + p) % 6 == 4).alias("clear"),
        )
        # As people write them: numbers as text in some records, no list where there are no marks in others.
        raw = F.to_json(record)
        raw = F.when(d % 3 == 0, F.regexp_replace(raw, r'"page":(\d+)', r'"page":"$1"')).otherwise(raw)
        raw = F.when(d % 4 == 1, F.regexp_replace(raw, r'"line":(-?\d+)', r'"line":"$1"')).otherwise(raw)
        raw = F.when(d % 5 == 2, F.replace(raw, F.lit('"marks":[]'), F.lit('"marks":{}'))).otherwise(raw)
        return self.doc_page.filter((d + p) % 8 != 7).select("doc_id", "page", raw.alias("raw"))

    @cached_property
    def instructions(self) -> DataFrame:
        """The records as found: some are cut off in the middle of their JSON text."""
        raw = F.when(F.col("doc_id") % 41 == 9, F.substring("raw", 1, 8)).otherwise(F.col("raw"))
        return self.good_instructions.withColumn("raw", raw)

    @cached_property
    def scan(self) -> DataFrame:
        d, p = F.col("doc_id"), F.col("page")
        return self.doc_page.select(
            "doc_id", "page", ((d * 5 + p * 3) % 7).alias("text_ink"), ((d + p * 2) % 3).alias("text_hl"),
            ((d + p) % 29 == 0).alias("is_err"),
        ).withColumn("text_ink", F.greatest(F.col("text_ink") - 4, F.lit(0))).withColumn(
            "text_hl", F.greatest(F.col("text_hl") - 1, F.lit(0))
        )

    @cached_property
    def pair(self) -> DataFrame:
        extra = self.table("benchmark").agg(F.min("text").alias("t")).scalar()
        d = F.col("doc_id") % 4
        got = (
            F.when(d == 0, F.col("text"))
            .when(d == 1, F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") * 4 / 5).cast("int")))
            .when(d == 2, F.concat("text", F.lit(" "), extra))
            .otherwise("")
        )
        return self.documents.select("doc_id", F.col("text").alias("truth"), got.alias("got"))

    @cached_property
    def word_box(self) -> DataFrame:
        d, n = F.col("doc_id"), F.col("n_chars")
        words = F.split(F.replace(F.col("body"), F.lit("\n"), F.lit(" ")), " ")
        laid = self.doc_page.select("doc_id", "page", F.posexplode(words).alias("pos", "_w")).select(
            "doc_id", "page", (F.col("pos") + 1).alias("seq"), F.length("_w").alias("n_chars")
        ).filter("n_chars >= 2")
        side = d % 17 == 1
        return laid.select(
            "doc_id", "page", "seq", "n_chars",
            F.when(side, 10).otherwise(n * 6).alias("w"), F.when(side, n * 6).otherwise(10).alias("h"),
            F.when(side & (d % 2 == 0), F.col("seq") * 14).when(side, 4000 - F.col("seq") * 14)
            .otherwise(F.floor(F.col("seq") / 8).cast("int") * 14).alias("y"),
        )

    @cached_property
    def pixels(self) -> DataFrame:
        """Eighty vectors make a page of 128 x 80 pixels, one vector per pixel row, each value twice."""
        vec = F.col("vec_id")
        values = self.spread("embeddings", "vec_id").select("vec_id", F.posexplode("embedding").alias("i", "_e"))
        v = F.floor(F.abs(F.col("_e").cast("double")) * 1000).cast("int")
        grid = values.select(
            F.floor(vec / 80).cast("int").alias("page"), (vec % 80).cast("int").alias("y"), "vec_id", "i",
            v.alias("v"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_half"),
        ).withColumn("x", F.col("i") * 2 + F.col("_half"))
        y, x, v = F.col("y"), F.col("x"), F.col("v")
        rule, gap = y % 40 == 38, (y % 40 >= 34) & (y % 40 != 38)
        in_rule = (x >= F.col("vec_id") % 7) & (x < F.col("vec_id") % 7 + 44 + F.col("vec_id") % 9)
        cx, cy, page = F.floor(x / 8), F.floor(y / 8), F.col("page")
        colored = ((cy + cx * 2 + page) % 5 < 2) & ((cx * 3 + cy * 2 + page) % 4 != 0)
        bright = ((F.floor(cx / 3) + F.floor(cy / 3)) % 3 == page % 3) & ((cx + cy * 2 + page) % 4 < 3)
        base = F.when(rule, F.when(in_rule, 20).otherwise(250)).when(gap, F.lit(250))

        def channel(ink: Column, hl: Column) -> Column:
            return F.coalesce(base, F.when(bright, hl).when(colored, ink).otherwise(v % 256)).cast("int")

        r = channel(120 + v * 7 % 80, 205 + v * 7 % 45)
        g = channel(v * 3 % 120, 95 + v * 3 % 40)
        b = channel(v * 5 % 100 + page % 3 * 50, 95 + v * 5 % 50)
        return text.pinned(grid.select("page", "x", "y", "vec_id", "v"), r=r, g=g, b=b).drop("vec_id", "v")

    @cached_property
    def page_sizes(self) -> DataFrame:
        page = F.floor(F.col("vec_id") / 80).cast("int").alias("page")
        return self.table("embeddings").groupBy(page).agg(
            (F.max(F.col("vec_id") % 80) + 1).cast("int").alias("height")
        ).withColumn("width", F.lit(128))

    @cached_property
    def cells(self) -> DataFrame:
        """64-float vectors as 8 x 8 cells."""
        spread = self.table("embeddings").select(F.col("vec_id").alias("page"), F.posexplode("embedding").alias("i", "_e"))
        return spread.select(
            "page", (F.col("i") % 8).alias("cx"), F.floor(F.col("i") / 8).cast("int").alias("cy"),
            F.floor(F.abs(F.col("_e").cast("double")) * 100).cast("int").alias("px"),
        )

    @cached_property
    def usage(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("long")
        tok_in = F.floor(F.col("value") * 10).cast("long")
        return self.table("events").select(
            "event_id", F.col("ts").cast("timestamp").alias("t"), F.col("event_type").alias("tag"),
            tok_in.alias("tok_in"), F.floor("value").cast("long").alias("tok_out"),
            F.least(k, tok_in).alias("cached"), "user_id",
        )

    @cached_property
    def exam_pages(self) -> DataFrame:
        """Page extractions: an array of items per page, numbers repeating across documents."""
        d = F.col("doc_id")
        words = lambda line: F.slice(F.split(line, " "), 1, 5)
        number = lambda i: ((d * 31 + (F.col("page") - 1) * LINES_PER_PAGE + i) % 120 + 1).cast("int")
        items = F.transform(
            F.split("body", "\n"),
            lambda line, i: F.struct(
                number(i).alias("number"), line.alias("stem"), words(line).alias("options"),
                ((d + i) % 9 == 4).alias("figure_withheld"),
            ),
        )
        return text.pinned(self.doc_page, items=items).select(
            "doc_id", "page", (71 + d % 7).cast("int").alias("exam_round"),
            (1 + F.floor(d / 7) % 4).cast("int").alias("session"), "items",
        )

    @cached_property
    def answer_rows(self) -> DataFrame:
        order, part = F.col("l_orderkey"), F.col("l_partkey")
        return self.table("lineitem").select(
            F.concat_ws("-", 71 + order % 7, 1 + F.floor(order / 7) % 4, 1 + part % 120).alias("id"),
            (F.col("l_quantity").cast("long") % 7).alias("answer"),
            pick(AREA_LABELS, F.col("l_suppkey") % 6).alias("area_label"),
            *[F.col(c) for c in ANSWER_ORDER],
        )

    @cached_property
    def guide_docs(self) -> DataFrame:
        """Per conversation turn: lists to merge per subject."""
        c, t = F.col("conv_id"), F.col("turn")
        lines = F.split("text", "\n")
        role = F.col("role")
        none = F.array().cast("array<string>")
        units = F.transform(lines, lambda line, i: F.struct(F.substring(line, 1, 10).alias("unit"), (i + 1).alias("rank")))
        return self.table("conversations").select(
            "conv_id", "turn", pick_subject(c).alias("subject_key"),
            F.when(role == "user", lines).otherwise(none).alias("study_order"),
            F.when((role == "assistant") & (c % 13 != 5), units).otherwise(F.array().cast(UNITS)).alias("unit_priority"),
            F.when(role == "system", lines).otherwise(none).alias("notes"),
            F.when((role == "user") & (t % 4 == 2), F.transform(lines, lambda line: F.substring_index(line, " ", 1))).otherwise(none)
            .alias("recommended_materials"),
            pick(MATERIALS, F.floor(c / 5) % 8).alias("type"), F.concat(F.lit("talk/"), c, F.lit("/"), t).alias("source_key"),
            F.sha2("text", 256).alias("sha"),
        )


ANSWER_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
UNITS = "array<struct<unit:string,rank:int>>"
MATERIALS = ("textbook", "summary", "study-guide", "workbook", "etc", "lecture", "past-paper", "mnemonic")


def material_of(doc_id: Column) -> Column:
    return pick(MATERIALS, F.floor(doc_id / 5) % 8)


def pick_subject(conv_id: Column) -> Column:
    """Subject of a conversation; some of the dimension's subjects get none."""
    return F.concat(F.lit("nation_"), conv_id % 13)



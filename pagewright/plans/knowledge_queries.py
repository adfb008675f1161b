"""Queries over cards, quota ranges, items and guides."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators import knowledge as C
from pagewright.plans.registry import query
from pagewright.plans.sql_views import trim
from pagewright.plans.views import ANSWER_ORDER, SESSIONS, Views
from pagewright.session import workspace
from pagewright.sources import tables
from pagewright.sources.cards import read_cards_csv

_DECKS = f"""
    select concat(lpad(cast(a as varchar), 2, '0'), 'to', lpad(cast(a + 7 as varchar), 2, '0'), '_약치part', a, '_deck') as deck, a,
      {trim("front")} as front, {trim("back")} as back, conv_id, k
    from (select conv_id % 8 + 1 as a, coalesce(max(text) filter (turn % 2 = 0), '') as front, case when conv_id % 10 = 3 then '  ' else
      concat(' "', coalesce(max(text) filter (turn % 2 = 1), ''), '", ', chr(13), chr(10), 'x ') end as back, conv_id, turn // 2 as k
      from conversations group by conv_id, turn // 2)"""


def _deck_files(v: Views):
    """All turns, each with the next as its answer, as card files with quotes and line breaks (CRs as well); the files of a deck follow one another by name."""
    c = F.col("conv_id")
    a = c % 8 + 1
    turn = lambda n: F.coalesce(F.max(F.when(F.col("turn") % 2 == n, F.col("text"))), F.lit(""))
    pairs = v.table("conversations").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("_k")).agg(turn(0).alias("front"), turn(1).alias("_answer"))
    back = F.when(c % 10 == 3, "  ").otherwise(F.concat(F.lit(' "'), "_answer", F.lit('", \r\nx ')))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    deck = F.concat(two(a), F.lit("to"), two(a + 7), F.lit("_약치part"), a, F.lit("_deck"))
    path = workspace(v.spark, "cards")
    rows = pairs.select("front", back.alias("back"), deck.alias("deck"), "conv_id", "_k").repartitionByRange("deck", "conv_id", "_k").sortWithinPartitions("deck", "conv_id", "_k")
    rows.drop("conv_id", "_k").write.partitionBy("deck").option("escape", '"').option(
        "ignoreLeadingWhiteSpace", "false"
    ).option("ignoreTrailingWhiteSpace", "false").csv(path)
    cards = read_cards_csv(v.spark, f"{path}/*")
    folder = F.regexp_extract(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), r"deck=([^/]+)/", 1)
    return cards.withColumn("deck", folder).withColumn("subject_key", F.lit("talk"))


@query("cards", f"""
    select printf('talk-%05d', row_number() over (order by deck, conv_id, k)) as id, deck, concat('part', a) as chapter,
      cast(a as int) as chapter_from, cast(a + 7 as int) as chapter_to, front, back from ({_DECKS}) where front <> '' and back <> ''""")
def cards(v: Views):
    kept = C.clean_cards(C.card_attributes(_deck_files(v), "deck"))
    return kept.select("id", "deck", "chapter", "chapter_from", "chapter_to", "front", "back")


@query("cards_per_file", f"""
    select deck, count(*) as parsed, count(*) filter (front <> '' and back <> '') as kept from ({_DECKS}) group by 1""")
def cards_per_file(v: Views):
    return C.cards_per_file(_deck_files(v), "deck")


@query("quota_ranges", "select key, session, quota, n_from, n_to from fx_ranges")
def quota_ranges(v: Views):
    return C.quota_ranges(v.subjects).select("key", "session", "quota", "n_from", "n_to")


@query("layout_errors", """
    with sums as (select session, cast(sum(quota) as bigint) as got from fx_subjects group by 1),
    wanted as (select r_regionkey + 1 as session, 60 as want from region where r_regionkey < 4)
    select session, got, want from sums full join wanted using (session) where got is distinct from want
    union all select null, cast(sum(got) as bigint), (select cast(count(*) * 10 as bigint) from nation) from sums
      having sum(got) <> (select count(*) * 10 from nation)""")
def layout_errors(v: Views):
    totals = v.table("region").filter("r_regionkey < 4").select((F.col("r_regionkey") + 1).alias("session"), F.lit(60).alias("want"))
    grand = v.table("nation").agg((F.count(F.lit(1)) * 10).alias("n")).scalar()
    return C.assert_layout(v.subjects, totals, grand)


@query("range_lookup", """
    select subject_key, count(*) as n, cast(sum(number) as bigint) as numbers from (
      select r.key as subject_key, number from (select 1 + l_orderkey % 4 as session, cast(l_quantity as bigint) * 2 - 1 as number from lineitem) l
      left join fx_ranges r on r.session = l.session and number between n_from and n_to) group by 1""")
def range_lookup(v: Views):
    number = (F.col("l_quantity").cast("long") * 2 - 1).alias("number")
    rows = v.table("lineitem").select((1 + F.col("l_orderkey") % 4).alias("session"), number)
    found = C.range_lookup(rows, C.quota_ranges(v.subjects), bucket=16)
    return found.groupBy("subject_key").agg(F.count(F.lit(1)).alias("n"), F.sum("number").alias("numbers"))


_PAPER = """
    select doc_id, concat('제', case when doc_id % 12 = 5 then '' else cast(71 + doc_id % 7 as varchar) end, '회 ',
      case when doc_id % 10 = 7 then 'x' else cast(doc_id % 5 as varchar) end, '교시 전체 문제.pdf') as filename from documents"""


def _papers(v: Views):
    d = F.col("doc_id")
    name = F.concat(
        F.lit("제"), F.when(d % 12 == 5, "").otherwise((71 + d % 7).cast("string")), F.lit("회 "),
        F.when(d % 10 == 7, "x").otherwise((d % 5).cast("string")), F.lit("교시 전체 문제.pdf"),
    )
    return v.table("documents").select("doc_id", name.alias("filename"))


@query("paper_attributes", f"""
    select doc_id, try_cast(regexp_extract(filename, '제(\\d+)회', 1) as int) as exam_round, try_cast(regexp_extract(filename, '(\\d)교시[ ]*전체[ ]*문제', 1) as int) as session
    from ({_PAPER}) where doc_id % 12 <> 5 and doc_id % 10 <> 7 and doc_id % 5 <> 0""")
def paper_attributes(v: Views):
    return C.paper_attributes(_papers(v))[0].select("doc_id", "exam_round", "session")


@query("paper_rejects", f"select doc_id, filename from ({_PAPER}) where doc_id % 12 = 5 or doc_id % 10 = 7 or doc_id % 5 = 0")
def paper_rejects(v: Views):
    return C.paper_attributes(_papers(v))[1].select("doc_id", "filename")


@query("notes_check", """
    select key, session, n_from, n_to, case when ord % 6 = 1 then 'no notice' when ord % 4 = 2 then 'differs' end as why, ord % 6 = 1 or ord % 4 = 2 as bad from fx_ranges""")
def notes_check(v: Views):
    ranges = C.quota_ranges(v.subjects)
    last = F.when(F.col("ord") % 4 == 2, F.col("n_to") + 1).otherwise(F.col("n_to"))
    note = F.concat(F.lit("시험지: "), "session", F.lit("교시\n문항 범위: "), "n_from", F.lit(" ~ "), last, F.lit("번"))
    notes = ranges.filter("ord % 6 <> 1").select(F.col("key").alias("subject_key"), note.alias("note"))
    return C.crosscheck_notes(notes, ranges)


ORDER = ("doc_id", "page", "pos")


def _items(v: Views):
    items = C.explode_items(v.exam_pages, "items")
    return items.withColumn("id", F.concat_ws("-", "exam_round", "session", "number"))


@query("explode_items", "select doc_id, page, pos, number, stem, len(options) as n_options, figure_withheld from fx_items")
def explode_items(v: Views):
    return C.explode_items(v.exam_pages, "items").select(
        "doc_id", "page", "pos", "number", "stem", F.size("options").alias("n_options"), "figure_withheld"
    )


@query("first_wins", "select id, doc_id, page, pos, stem from fx_first")
def first_wins(v: Views):
    return C.first_wins(_items(v), ["id"], ORDER).select("id", "doc_id", "page", "pos", "stem")


@query("first_wins_repeats", """
    select concat_ws('-', exam_round, session, number) as id, doc_id, page, pos from fx_items
    anti join fx_first f using (doc_id, page, pos)""")
def first_wins_repeats(v: Views):
    return C.repeats(_items(v).select("id", *ORDER), ["id"], ORDER)


@query("last_wins", "select id, answer, area_label from fx_answers")
def last_wins(v: Views):
    return C.last_wins(v.answer_rows, ["id"], ANSWER_ORDER).select("id", "answer", "area_label")


def _questions(v: Views):
    first = C.first_wins(_items(v), ["id"], ORDER)
    ranges = C.quota_ranges(v.subjects)
    keyed = C.range_lookup(first, ranges)
    areas = v.subjects.select(F.col("key").alias("subject_key"), "area")
    answers = C.last_wins(v.answer_rows, ["id"], ANSWER_ORDER)
    years = v.table("documents").select((71 + F.col("doc_id") % 7).cast("int").alias("exam_round")).distinct()
    dated = C.round_year(keyed, years.withColumn("exam_year", 1949 + F.col("exam_round")))
    return C.join_answers(dated.join(areas, "subject_key", "left"), answers)


@query("join_answers", """
    select id, exam_round, exam_year, session, number, subject_key, area, area_label, stem, answer, figure_withheld, doc_id, page from fx_questions""")
def join_answers(v: Views):
    return _questions(v).select(
        "id", "exam_round", "exam_year", "session", "number", "subject_key", "area", "area_label", "stem", "answer",
        "figure_withheld", "doc_id", "page",
    )


@query("area_check", """
    select id, area, area_label, label_area from (select *, case when contains(area_label, '생명') then 1 when contains(area_label, '산업') then 2
      when contains(area_label, '법규') or contains(area_label, '보건') then 4 when contains(area_label, '임상') or contains(area_label, '실무') then 3 else 0 end as label_area
      from fx_questions) where label_area <> 0 and label_area is distinct from area""")
def area_check(v: Views):
    return C.cross_check(_questions(v)).select("id", "area", "area_label", "label_area")


@query("final_order", "select id, row_number() over (order by exam_round, session, number) - 1 as seq from fx_first")
def final_order(v: Views):
    first = C.first_wins(_items(v), ["id"], ORDER)
    return C.final_order(first.select("id", "exam_round", "session", "number")).select("id", "seq")


@query("grid_gate", """
    with grid as (select exam_round, session, want from (select distinct cast(71 + doc_id % 8 as int) as exam_round from documents),
      (select unnest([1, 2, 3, 4]) as session, unnest([100, 90, 77, 83]) as want))
    select g.exam_round, g.session, want, coalesce(n, 0) as got, coalesce(n, 0) = want as passed from grid g
    left join (select exam_round, session, count(*) as n from fx_first group by 1, 2) c on c.exam_round = g.exam_round and c.session = g.session""")
def grid_gate(v: Views):
    rounds = v.table("documents").select((71 + F.col("doc_id") % 8).cast("int").alias("exam_round")).distinct()
    return C.grid_gate(C.first_wins(_items(v), ["id"], ORDER), rounds, SESSIONS)


@query("record_gates", f"""
    select count(*) as items, count(*) filter (len(options) <> 5) as bad_options, count(*) filter (answer is null) as no_answer,
      count(*) filter (answer not between 0 and 5) as bad_answer, count(*) - count(distinct id) as repeated_ids,
      count(*) filter (subject_key is null) as no_subject, count(*) filter (length({trim("stem")}) < 3) as empty_stem,
      count(*) filter (figure_withheld) as withheld
    from (select i.*, concat_ws('-', exam_round, i.session, number) as id, r.key as subject_key, a.answer from fx_items i
      left join fx_ranges r on r.session = i.session and number between n_from and n_to
      left join fx_answers a on a.id = concat_ws('-', exam_round, i.session, number))""")
def record_gates(v: Views):
    keyed = C.range_lookup(_items(v), C.quota_ranges(v.subjects))
    return C.record_gates(C.join_answers(keyed, C.last_wins(v.answer_rows, ["id"], ANSWER_ORDER)))


@query("coverage_pivot", """
    select exam_round, max(pages) filter (session = 1) as session_1, max(pages) filter (session = 2) as session_2,
      max(pages) filter (session = 3) as session_3, max(pages) filter (session = 4) as session_4
    from (select 71 + doc_id % 7 as exam_round, 1 + (doc_id // 7) % 4 as session, pages from fx_assets) group by 1""")
def coverage_pivot(v: Views):
    d = F.col("doc_id")
    papers = v.assets.select((71 + d % 7).alias("exam_round"), (1 + F.floor(d / 7) % 4).alias("session"), "pages")
    return C.coverage_pivot(papers)


GUIDE_LISTS = ("study_order", "unit_priority", "recommended_materials", "notes")


def _entries(v: Views):
    return C.merge_by_subject(v.guide_docs, "subject_key", ["conv_id", "turn"], GUIDE_LISTS, v.subjects, ("type", "source_key", "sha"))


@query("merge_by_subject", """
    select subject_key, kind, row_number() over (partition by subject_key, kind order by conv_id, turn, pos) - 1 as place,
      conv_id, turn, entry, subject_order, subject_name, area, exam_questions, session from fx_entries""")
def merge_by_subject(v: Views):
    return _entries(v).select("subject_key", "kind", "place", "conv_id", "turn", "entry", *C.SUBJECT_COLUMNS)


@query("guide_heads", f"""
    select subject_key, subject_order, subject_name, area, exam_questions, session,
      {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in (*GUIDE_LISTS, "sources"))}
    from fx_entries group by all""")
def guide_heads(v: Views):
    return C.guide_heads(_entries(v), (*GUIDE_LISTS, "sources"))


@query("guide_gates", """
    select key as subject_key, n is null as missing, coalesce(content = 0, false) as no_content, coalesce(ranked = 0, false) as no_ranks
    from fx_subjects left join (select subject_key, count(*) as n, count(*) filter (kind in ('study_order', 'recommended_materials', 'notes')) as content,
      count(*) filter (kind = 'unit_priority') as ranked from fx_entries group by 1) e on e.subject_key = key""")
def guide_gates(v: Views):
    return C.guide_gates(_entries(v), v.subjects)


TALK = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("note", T.StringType()),
])


@query("jsonl", "select conv_id, turn, role, text, cast(null as varchar) as note from conversations")
def jsonl(v: Views):
    """Write and read back JSON lines; an absent table adds nothing."""
    path = workspace(v.spark, "talks")
    tables.write_jsonl(v.table("conversations").withColumn("note", F.lit(None).cast("string")), path)
    absent = tables.read_jsonl(v.spark, f"{path}-absent", TALK)
    return tables.read_jsonl(v.spark, path, TALK).unionByName(absent)



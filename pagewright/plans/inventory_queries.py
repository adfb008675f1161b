"""Queries over the asset inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import paths, text
from pagewright.operators import inventory as A
from pagewright.operators import pagestore as B
from pagewright.plans.registry import query
from pagewright.plans.sql_views import choose, squeeze
from pagewright.plans.views import FOLDERS, STEMS, Views, pick
from pagewright.session import workspace
from pagewright.sources import files


@query("scan_assets", """
    select source, count(*) > 0 as found, cast(sum(strlen(text) + 1) as bigint) as size_bytes from documents group by source""")
def scan_assets(v: Views):
    """Documents written as one text file per source, then listed."""
    root = workspace(v.spark, "files")
    v.table("documents").select("source", "text").repartition("source").write.partitionBy("source").text(root)
    listed = files.scan_assets(v.spark, root).filter(~F.col("path").contains("/_"))
    source = F.regexp_extract("path", r"source=([^/]+)/", 1)
    return listed.groupBy(source.alias("source")).agg(
        (F.count(F.lit(1)) == 1).alias("found"), F.sum("size_bytes").alias("size_bytes")
    )


@query("dup_groups", "select doc_id, path, content_sha, dup_group, is_primary from fx_dups")
def dup_groups(v: Views):
    return A.dup_groups(v.assets).select("doc_id", "path", "content_sha", "dup_group", "is_primary")


@query("dedup_savings", """
    select count(*) as assets, count(*) filter (is_primary) as primary_assets, cast(sum(pages) as bigint) as pages,
      cast(sum(pages) filter (is_primary) as bigint) as primary_pages, count(distinct dup_group) as dup_groups,
      cast(coalesce(sum(pages) filter (not is_primary), 0) as bigint) as pages_saved
    from fx_dups join fx_assets using (doc_id)""")
def dedup_savings(v: Views):
    return A.dedup_savings(A.dup_groups(v.assets))


GATES = """
    with counts as (select material_type, count(*) as n from fx_manifest where is_primary group by 1)
    select name, bad, bad = 0 as passed from (
      select 'every row has a route' as name, count(*) filter (extract_route is null) as bad from fx_manifest
      union all select 'every row has a hash', count(*) filter (content_sha is null) from fx_manifest
      union all select 'no hash twice among primaries', count(*) filter (n > 1) from (
        select count(*) as n from fx_manifest where is_primary group by content_sha)
      union all select 'file count of ' || p_type, abs(coalesce(n, 0) - want) from (
        select 'textbook' as p_type, count(*) // 100 as want from part union all select 'errata', 0) e
        left join counts on material_type = p_type)"""


@query("inventory_gates", GATES)
def inventory_gates(v: Views):
    wanted = v.table("part").agg(F.floor(F.count(F.lit(1)) / 100).alias("want")).select(
        F.inline(F.array(
            F.struct(F.lit("textbook").alias("material_type"), F.col("want").alias("want")),
            F.struct(F.lit("errata").alias("material_type"), F.lit(0).cast("long").alias("want")),
        ))
    )
    return A.inventory_gates(v.manifest, wanted)


@query("asset_fields", """
    select doc_id, source_key, subject_folder, subject_key, area, exam_questions, category, filename, ext,
      round(size_bytes / 1048576.0, 3) as size_mb from fx_fields
    where category <> 'es' and ext <> '.mp3' and not regexp_matches(filename, '7\\.zip$')""")
def asset_fields(v: Views):
    kept = A.skip_assets(v.assets, dirs=("es",), extensions=(".mp3",), pattern=r"7\.zip$")
    out = A.path_fields(kept, v.subjects).withColumn("size_mb", A.size_mb(F.col("size_bytes")))
    return out.drop("path", "content_sha", "size_bytes", "pages")


MIXED_EXTENSIONS = (".pdf", ".csv", ".txt", ".zip", ".mp3", ".mp4", ".xlsx", ".m4a", ".pdf", ".PDF")
_KEYWORD_CASES = " ".join(
    f"when contains(parent, '{word}') or contains(name, '{word}') then '{kind}'" for word, kind in V.MATERIAL_KEYWORDS
)


@query("material_type", f"""
    with named as (select doc_id, source, {choose(FOLDERS, "doc_id % 16")} as parent,
      concat(doc_id, ' ', {choose(STEMS, "(doc_id // 16) % 6")},
        case when (doc_id // 16) % 6 = 5 then '' else {choose(MIXED_EXTENSIONS, "doc_id % 10")} end) as name from documents),
    split as (select *, concat(source, '/', parent, '/', name) as path, lower(regexp_extract(name, '^.+(\\.[^.]*)$', 1)) as ext from named)
    select doc_id, path, case when ext in ('.md', '.txt') then 'note'
      when contains(parent, '국시 기출문제') then case when contains(name, '최종답안') then 'past-paper-answer' else 'past-paper' end
      when contains(name, '공부가이드') then 'study-guide' when contains(name, 'D등급') then 'd-grade-list'
      when ext in ('.mp3', '.m4a') or path like '%의 사본' then 'audio' when ext = '.mp4' then 'video'
      when ext = '.csv' then 'flashcard-csv' when ext in ('.xlsx', '.xls', '.numbers') then 'spreadsheet'
      when ext = '.zip' then 'goodnotes' {_KEYWORD_CASES} else 'etc' end as material_type from split""")
def material_type(v: Views):
    d = F.col("doc_id")
    stem = F.floor(d / 16) % 6
    ext = F.when(stem == 5, "").otherwise(pick(MIXED_EXTENSIONS, d % 10))
    name = F.concat(d.cast("string"), F.lit(" "), pick(STEMS, stem), ext)
    path = F.concat_ws("/", "source", pick(FOLDERS, d % 16), name)
    named = v.table("documents").select("doc_id", path.alias("path"))
    return named.select("doc_id", "path", paths.material_type(F.col("path")).alias("material_type"))


_LATIN_COUNTS = f"""
    select doc_id, page, length(t) as n_chars,
      length(regexp_replace(t, '[{text.LATIN.script}{text.LATIN.expected}]+', '', 'g')) as n_odd,
      length(regexp_replace(t, '[^{text.LATIN.script}]+', '', 'g')) as n_script,
      length(regexp_replace(t, '[^{text.LATIN.common}]+', '', 'g')) as n_common
    from (select doc_id, page, {squeeze("body")} as t from fx_doc_page)"""
_LATIN_CLASS = f"""
    select *, case when n_chars < 60 then 'EMPTY' when n_odd > greatest(10, n_chars * 0.05) then 'MOJIBAKE'
      when n_script >= 20 and n_common * 10 > n_script then 'CLEAN' else 'MOJIBAKE' end as page_class
    from ({_LATIN_COUNTS})"""
_LAYERS = f"""
    select doc_id, n_pages, n_real, n_bad, case when n_real = 0 then 'SCAN' when n_bad > 0 then 'MOJIBAKE'
      when n_real * 2 < n_pages then 'SCAN' else 'CLEAN' end as text_layer
    from (select doc_id, count(*) as n_pages, count(*) filter (page_class <> 'EMPTY') as n_real,
      count(*) filter (page_class = 'MOJIBAKE') as n_bad from ({_LATIN_CLASS}) group by doc_id)"""


@query("text_class", _LATIN_CLASS)
def text_class(v: Views):
    return A.text_class(v.doc_page, "body", text.LATIN).drop("body")


def _layers(v: Views):
    return A.doc_text_layer(A.text_class(v.doc_page, "body", text.LATIN), ["doc_id"])


@query("doc_layer", _LAYERS)
def doc_layer(v: Views):
    return _layers(v)


@query("extract_route", f"""
    select doc_id, ext, text_layer, case when ext = '.pdf' then case when text_layer = 'CLEAN' then 'pdftotext' else 'vision' end
      when ext = '.csv' then 'direct-csv' when ext in ('.xlsx', '.xls') then 'xls-ole2'
      when ext in ('.mp3', '.m4a') then 'audio-defer' when ext = '.zip' then 'goodnotes-defer' else 'manual' end as extract_route
    from fx_fields join ({_LAYERS}) using (doc_id)""")
def extract_route(v: Views):
    named = v.assets.select("doc_id", paths.extension(F.col("path")).alias("ext"), paths.material_type(F.col("path")).alias("material_type"))
    routed = A.with_extract_route(named.join(_layers(v), "doc_id"))
    return routed.select("doc_id", "ext", "text_layer", "extract_route")


@query("asset_rollups", """
    select case when grouping(ext) = 0 then 'ext' when grouping(subject_key) = 0 then 'subject_key' else 'material_type' end as dim,
      case when grouping(ext) = 0 then ext when grouping(subject_key) = 0 then subject_key else material_type end as value,
      count(*) as files, cast(sum(pages) as bigint) as pages
    from fx_manifest where is_primary group by grouping sets ((ext), (subject_key), (material_type))""")
def asset_rollups(v: Views):
    return A.rollup_assets(A.select_assets(v.manifest), ["ext", "subject_key", "material_type"])


@query("select_assets", """
    select doc_id, path, subject_key, material_type, extract_route, pages from fx_manifest
    where is_primary and material_type in ('textbook', 'summary') and extract_route in ('vision', 'pdftotext') and ext = '.pdf'""")
def select_assets(v: Views):
    chosen = A.select_assets(v.manifest, types=("textbook", "summary"), routes=("vision", "pdftotext"), ext=".pdf")
    return chosen.select("doc_id", "path", "subject_key", "material_type", "extract_route", "pages")


@query("total_pages", "select cast(sum(pages) as bigint) as pages from fx_manifest where is_primary and extract_route = 'vision'")
def total_pages(v: Views):
    return A.total_pages(A.select_assets(v.manifest, routes=("vision",)))


@query("probe_reuse", """
    with cached as (select distinct content_sha from fx_assets where doc_id % 3 = 0)
    select doc_id, content_sha, c.content_sha is not null as from_cache,
      case when c.content_sha is not null then 'CLEAN' when ascii(content_sha) % 2 = 0 then 'MOJIBAKE' else 'SCAN' end as text_layer
    from fx_assets left join cached c using (content_sha)""")
def probe_reuse(v: Views):
    assets = v.assets.select("doc_id", "content_sha")
    cache = assets.filter("doc_id % 3 = 0").select("content_sha").distinct().withColumn("text_layer", F.lit("CLEAN"))
    layer = F.when(F.ascii("content_sha") % 2 == 0, "MOJIBAKE").otherwise("SCAN")
    out, _ = A.reuse_probe(assets, cache, lambda missing: missing.withColumn("text_layer", layer))
    return out.select("doc_id", "content_sha", "from_cache", "text_layer")


@query("even_sample", """
    select distinct doc_id, pages, cast(1 + (2 * i * (pages - 1) + greatest(1, least(8, pages) - 1)) // (2 * greatest(1, least(8, pages) - 1)) as int) as page
    from (select doc_id, pages, unnest(range(0, least(8, pages))) as i from fx_assets)""")
def even_sample(v: Views):
    return A.even_sample(v.assets.select("doc_id", "pages"))


@query("page_explode", """
    select doc_id, page, printf('%s-%04d', content_sha, page) as page_key from (
      select doc_id, content_sha, cast(unnest(range(1, pages + 1)) as int) as page from fx_assets)""")
def page_explode(v: Views):
    exploded = B.explode_pages(v.assets.select("doc_id", "content_sha", "pages"))
    return exploded.select("doc_id", "page", text.page_key(F.col("content_sha"), F.col("page")).alias("page_key"))

"""Queries over the page store."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import text
from pagewright.operators import audit as G
from pagewright.operators import pagestore as B
from pagewright.plans.registry import query
from pagewright.plans.sql_views import head, lst, priority, ratio, rtrim, squeeze, trim
from pagewright.plans.views import Views
from pagewright.session import workspace
from pagewright.sources import tables

_PENDING = """
    select e.* from (select doc_id, path, pages, subject_key, material_type, cast(unnest(range(1, pages + 1)) as int) as page from fx_expected) e
    anti join fx_stored s on e.doc_id = s.doc_id and e.page = s.page"""


@query("compose_parse", f"""
    with composed as (select doc_id, page, concat('---', chr(10), 'sha: ', content_sha, chr(10), 'page: ', page, chr(10), 'pages_total: ', pages,
        chr(10), 'source_key: ', path, chr(10), 'extract_route: pdftotext', chr(10), '---', chr(10), {rtrim("body")}, chr(10)) as md
      from fx_doc_page join fx_assets using (doc_id)),
    split as (select doc_id, page, md, {head("md")} as head from composed)
    select doc_id, page, sha256(md) as md_sha, length(head) as head_len, length(md) - length(head) as body_len,
      regexp_extract(head, 'sha: ([^\\n]*)', 1) as sha, cast(regexp_extract(head, 'page: ([^\\n]*)', 1) as int) as head_page,
      regexp_extract(head, 'source_key: ([^\\n]*)', 1) as source_key from split""")
def compose_parse(v: Views):
    keys = ("sha", "page", "pages_total", "source_key", "extract_route")
    side = v.assets.select(
        "doc_id", F.col("content_sha").alias("sha"), F.col("pages").alias("pages_total"), F.col("path").alias("source_key"),
        F.lit("pdftotext").alias("extract_route"),
    )
    composed = B.compose_page(v.doc_page.join(side, "doc_id"), keys).select("doc_id", "page", "md")
    parsed = B.parse_front_matter(B.split_front_matter(composed))
    field = lambda k: F.try_element_at("fields", F.lit(k))
    return parsed.select(
        "doc_id", "page", F.sha2("md", 256).alias("md_sha"), F.length("head").alias("head_len"),
        F.length("body").alias("body_len"), field("sha").alias("sha"),
        field("page").cast("int").alias("head_page"), field("source_key").alias("source_key"),
    )


def _pending(v: Views):
    return B.worklist(v.expected_docs, v.stored, ("doc_id", "page"))


@query("worklist", f"select doc_id, page, subject_key from ({_PENDING})")
def worklist(v: Views):
    return _pending(v).select("doc_id", "page", "subject_key").orderBy("subject_key", "doc_id", "page")


@query("next_batch", f"""
    select doc_id, page, material_type, (select count(*) from ({_PENDING})) as total_pending from ({_PENDING})
    order by {priority("material_type", V.BATCH_PRIORITY)}, path, page limit 25""")
def next_batch(v: Views):
    return B.next_batch(_pending(v), 25).select("doc_id", "page", "material_type", "total_pending")


@query("completeness", """
    select doc_id, pages, coalesce(n, 0) as present, coalesce(n, 0) = pages as complete
    from fx_assets left join (select doc_id, count(*) as n from fx_stored group by 1) using (doc_id)""")
def completeness(v: Views):
    return B.completeness(v.assets.select("doc_id", "pages"), v.stored, "doc_id")


@query("reconcile_counts", """
    select doc_id, pages, n as rendered from fx_assets join (
      select doc_id, count(*) as n from fx_doc_page where (doc_id * 3 + page) % 4 <> 0 group by 1) using (doc_id) where n <> pages""")
def reconcile_counts(v: Views):
    rendered = v.doc_page.select("doc_id", "page").filter("(doc_id * 3 + page) % 4 <> 0")
    return B.reconcile_counts(v.assets.select("doc_id", "pages"), rendered, "doc_id")


@query("needs_render", """
    select doc_id, path, pages from fx_expected where ext = '.pdf' and doc_id in (select doc_id from fx_stored) and doc_id % 4 <> 0""")
def needs_render(v: Views):
    rendered = v.table("documents").select("doc_id").filter("doc_id % 4 = 0")
    return B.needs_render(v.expected_docs, v.stored, rendered, "doc_id").select("doc_id", "path", "pages")


_CHECK = f"""
    with parts as (select *, regexp_extract(md, '^---\\r?\\n([\\s\\S]*?)\\r?\\n---', 0) as h from fx_page_md),
    rated as (select *, {trim("substr(md, length(h) + 1)")} as body,
      list_filter({lst(V.REQUIRED_KEYS)}, lambda k: not contains(chr(10) || h, chr(10) || k || ':')) as missing from parts)
    select doc_id, page, md, case when h = '' then 'no front matter' when len(missing) > 0 then concat('missing keys: ', array_to_string(missing, ','))
      when not contains(h, concat('sha: ', sha, chr(10))) then 'sha mismatch'
      when not contains(h, concat(chr(10), 'page: ', page, chr(10))) then 'page mismatch'
      when length(body) < 40 then concat('body ', length(body), ' chars')
      when regexp_matches(body, '(?i)^(죄송|미안|I''m sorry|I cannot|Sorry)') then 'refusal' else 'ok' end as why from rated"""


@query("check_pages", f"select doc_id, page, why from ({_CHECK})")
def check_pages(v: Views):
    return B.check_pages(v.page_md).select("doc_id", "page", "why")


@query("progress_by_subject", f"""
    select subject_key, done, total, pending, problems, {ratio("done", "total", 1000)} as permille_done,
      coalesce({ratio("done_bytes", "done", 1)}, 0) as mean_bytes from (
      select e.subject_key, count(*) filter (why = 'ok') as done, count(*) as total, count(*) filter (why is null) as pending,
        count(*) filter (why <> 'ok') as problems, cast(coalesce(sum(strlen(md)) filter (why = 'ok'), 0) as bigint) as done_bytes
      from (select doc_id, concat('s', doc_id % 15) as subject_key, cast(unnest(range(1, pages + 1)) as int) as page from fx_assets) e
      left join (select * from ({_CHECK}) where (doc_id * 7 + page) % 5 <> 0) c on e.doc_id = c.doc_id and e.page = c.page
      group by rollup (e.subject_key))""")
def progress_by_subject(v: Views):
    expected = B.explode_pages(v.expected_docs).select("doc_id", "page", "subject_key")
    checked = B.check_pages(v.page_md.filter("(doc_id * 7 + page) % 5 <> 0"))
    return B.progress_by_subject(expected, checked, ("doc_id", "page"))


@query("stage_status", """
    select stage, got, want, case when got = 0 then 'none' when got >= want then 'done' else 'partial' end as mark from (
      select 'pages' as stage, (select count(*) from fx_stored) as got, (select count(*) from fx_doc_page) as want
      union all select 'labels', (select count(*) from labels), (select count(*) from documents)
      union all select 'documents', (select count(*) from documents), (select count(*) from documents)
      union all select 'cards', 0, (select count(*) from conversations))""")
def stage_status(v: Views):
    docs, talks = v.table("documents"), v.table("conversations")
    return B.stage_status({
        "pages": (v.stored, v.doc_page),
        "labels": (v.table("labels"), docs),
        "documents": (docs, docs),
        "cards": (talks.filter("turn < 0"), talks),
    })


@query("strip_label", f"""
    with parts as (select doc_id, page, md, {head("md")} as h from fx_page_md),
    cut as (select *, substr(md, length(h) + 1) as b from parts)
    select doc_id, page, case when hit then sha256(concat(h, regexp_replace(b, '^(\\n*)[^\\n]+\\n?', '\\1'))) else sha256(md) end as md_sha, hit as stripped
    from (select *, regexp_extract(b, '^\\n*([^\\n]+)', 1) in {str(tuple(V.LEAKED_LABELS))} as hit from cut)""")
def strip_label(v: Views):
    out = B.strip_leaked_label(v.page_md)
    return out.select("doc_id", "page", F.sha2("md", 256).alias("md_sha"), "stripped")


@query("drop_blank", f"""
    with parts as (select doc_id, page, md, {head("md")} as h from fx_page_md)
    select doc_id, page, h <> '' and substr(md, length(h) + 1, 1) = chr(10) as changed,
      sha256(case when substr(md, length(h) + 1, 1) = chr(10) then concat(h, substr(md, length(h) + 2)) else md end) as md_sha from parts""")
def drop_blank(v: Views):
    out = B.drop_leading_blank(v.page_md)
    return out.select("doc_id", "page", "changed", F.sha2("md", 256).alias("md_sha"))


@query("incremental_write", """
    select doc_id, page, sha256(case when (doc_id * 7 + page) % 5 <> 0 then body else concat(body, ' new') end) as body_sha from fx_doc_page""")
def incremental_write(v: Views):
    """Store most pages, then offer every page in a newer form: only missing ones are added."""
    path = workspace(v.spark, "pages")
    tables.incremental_write(v.stored, path, ("doc_id", "page"))
    offered = v.doc_page.withColumn("body", F.concat("body", F.lit(" new")))
    store = tables.incremental_write(offered, path, ("doc_id", "page"))
    return store.select("doc_id", "page", F.sha2("body", 256).alias("body_sha"))


@query("invalidate", "select doc_id, page, sha256(body) as body_sha from fx_stored where doc_id % 9 <> 2")
def invalidate(v: Views):
    """Drop the stored pages of some documents by rewriting the partitions that hold them."""
    path = workspace(v.spark, "pages")
    parts = v.stored.withColumn("part", F.col("doc_id") % 16)
    store = tables.incremental_write(parts, path, ("doc_id", "page"), partition_by=("part",))
    gone = v.table("documents").select("doc_id").filter("doc_id % 9 = 2")
    tables.rewrite_partitions(
        v.spark, path, B.invalidate(store, gone, ("doc_id",)), gone.select((F.col("doc_id") % 16).alias("part")), "part"
    )
    kept = tables.read_store(v.spark, path, store.schema)
    return kept.select("doc_id", "page", F.sha2("body", 256).alias("body_sha"))


@query("force_write", """
    select doc_id, page, doc_id % 4 as part, sha256(case when (doc_id * 3 + page) % 7 = 0 then concat(body, ' again') else body end) as body_sha from fx_doc_page""")
def force_write(v: Views):
    """Rebuild some pages of a partitioned store; the other keys of their partitions survive."""
    path = workspace(v.spark, "pages")
    pages = v.doc_page.select("doc_id", "page", "body", (F.col("doc_id") % 4).alias("part"))
    tables.incremental_write(pages, path, ("doc_id", "page"), partition_by=("part",))
    again = pages.filter("(doc_id * 3 + page) % 7 = 0").withColumn("body", F.concat("body", F.lit(" again")))
    store = tables.incremental_write(again, path, ("doc_id", "page"), partition_by=("part",), force=True)
    return store.select("doc_id", "page", "part", F.sha2("body", 256).alias("body_sha"))


_NAMED = "case doc_id % 5 when 0 then 'a:b' when 1 then 'p/q' when 2 then 'with space' when 3 then null else 'plain' end"


@query("invalidate_named", f"select doc_id, page, {_NAMED} as part from fx_doc_page where doc_id % 5 = 4 or (doc_id % 5 = 2 and doc_id % 2 = 0)")
def invalidate_named(v: Views):
    """Invalidation in partitions whose names need escaping, and in the null partition."""
    path = workspace(v.spark, "pages")
    pages = v.doc_page.select("doc_id", "page", F.expr(_NAMED).alias("part"))
    store = tables.incremental_write(pages, path, ("doc_id", "page"), partition_by=("part",))
    gone = v.table("documents").select("doc_id").filter("doc_id % 5 in (0, 1, 3) or (doc_id % 5 = 2 and doc_id % 2 = 1)")
    touched = store.join(gone, "doc_id", "left_semi").select("part")
    tables.rewrite_partitions(v.spark, path, B.invalidate(store, gone, ("doc_id",)), touched, "part")
    return tables.read_store(v.spark, path, store.schema)


def _with_errors(df):
    dense = F.length(text.squeeze_out(F.col("body")))
    why = F.when(dense < 60, F.concat(F.lit("body too short: "), F.repeat("body", 6)))
    return df.withColumn("key", F.concat_ws("-", "doc_id", "page")).withColumn("error", why)


_ERRORS = f"""
    select doc_id, page, concat(doc_id, '-', page) as key, substr(concat('body too short: ', repeat(body, 6)), 1, 300) as error
    from fx_doc_page where length({squeeze("body")}) < 60"""


@query("quarantine", f"select 'pages' as goal, key, error from ({_ERRORS})")
def quarantine(v: Views):
    _, bad = B.split_errors(_with_errors(v.doc_page), "pages", "key")
    return bad.drop("at")


@query("quarantine_rest", f"select doc_id, page from fx_doc_page where length({squeeze('body')}) >= 60")
def quarantine_rest(v: Views):
    good, _ = B.split_errors(_with_errors(v.doc_page), "pages", "key")
    return good.select("doc_id", "page")


@query("log_reconcile", f"""
    select 'pages' as goal, e.key, case when s.doc_id is not null then 'solved' else 'open' end as state
    from ({_ERRORS}) e left join fx_stored s on s.doc_id = e.doc_id and s.page = e.page""")
def log_reconcile(v: Views):
    _, bad = B.split_errors(_with_errors(v.doc_page), "pages", "key")
    return G.log_reconcile(bad, v.stored.select(F.concat_ws("-", "doc_id", "page").alias("key")))

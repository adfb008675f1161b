"""Queries over usage, samples, leaks and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators import audit as G
from pagewright.operators import usage as U
from pagewright.plans import inventory_queries
from pagewright.plans.registry import query
from pagewright.plans.sql_views import q
from pagewright.plans.views import Views

_MICRO = "(cast(tok_in - cached as decimal(18,0)) * 0.2000 + cast(tok_out as decimal(18,0)) * 1.2000 + cast(cached as decimal(18,0)) * 0.0200)"
_MEASURES = f"""count(*) as calls, cast(sum(tok_in - cached) as bigint) as input, cast(sum(tok_out) as bigint) as output,
      cast(sum(cached) as bigint) as cached, cast(sum({_MICRO}) as double) / 1000000 as usd"""
_FREE = "(cast(tok_in - cached as decimal(18,0)) * 0.2000 + cast(tok_out as decimal(18,0)) * 1.2000)"
_BUDGET = f"""
    select event_id, t, coalesce(sum({_FREE}) over (order by t, event_id rows between unbounded preceding and 1 preceding), 0) as before from fx_usage"""


@query("usage_cost", f"select {_MEASURES} from fx_usage")
def usage_cost(v: Views):
    return U.usage_cost(v.usage)


@query("cost_by_tag", f"select tag, {_MEASURES} from fx_usage group by 1")
def cost_by_tag(v: Views):
    return U.cost_by_tag(v.usage)


@query("today_scope", f"select {_MEASURES} from fx_usage where t >= timestamp '2024-01-05' and t < timestamp '2024-01-06'")
def today_scope(v: Views):
    return U.usage_cost(U.today_scope(v.usage, "2024-01-05"))


@query("project_remaining", """
    select total, done, greatest(0, total - done) as remaining, cast(greatest(0, total - done) * 3680.0000 as double) / 1000000 as usd
    from (select (select count(*) from fx_doc_page) as total, (select count(*) from fx_stored) as done)""")
def project_remaining(v: Views):
    return U.project_remaining(v.doc_page, v.stored)


@query("budget_cutoff", f"""
    select event_id, cast(before as double) / 1000000 as spent_before, before >= 400000 as blocked from ({_BUDGET})""")
def budget_cutoff(v: Views):
    return U.budget_cutoff(v.usage, "0.4").select("event_id", "spent_before", "blocked")


@query("first_blocked", f"""
    select (select event_id from ({_BUDGET}) where before >= 400000 order by t, event_id limit 1) as first_blocked,
      count(*) filter (before < 400000) as allowed, count(*) filter (before >= 400000) as blocked from ({_BUDGET})""")
def first_blocked(v: Views):
    return U.first_blocked(U.budget_cutoff(v.usage, "0.4"))


@query("stratified_sample", """
    select doc_id, source from (select doc_id, source, row_number() over (partition by source order by sha256(concat(doc_id, '|7')), doc_id) as rn from documents) where rn <= 3""")
def stratified_sample(v: Views):
    return G.stratified_sample(v.table("documents").select("doc_id", "source"), "source", "doc_id", 3, seed=7)


@query("dense_filter", """
    select doc_id, material_type from fx_doc_dim where doc_id % 17 = 1 or material_type in ('textbook', 'summary', 'subtext')""")
def dense_filter(v: Views):
    rotated = v.table("documents").select("doc_id").filter("doc_id % 17 = 1")
    kept = G.dense_filter(v.doc_dim, rotated, ("textbook", "summary", "subtext"), "doc_id")
    return kept.select("doc_id", "material_type")


# The rules once more, written for this dialect and not taken from the operator's list.
_LEAKS = r"""
    with docs as (select path, doc_id, concat(text, case doc_id % 7 when 1 then concat(chr(10), 'uses fileId here', chr(10), md5(doc_id::varchar))
        when 2 then concat(chr(10), md5(doc_id::varchar), ' is a fileId') else '' end) as content from fx_assets join documents using (doc_id)),
    hits as (
      select 'local-path' as rule, path, doc_id from docs where regexp_matches(content, '[A-Za-z]:\\(Users|dev)\\')
      union all select 'api-key', path, doc_id from docs where regexp_matches(content, '\b(sk-[A-Za-z0-9_-]{20}|gho_[A-Za-z0-9]{20}|AIza[A-Za-z0-9_-]{20})')
      union all select 'drive-id', path, doc_id from docs where len(list_filter(string_split(content, chr(10)),
        lambda x: regexp_matches(x, '\b[A-Za-z0-9_-]{28,44}\b.*(driveFileId|drive_file_id|fileId)'))) > 0
      union all select 'study-ext', path, doc_id from docs where regexp_matches(lower(path), '\.(pdf|mp3|m4a|xlsx|goodnotes)\b')
      union all select 'output-dir', path, doc_id from docs where split_part(path, '/', 1) in ('data', 'render', 'l1', 'l2', 'backups', 'logs') and contains(path, '/')
      union all select 'l1-content', path, doc_id from docs where regexp_matches(content, '(^|\n)---\r?\n([a-z_]+:[^\n]*\r?\n)*?sha:[ \t]*[0-9a-f]{16}\r?\n')
      union all select 'source-key', path, doc_id from docs where regexp_matches(content, 'source_key:[ \t]*[^ \t\r\n]+/[0-9]-[0-9]\.')
      union all select 'email', path, doc_id from docs where regexp_matches(content, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')
      union all select 'phone', path, doc_id from docs where regexp_matches(content, '\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}')
      union all select 'secret', path, doc_id from docs where regexp_matches(lower(content), '\b(token|secret|password|api_key) *= *"[0-9a-z_-]{20}'))
    select rule, path from hits where doc_id % 50 <> 0 and not (rule = 'email' and doc_id % 20 = 1)"""


def _hits(v: Views):
    d = F.col("doc_id")
    digest = F.md5(d.cast("string").cast("binary"))
    extra = (
        F.when(d % 7 == 1, F.concat(F.lit("\nuses fileId here\n"), digest))
        .when(d % 7 == 2, F.concat(F.lit("\n"), digest, F.lit(" is a fileId"))).otherwise("")
    )
    docs = v.assets.select("doc_id", "path").join(v.documents.select("doc_id", F.concat("text", extra).alias("content")), "doc_id")
    allow = v.assets.filter("doc_id % 50 = 0").select("path")
    by_rule = v.assets.filter("doc_id % 20 = 1").select("path", F.lit("email").alias("rule"))
    return G.leak_scan(docs, allow=allow, allow_by_rule=by_rule)


@query("leak_scan", _LEAKS)
def leak_scan(v: Views):
    return _hits(v)


@query("dedup_violations", f"select distinct rule, path from ({_LEAKS})")
def dedup_violations(v: Views):
    return G.dedup_violations(_hits(v).unionByName(_hits(v).filter("rule = 'email'")))


_BULK = "concat(case when doc_id % 3 = 0 then 'docs/' else 'notes/' end, doc_id, case when doc_id % 2 = 0 then '.MD' else '.txt' end)"


@query("bulk_gate", f"""
    select count(*) as files, min(path) as example, count(*) > 60 as violation from (select {_BULK} as path from documents)
    where path like 'notes/%.MD'""")
def bulk_gate(v: Views):
    d = F.col("doc_id")
    path = F.concat(F.when(d % 3 == 0, "docs/").otherwise("notes/"), d, F.when(d % 2 == 0, ".MD").otherwise(".txt"))
    return G.bulk_gate(v.table("documents").select(path.alias("path")))


def _report(v: Views):
    docs, labels = v.table("documents"), v.table("labels")
    keys = docs.agg((F.count(F.lit(1)) == F.count_distinct("doc_id")).alias("ok"), F.count(F.lit(1)).alias("detail"))
    covered = labels.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") == docs.agg(F.count(F.lit(1)).alias("n")).scalar()).alias("ok"), F.col("n").alias("detail")
    )
    absent = docs.filter("lang = 'xx'").agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") > 0, True).alias("ok"), F.lit("no such language").alias("detail")
    )
    return G.gate_report([
        G.named_checks(inventory_queries.inventory_gates(v)), G.check("document keys", keys), G.check("every document labelled", covered), G.check("language xx", absent),
    ])


_REPORT = f"""
    select name, case when ok is null then 'skip' when ok then 'pass' else 'fail' end as status, detail from (
      select name, passed as ok, cast(bad as varchar) as detail from ({inventory_queries.GATES})
      union all select 'document keys', count(*) = count(distinct doc_id), cast(count(*) as varchar) from documents
      union all select 'every document labelled', (select count(*) from labels) = count(*), cast((select count(*) from labels) as varchar) from documents
      union all select 'language xx', null, 'no such language')"""


@query("gate_report", _REPORT)
def gate_report(v: Views):
    return _report(v)


@query("gate_totals", f"""
    select count(*) as checks, count(*) filter (status = 'pass') as pass, count(*) filter (status = 'fail') as fail,
      count(*) filter (status = 'skip') as skip, count(*) filter (status = 'fail') > 0 as failed from ({_REPORT})""")
def gate_totals(v: Views):
    return G.gate_totals(_report(v))

"""Queries over emphasis markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import markup
from pagewright.operators import markup as E
from pagewright.plans.registry import query
from pagewright.plans.sql_views import fingerprint, mark_type, marks, priority, strip
from pagewright.plans.views import Views

KEYS = ("doc_id", "page")


def _regexp_counts(x: str) -> str:
    return ", ".join(
        f"len(regexp_extract_all({x}, '{p}')) as {n}"
        for n, p in (("color", V.COLOR_MARK), ("hl", V.HL_MARK), ("underline", V.UNDERLINE_MARK))
    )


@query("mark_types", f"select doc_id, page, seq, type, {mark_type('type')} as mark_type from fx_all_marks")
def mark_types(v: Views):
    rows = E.explode_marks(E.parse_instructions(v.good_instructions), KEYS)
    return rows.select(*KEYS, "seq", "type", markup.mark_type(F.col("type")).alias("mark_type"))


@query("strip_count", f"""
    select doc_id, page, sha256({strip("body")}) as stripped_sha, {_regexp_counts("body")}, {marks("body")} as total from fx_marked""")
def strip_count(v: Views):
    body = F.col("body")
    return v.marked.select(
        *KEYS, F.sha2(markup.strip_marks(body), 256).alias("stripped_sha"), markup.count_marks(body).alias("_c"),
        markup.total_marks(body).alias("total"),
    ).select(*KEYS, "stripped_sha", "_c.*", "total")


@query("fingerprint", f"select doc_id, page, {fingerprint('body')} as fp from fx_marked")
def fingerprint_query(v: Views):
    return E.fingerprints(v.marked, KEYS)


def _baseline(v: Views):
    return E.fingerprints(v.baseline_source, KEYS)


@query("baseline_diff", f"""
    with fresh as (select doc_id, page, {fingerprint("body")} as fp from fx_marked where (doc_id + page) % 9 <> 0)
    select coalesce(o.doc_id, n.doc_id) as doc_id, coalesce(o.page, n.page) as page,
      case when o.fp is null then 'added' when n.fp is null then 'removed' else 'changed' end as status
    from fx_baseline o full join fresh n on o.doc_id = n.doc_id and o.page = n.page where o.fp is distinct from n.fp""")
def baseline_diff(v: Views):
    fresh = E.fingerprints(v.marked.filter("(doc_id + page) % 9 <> 0"), KEYS)
    return E.baseline_diff(_baseline(v), fresh, KEYS)


@query("numbered_lines", """
    select doc_id, page, pos as line_no, string_split(base, chr(10))[pos] as line
    from (select *, unnest(range(1, len(string_split(base, chr(10))) + 1)) as pos from fx_base)""")
def numbered_lines(v: Views):
    return E.numbered_lines(v.marked, KEYS)


@query("clear_marks", f"select doc_id, page, sha256({strip('body')}) as body_sha, {marks(strip('body'))} as left_over from fx_marked")
def clear_marks(v: Views):
    clear = E.clear_marks(F.col("body"))
    return v.marked.select(*KEYS, clear.alias("body")).select(
        *KEYS, F.sha2("body", 256).alias("body_sha"), markup.total_marks(F.col("body")).alias("left_over")
    )


def _records(v: Views):
    return E.parse_instructions(v.instructions)


def _located(v: Views):
    return E.locate_marks(E.explode_marks(E.usable_instructions(_records(v), KEYS), KEYS), v.marked, KEYS)


_AT = " ".join(
    f"when contains(lines[line + {d}], text) and line + {d} >= 1 then line + {d}" for d in V.LINE_OFFSETS
)
_LOCATED = f"""
    select doc_id, page, seq, line, text, type, hit_line, strpos(lines[hit_line], text) - 1 as start,
      strpos(lines[hit_line], text) - 1 + length(text) as stop, coalesce({mark_type("type")}, 'color') as mark_type,
      case when hit_line is not null then null when trim(text) = '' then 'empty text'
        when len(list_filter(lines, lambda x: contains(x, text))) = 0 then 'not in the text'
        else concat('on line ', list_position(list_transform(lines, lambda x: contains(x, text)), true), ' instead') end as why
    from (select *, case when trim(text) = '' then null {_AT} end as hit_line from (
      select m.*, string_split(base, chr(10)) as lines from fx_marks m join fx_base b on b.doc_id = m.doc_id and b.page = m.page))"""


@query("locate_marks", f"select doc_id, page, seq, hit_line, start, stop, mark_type, why from ({_LOCATED})")
def locate_marks(v: Views):
    return _located(v).select(*KEYS, "seq", "hit_line", "start", "stop", "mark_type", "why")


# The greedy choice folded over each line's distinct spans, longest first.
_RESOLVED = f"""
    with located as (select *, row_number() over (partition by doc_id, page, hit_line, start, stop, mark_type order by seq) as nth from ({_LOCATED})),
    spans as (select doc_id, page, hit_line, start, stop, min(seq) as seq from located where hit_line is not null group by all),
    folded as (select doc_id, page, hit_line, list_reduce(
        list(struct_pack(done := [struct_pack(s := start, e := stop)], seq := 0) order by start - stop, seq),
        lambda a, b: struct_pack(done := case when len(list_filter(a.done, lambda x: x.s < b.done[1].e and x.e > b.done[1].s
          and not (b.done[1].s >= x.s and b.done[1].e <= x.e) and not (x.s >= b.done[1].s and x.e <= b.done[1].e))) > 0
          then a.done else list_concat(a.done, b.done) end, seq := 0)).done as done
      from spans group by all)
    select l.doc_id, l.page, l.seq, l.line, l.text, l.type, l.hit_line, l.start, l.stop, l.mark_type,
      case when why is not null then why when not list_contains(done, struct_pack(s := start, e := stop)) then 'partly overlaps another mark'
        when nth > 1 then 'duplicate' else 'applied' end as status
    from located l left join folded f on f.doc_id = l.doc_id and f.page = l.page and f.hit_line = l.hit_line"""


def _resolved(v: Views):
    return E.resolve_overlaps(_located(v), KEYS)


@query("resolve_overlaps", f"select doc_id, page, seq, status from ({_RESOLVED})")
def resolve_overlaps(v: Views):
    return _resolved(v).select(*KEYS, "seq", "status")


@query("failed_marks", f"""
    select doc_id, page, seq, line, substr(text, 1, 60) as text, type, status as why from ({_RESOLVED}) where status not in ('applied', 'duplicate')""")
def failed_marks(v: Views):
    return E.failed_marks(_resolved(v), KEYS)


# Every boundary becomes a token at a place of the line; the line is joined again from the
# pieces between the places.
_APPLIED = f"""
    with chosen as (select * from ({_RESOLVED}) where status = 'applied'),
    tokens as (
      select doc_id, page, hit_line, start as at_pos, 1 as phase, -stop as near, r as rank, o as token from chosen join kinds using (mark_type)
      union all select doc_id, page, hit_line, stop, 0, -start, -r, c from chosen join kinds using (mark_type)),
    places as (select doc_id, page, hit_line, at_pos, string_agg(token, '' order by phase, near, rank) as token from tokens group by all),
    cuts as (select *, coalesce(lag(at_pos) over (partition by doc_id, page, hit_line order by at_pos), 0) as prev,
      lead(at_pos) over (partition by doc_id, page, hit_line order by at_pos) is null as last from places),
    built as (select c.doc_id, c.page, hit_line, string_agg(concat(substr(lines[hit_line], prev + 1, at_pos - prev), token,
        case when last then substr(lines[hit_line], at_pos + 1) else '' end), '' order by at_pos) as line
      from cuts c join (select doc_id, page, string_split(base, chr(10)) as lines from fx_base) b on b.doc_id = c.doc_id and b.page = c.page group by all),
    every_line as (select b.doc_id, b.page, pos, coalesce(n.line, b.lines[pos]) as line, n.line is not null as marked
      from (select doc_id, page, string_split(base, chr(10)) as lines, unnest(range(1, len(string_split(base, chr(10))) + 1)) as pos from fx_base) b
      left join built n on n.doc_id = b.doc_id and n.page = b.page and n.hit_line = b.pos),
    joined as (select doc_id, page, string_agg(line, chr(10) order by pos) as text, bool_or(marked) as marked from every_line group by all),
    counts as (select doc_id, page, count(*) as n_marks from chosen group by all)
    select doc_id, page, p.body, case when marked then text else p.body end as new_body, coalesce(n_marks, 0) as n_marks
    from fx_marked p join joined using (doc_id, page) left join counts using (doc_id, page)"""
_APPLIED = _APPLIED.replace(
    "with chosen", "with kinds as (select unnest(['hl', 'underline', 'color']) as mark_type, unnest([1, 2, 3]) as r,"
    " unnest(['<mark>', '<u>', '**']) as o, unnest(['</mark>', '</u>', '**']) as c), chosen", 1)


@query("apply_marks", f"""
    select doc_id, page, sha256(new_body) as new_sha, n_marks, {strip("new_body")} = {strip("body")} as intact from ({_APPLIED})""")
def apply_marks(v: Views):
    out = E.apply_marks(v.marked, E.resolve_overlaps(_located(v).drop("text", "line", "type"), KEYS), KEYS)
    return out.select(*KEYS, F.sha2("new_body", 256).alias("new_sha"), "n_marks", "intact")


_STATUS = f"""
    with done as ({_APPLIED}), fails as (select doc_id, page, count(*) filter (status not in ('applied', 'duplicate')) as failed_marks,
      count(*) filter ({mark_type("type")} is null) as unknown_types from ({_RESOLVED}) group by all),
    sides as (select r.*, coalesce(n.n_marks, 0) as wanted, d.body, d.new_body, {strip("d.body")} as base, {strip("d.new_body")} as new_base,
        b.fp as want, coalesce(failed_marks, 0) as failed_marks, coalesce(unknown_types, 0) as unknown_types
      from fx_record r left join fx_n_marks n using (doc_id, page) left join (select * from done where (doc_id + page) % 14 <> 3) d using (doc_id, page)
      left join fx_baseline b using (doc_id, page) left join (select * from fails where (doc_id + page) % 14 <> 3) f using (doc_id, page))
    select *, case when bad_json then 'unreadable' when sha_off then 'sha mismatch' when page_off then 'page mismatch'
      when body is null then 'no page' when wanted = 0 and clear then case when base <> body then 'cleared' else 'unchanged' end
      when wanted = 0 and none is null then 'no marks and no reason' when wanted = 0 then 'none kept'
      when base <> new_base then 'text would change' when want <> substr(sha256(base), 1, 32) then 'text drifted'
      when new_body = body then 'unchanged' else 'written' end as status from sides"""


def _pages_with_text(v: Views):
    return v.marked.filter("(doc_id + page) % 14 <> 3")


@query("apply_status", f"""
    select doc_id, page, status, failed_marks, unknown_types,
      sha256(case status when 'written' then new_body when 'cleared' then base else body end) as new_sha from ({_STATUS})""")
def apply_status(v: Views):
    out = E.apply_status(_records(v), _pages_with_text(v), _baseline(v), KEYS)
    return out.select(*KEYS, "status", "failed_marks", "unknown_types", F.sha2("new_body", 256).alias("new_sha"))


@query("none_reasons", """
    select none as reason, count(*) as records from fx_record left join fx_n_marks using (doc_id, page)
    where not bad_json and not sha_off and not page_off and coalesce(n_marks, 0) = 0 and not clear group by 1""")
def none_reasons(v: Views):
    return E.none_reasons(_records(v), KEYS)


_STATE = f"""
    select s.doc_id, s.page, level <> 'none' as colored, r.doc_id is not null as recorded,
      coalesce(b.fp <> {fingerprint("m.body")}, false) as body_changed, ({marks("m.body")}) > 0 as has_mark,
      coalesce(bad_json, false) as bad_json, coalesce(n_marks, 0) as n, none, coalesce(clear, false) as clear
    from fx_rated s join fx_marked m using (doc_id, page) left join fx_record r using (doc_id, page)
    left join fx_n_marks using (doc_id, page) left join fx_baseline b using (doc_id, page)"""
_MARKED = "colored and recorded and not bad_json and has_mark"
_NONE = "colored and recorded and not bad_json and n = 0 and not has_mark"


def _state(v: Views):
    return E.review_state(v.scan, v.marked, _records(v), _baseline(v), KEYS)


@query("emphasis_gates", f"""
    select count(*) filter (body_changed) as body_changed, count(*) filter (recorded and not bad_json and n > 0 and not has_mark) as not_applied,
      count(*) filter (recorded and (bad_json or (n = 0 and none is null and not clear))) as bad_record,
      count(*) filter (colored) as colored, count(*) filter (colored and recorded) as colored_done,
      count(*) filter ({_MARKED}) as colored_marked, count(*) filter ({_NONE}) as colored_none,
      count(*) filter (not colored and recorded) as plain_done from ({_STATE})""")
def emphasis_gates(v: Views):
    return E.emphasis_gates(_state(v))


@query("none_heavy_docs", f"""
    select doc_id, none, reviewed from (select doc_id, count(*) filter ({_NONE}) as none, count(*) filter ({_NONE}) + count(*) filter ({_MARKED}) as reviewed
      from ({_STATE}) group by 1) where reviewed >= 3 and none * 4 >= reviewed""")
def none_heavy_docs(v: Views):
    return E.none_heavy_docs(_state(v), "doc_id", reviewed=3, share=0.25)


@query("scan_crosstab", f"""
    select level <> 'none' as colored, marked, count(*) as pages from fx_rated left join (
      select doc_id, page, ({marks("body")}) > 0 as marked from fx_marked where (doc_id + page) % 14 <> 3) using (doc_id, page) group by 1, 2""")
def scan_crosstab(v: Views):
    return E.scan_crosstab(v.scan, _pages_with_text(v), KEYS)


@query("missing_top", f"""
    select subject_key, material_type, count(*) as pages from fx_rated join fx_marked using (doc_id, page) join fx_doc_dim using (doc_id)
    where level <> 'none' and ({marks("body")}) = 0 group by 1, 2 order by pages desc, subject_key, material_type limit 25""")
def missing_top(v: Views):
    return E.missing_top(v.scan, v.marked, v.doc_dim, KEYS)


_PLACED = """
    select *, row_number() over (partition by doc_id order by page) - 1 as rn, count(*) over (partition by doc_id) as n from fx_rated"""
_SAMPLED = "n <= 3 or rn in (n // 6, n * 3 // 6, n * 5 // 6)"


@query("centre_sample", f"select doc_id, page from ({_PLACED}) where {_SAMPLED}")
def centre_sample(v: Views):
    return E.centre_sample(v.scan.filter("not is_err").select(*KEYS), "doc_id", "page")


@query("all_override", f"select doc_id, page from ({_PLACED}) where {_SAMPLED} or doc_id % 10 = 4")
def all_override(v: Views):
    rows = v.scan.filter("not is_err").select(*KEYS)
    full = v.table("documents").select("doc_id").filter("doc_id % 10 = 4")
    return E.all_override(rows, E.centre_sample(rows, "doc_id", "page"), full, "doc_id")


def _tier_sql(keep: str) -> str:
    return f"""
    select doc_id, page, subject_key, material_type, level, case level when 'none' then 'b' else 'a' end as tier,
      {priority("material_type", V.EMPHASIS_PRIORITY)} as priority
    from (select *, row_number() over (partition by doc_id, level = 'none' order by page) - 1 as rn, count(*) over (partition by doc_id, level = 'none') as n from fx_rated)
    join fx_doc_dim using (doc_id) anti join (select doc_id, page from fx_record) d using (doc_id, page)
    where ({keep}) and (doc_id + page) % 14 <> 3"""


_PLAIN = f"level = 'none' and ({_SAMPLED} or doc_id % 10 = 4)"


def _tier(v: Views, tier: str):
    full = v.table("documents").select("doc_id").filter("doc_id % 10 = 4")
    return E.tier_worklist(v.scan, v.doc_dim, v.instructions, _pages_with_text(v), full, tier, KEYS)


@query("tier_a", _tier_sql("level <> 'none'"))
def tier_a(v: Views):
    return _tier(v, "a")


@query("tier_b", _tier_sql(_PLAIN))
def tier_b(v: Views):
    return _tier(v, "b")


@query("tier_both", _tier_sql(f"level <> 'none' or {_PLAIN}"))
def tier_both(v: Views):
    return _tier(v, "both")


@query("worklist_rollup", f"select subject_key, count(*) as pages from ({_tier_sql(f'''level <> 'none' or {_PLAIN}''')}) group by rollup (subject_key)")
def worklist_rollup(v: Views):
    return E.worklist_rollup(_tier(v, "both"))

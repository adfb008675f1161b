"""The views of :mod:`pagewright.plans.views` as SQL text, and SQL fragments."""

from __future__ import annotations

import re

from pagewright import fixed_values as V
from pagewright.plans import views as D


def q(value: str) -> str:
    """SQL string literal; control characters become chr() calls."""
    parts = re.split(r"(\n)", value)
    lits = ["chr(10)" if p == "\n" else "'" + p.replace("'", "''") + "'" for p in parts if p]
    return " || ".join(lits) if lits else "''"


def lst(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def choose(values, index: str) -> str:
    return f"({lst(values)})[1 + cast({index} as int)]"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '[{V.WS}]+', '', 'g')"


def trim(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[{V.WS}]+\\z', ''), '^[{V.WS}]+', '')"


def rtrim(x: str) -> str:
    return f"regexp_replace({x}, '[{V.WS}]+\\z', '')"


def strip(x: str) -> str:
    out = x
    for _ in range(V.STRIP_ROUNDS):
        for pattern in (V.HL_MARK, V.UNDERLINE_MARK, V.COLOR_MARK):
            out = f"regexp_replace({out}, '{pattern}', '\\1', 'g')"
    return out


def marks(x: str) -> str:
    return " + ".join(
        f"len(regexp_extract_all({x}, '{p}'))" for p in (V.COLOR_MARK, V.HL_MARK, V.UNDERLINE_MARK)
    )


def fingerprint(x: str) -> str:
    return f"substr(sha256({strip(x)}), 1, {V.FINGERPRINT_HEX})"


def normalized(x: str) -> str:
    out = f"regexp_replace(regexp_replace({x}, '{V.FIGURE_TAG}', '', 'g'), '{V.UNREADABLE_TAG}', '', 'g')"
    return f"lower({squeeze(f'''regexp_replace({out}, {q(V.MARKUP_CHARS)}, '', 'g')''')})"


def shingle_source(x: str) -> str:
    out = x
    for pattern in (V.FIGURE_TAG, V.UNREADABLE_TAG, V.BREAK_TAG, V.MARKUP_CHARS):
        out = f"regexp_replace({out}, {q(pattern)}, ' ', 'g')"
    return f"lower({squeeze(out)})"


def head(x: str) -> str:
    return f"regexp_extract({x}, '{V.FRONT_MATTER}')"


def level(ink: str, hl: str) -> str:
    return (
        f"case when {ink} >= 3 or {hl} >= 2 then 'strong' when {ink} >= 1 or {hl} >= 1 then 'weak' else 'none' end"
    )


def priority(value: str, order) -> str:
    return f"coalesce(nullif(list_position({lst(order)}, {value}), 0), {len(order) + 1})"


def ratio(part: str, whole: str, scale: int) -> str:
    return f"((cast({part} as bigint) * {2 * scale} + ({whole})) // nullif(({whole}) * 2, 0))"


def mark_type(x: str) -> str:
    cases = " ".join(f"when {q(k)} then {q(v)}" for k, v in V.MARK_ALIASES.items())
    return f"(case lower(trim({x})) {cases} end)"


EXT = r"lower(regexp_extract(filename, '^.+(\.[^.]*)$', 1))"
MATERIAL = choose(D.MATERIALS, "(doc_id // 5) % 8")

NUMBER = "((page - 1) * 5 + i)"      # 1-based line number of the document, i 1-based in the page
_WORD = "string_split(line, ' ')[1]"

VIEWS: dict[str, str] = {
    "fx_line": """
        select doc_id, pos as line_no, string_split(text, chr(10))[pos] as line, cast((pos - 1) // 5 + 1 as int) as page
        from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as pos from documents)""",
    "fx_doc_page": """
        select doc_id, page, string_agg(line, chr(10) order by line_no) as body from fx_line group by doc_id, page""",
    "fx_assets": f"""
        select doc_id, concat(source, '/', lang, '/', lpad(cast(doc_id as varchar), 8, '0'),
               {choose(D.EXTENSIONS, "doc_id % 6")}) as path,
               substr(sha256(text), 1, 16) as content_sha, strlen(text) as size_bytes,
               cast((len(string_split(text, chr(10))) - 1) // 5 + 1 as int) as pages
        from documents""",
    "fx_subjects": """
        select n_nationkey as ord, concat('src', n_nationkey) as folder, lower(n_name) as key, n_regionkey as area,
               10 + n_nationkey % 5 as quota, n_regionkey + 1 as session
        from nation""",
    "fx_fields": f"""
        select a.*, concat(coalesce(s.key, '_root'), '/', a.path) as source_key, s.folder as subject_folder,
               coalesce(s.key, '_root') as subject_key, coalesce(s.area, 0) as area,
               coalesce(s.quota, 0) as exam_questions, string_split(a.path, '/')[-2] as category,
               string_split(a.path, '/')[-1] as filename, {EXT.replace('filename', "string_split(a.path, '/')[-1]")} as ext
        from fx_assets a left join fx_subjects s on string_split(a.path, '/')[1] = s.folder""",
    "fx_dups": """
        select doc_id, path, a.content_sha, a.size_bytes, case when no is not null then printf('dup%03d', no) end as dup_group,
               coalesce(path = first_path, true) as is_primary
        from fx_assets a left join (
            select content_sha, size_bytes, min(path) as first_path, row_number() over (order by min(path)) - 1 as no
            from fx_assets group by 1, 2 having count(*) >= 2) g
        on a.content_sha = g.content_sha and a.size_bytes = g.size_bytes""",
    "fx_manifest": f"""
        select f.*, {MATERIAL} as material_type, case when doc_id % 3 = 0 then 'CLEAN' else 'SCAN' end as text_layer,
               case when ext = '.pdf' then case when doc_id % 3 = 0 then 'pdftotext' else 'vision' end
                    when ext = '.csv' then 'direct-csv' when ext in ('.xlsx', '.xls') then 'xls-ole2'
                    when ext in ('.mp3', '.m4a') then 'audio-defer' when ext = '.zip' then 'goodnotes-defer'
                    else 'manual' end as extract_route, dup_group, is_primary
        from fx_fields f join (select doc_id, dup_group, is_primary from fx_dups) using (doc_id)""",
    "fx_doc_dim": f"""
        select doc_id, concat('s', doc_id % 15) as subject_key, {MATERIAL} as material_type from documents""",
    "fx_stored": "select doc_id, page, body from fx_doc_page where (doc_id * 7 + page) % 5 <> 0",
    "fx_expected": f"""
        select doc_id, path, pages, concat('s', doc_id % 15) as subject_key, {MATERIAL} as material_type,
               regexp_extract(path, '(\\.[a-z0-9]+)$', 1) as ext from fx_assets""",
    "fx_page_md": """
        select doc_id, page, lpad(cast(doc_id as varchar), 16, '0') as sha,
          concat('---', chr(10), 'sha: ', lpad(cast(case when doc_id % 11 = 3 then doc_id + 1 else doc_id end as varchar), 16, '0'), chr(10),
            'page: ', cast(case when doc_id % 13 = 4 then page + 1 else page end as varchar), chr(10),
            case when doc_id % 17 = 5 then '' else concat('subject_key: s', cast(doc_id % 15 as varchar), chr(10)) end,
            'source_key: k', cast(doc_id as varchar), chr(10), '---', chr(10),
            case when doc_id % 19 = 6 then chr(10) when doc_id % 19 = 7 then concat('C. 표', chr(10)) else '' end,
            case when doc_id % 23 = 8 then 'Sorry, this page cannot be read and nothing was written down here.' else body end) as md
        from fx_doc_page""",
    "fx_marked": """
        select doc_id, page, case (doc_id + page) % 4 when 0 then body when 1 then concat('**key** ', body)
          when 2 then concat('<mark>**key**</mark> ', body) else concat('<u>key</u> <mark>open ', body) end as body
        from fx_doc_page""",
    "fx_baseline": f"""
        select doc_id, page, {fingerprint("body")} as fp from (
          select doc_id, page, case when doc_id % 7 = 2 then concat(body, ' x') else body end as body
          from fx_marked where (doc_id + page) % 10 <> 0)""",
    "fx_base": f"select doc_id, page, body, {strip('body')} as base from fx_marked",
    # Instruction records, already taken apart; the Spark side reads them from JSON text.
    "fx_record": f"""
        select doc_id, page, doc_id % 41 = 9 as bad_json, doc_id % 31 = 7 as sha_off, doc_id % 37 = 8 as page_off,
               case when (doc_id + page) % 6 = 3 then {choose(("no-emphasis", "figure-only", "header-only"), "doc_id % 3")} end as none,
               (doc_id + page) % 6 = 4 as clear
        from fx_doc_page where (doc_id + page) % 8 <> 7""",
    "fx_all_marks": f"""
        select doc_id, page, cast(row_number() over (partition by doc_id, page order by i) - 1 as int) as seq, line, text, type from (
          select doc_id, page, i, cast(i + {lst((0, 1, -2, 4))}[1 + (doc_id + {NUMBER}) % 4] as int) as line,
            case when (doc_id + {NUMBER}) % 7 = 0 then 'zzz not present'
                 when (doc_id + {NUMBER}) % 5 = 0 then substr(line, 1, 12)
                 when (doc_id + {NUMBER}) % 5 = 1 then substr(line, 6, 12) else {_WORD} end as text,
            {lst(D.MARK_TYPES)}[1 + {NUMBER} % 5] as type
          from (select doc_id, page, line, line_no - (page - 1) * 5 as i from fx_line)
          where {_WORD} <> '' and (doc_id + {NUMBER}) % 3 <> 0 and (doc_id + page) % 6 < 3 and (doc_id + page) % 8 <> 7)""",
    "fx_marks": """
        select m.* from fx_all_marks m join fx_record r using (doc_id, page)
        where not bad_json and not sha_off and not page_off""",
    "fx_n_marks": "select doc_id, page, count(*) as n_marks from fx_all_marks group by 1, 2",
    "fx_scan": """
        select doc_id, page, greatest((doc_id * 5 + page * 3) % 7 - 4, 0) as text_ink,
               greatest((doc_id + page * 2) % 3 - 1, 0) as text_hl, (doc_id + page) % 29 = 0 as is_err from fx_doc_page""",
    "fx_rated": f"select *, {level('text_ink', 'text_hl')} as level from fx_scan where not is_err",
    "fx_pair": """
        select doc_id, text as truth, case doc_id % 4 when 0 then text when 1 then substr(text, 1, (length(text) * 4) // 5)
          when 2 then concat(text, ' ', (select min(text) from benchmark)) else '' end as got from documents""",
    "fx_word_box": """
        select doc_id, page, seq, len(w) as n_chars,
          case when doc_id % 17 = 1 then 10 else 6 * len(w) end as w, case when doc_id % 17 = 1 then 6 * len(w) else 10 end as h,
          case when doc_id % 17 = 1 then (case when doc_id % 2 = 0 then 14 * seq else 4000 - 14 * seq end) else 14 * (seq // 8) end as y
        from (select doc_id, page, i as seq, string_split(replace(body, chr(10), ' '), ' ')[i] as w
          from (select doc_id, page, body, unnest(range(1, len(string_split(replace(body, chr(10), ' '), ' ')) + 1)) as i from fx_doc_page))
        where len(w) >= 2""",
    "fx_value": """
        select vec_id, cast(vec_id // 80 as int) as page, cast(vec_id % 80 as int) as y, i,
               cast(floor(abs(cast(embedding[i + 1] as double)) * 1000) as int) as v
        from (select vec_id, embedding, unnest(range(0, 64)) as i from embeddings)""",
    "fx_pixel": """
        select page, x, y,
               cast(coalesce(base, case when bright then 205 + v * 7 % 45 when colored then 120 + v * 7 % 80 else v % 256 end) as int) as r,
               cast(coalesce(base, case when bright then 95 + v * 3 % 40 when colored then v * 3 % 120 else v % 256 end) as int) as g,
               cast(coalesce(base, case when bright then 95 + v * 5 % 50 when colored then v * 5 % 100 + page % 3 * 50 else v % 256 end) as int) as b
        from (select *, case when y % 40 = 38 then case when x >= vec_id % 7 and x < vec_id % 7 + 44 + vec_id % 9 then 20 else 250 end
                             when y % 40 >= 34 then 250 end as base,
                     (y // 8 + (x // 8) * 2 + page) % 5 < 2 and ((x // 8) * 3 + (y // 8) * 2 + page) % 4 <> 0 as colored,
                     (x // 24 + y // 24) % 3 = page % 3 and (x // 8 + (y // 8) * 2 + page) % 4 < 3 as bright
              from (select vec_id, page, y, v, cast(i * 2 + half as int) as x from fx_value, unnest([0, 1]) t(half)))""",
    "fx_size": """
        select cast(vec_id // 80 as int) as page, cast(max(vec_id % 80) + 1 as int) as height, 128 as width from embeddings group by 1""",
    "fx_kind": """
        select *, case when mx < 110 then 'dark' when case when mx = 0 then 0 else (mx - mn) / cast(mx as double) end < 0.28 then 'none'
                 when mx < 200 then 'ink' when mn > 90 then 'hl' else 'none' end as kind
        from (select *, greatest(r, g, b) as mx, least(r, g, b) as mn from fx_pixel)""",
    "fx_hist": """
        select page, x // 8 as cx, y // 8 as cy, count(*) filter (kind = 'ink') as ink, count(*) filter (kind = 'hl') as hl,
               count(*) filter (kind = 'dark') as dark, coalesce(sum(r) filter (kind = 'ink'), 0) as r_sum,
               coalesce(sum(g) filter (kind = 'ink'), 0) as g_sum, coalesce(sum(b) filter (kind = 'ink'), 0) as b_sum
        from fx_kind where kind <> 'none' group by 1, 2, 3""",
    "fx_cell": """
        select vec_id as page, i % 8 as cx, i // 8 as cy, cast(floor(abs(cast(embedding[i + 1] as double)) * 100) as int) as px
        from (select vec_id, embedding, unnest(range(0, 64)) as i from embeddings)""",
    "fx_usage": """
        select event_id, ts as t, event_type as tag, cast(floor(value * 10) as bigint) as tok_in, cast(floor(value) as bigint) as tok_out,
               least(cast(json_extract_string(props, '$.k') as bigint), cast(floor(value * 10) as bigint)) as cached, user_id from events""",
    "fx_items": """
        select doc_id, page, cast(71 + doc_id % 7 as int) as exam_round, cast(1 + (doc_id // 7) % 4 as int) as session,
               cast(line_no - (page - 1) * 5 - 1 as int) as pos, cast((doc_id * 31 + line_no - 1) % 120 + 1 as int) as number,
               line as stem, list_slice(string_split(line, ' '), 1, 5) as options,
               (doc_id + line_no - (page - 1) * 5 - 1) % 9 = 4 as figure_withheld
        from fx_line""",
    "fx_first": """
        select * exclude (rn) from (
          select *, concat_ws('-', exam_round, session, number) as id,
                 row_number() over (partition by exam_round, session, number order by doc_id, page, pos) as rn from fx_items) where rn = 1""",
    "fx_answers": f"""
        select id, answer, area_label from (
          select concat_ws('-', 71 + l_orderkey % 7, 1 + (l_orderkey // 7) % 4, 1 + l_partkey % 120) as id,
                 cast(l_quantity as bigint) % 7 as answer, {choose(D.AREA_LABELS, "l_suppkey % 6")} as area_label,
                 row_number() over (partition by concat_ws('-', 71 + l_orderkey % 7, 1 + (l_orderkey // 7) % 4, 1 + l_partkey % 120)
                   order by {", ".join(c + " desc" for c in D.ANSWER_ORDER)}) as rn from lineitem) where rn = 1""",
    "fx_ranges": """
        select *, cast(sum(quota) over (partition by session order by ord rows unbounded preceding) as bigint) as n_to,
               cast(sum(quota) over (partition by session order by ord rows unbounded preceding) - quota + 1 as bigint) as n_from from fx_subjects""",
    "fx_questions": """
        select f.*, r.key as subject_key, r.area, 1949 + f.exam_round as exam_year, a.answer, a.area_label
        from fx_first f left join fx_ranges r on r.session = f.session and f.number between r.n_from and r.n_to
        left join fx_answers a on a.id = f.id""",
    "fx_entries": """
        select e.*, ord as subject_order, folder as subject_name, area, quota as exam_questions, session
        from fx_all_entries e join fx_subjects on key = subject_key""",
    "fx_all_entries": f"""
        select concat('nation_', conv_id % 13) as subject_key, conv_id, turn, 'sources' as kind, 0 as pos,
               concat('{{"type":"', {choose(D.MATERIALS, "(conv_id // 5) % 8")}, '","source_key":"talk/', conv_id, '/', turn, '","sha":"', sha256(text), '"}}') as entry
        from conversations
        union all
        select concat('nation_', conv_id % 13), conv_id, turn, 'recommended_materials', pos - 1, string_split(lines[pos], ' ')[1]
        from (select *, unnest(range(1, len(lines) + 1)) as pos from (select *, string_split(text, chr(10)) as lines from conversations
              where role = 'user' and turn % 4 = 2))
        union all
        select subject_key, conv_id, turn, kind, pos, entry from (
          select concat('nation_', conv_id % 13) as subject_key, conv_id, turn, pos - 1 as pos,
                 case role when 'user' then 'study_order' when 'assistant' then 'unit_priority' else 'notes' end as kind,
                 case role when 'assistant' then concat('{{"unit":', to_json(substr(lines[pos], 1, 10)), ',"rank":', pos, '}}') else lines[pos] end as entry
          from (select *, unnest(range(1, len(lines) + 1)) as pos from (select *, string_split(text, chr(10)) as lines from conversations
                where not (role = 'assistant' and conv_id % 13 = 5))))""",
}


def with_views(sql: str) -> str:
    """The statement with the views it names, and the ones those name, as a WITH clause."""
    ordered: list[str] = []

    def need(body: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", body) and name not in ordered:
                need(VIEWS[name])
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    recursive = "recursive " if "/*recursive*/" in sql else ""
    body = sql.strip().replace("/*recursive*/", "")
    clauses = ", ".join(f"{name} as ({VIEWS[name].strip()})" for name in ordered)
    if body.lower().startswith("with "):
        return f"with {recursive}{clauses}, {body[5:]}"
    return f"with {recursive}{clauses} {body}"

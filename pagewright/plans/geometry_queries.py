"""Queries over pixels, cells and word boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import imaging
from pagewright.operators import geometry as X
from pagewright.plans.registry import query
from pagewright.plans.sql_views import level
from pagewright.plans.views import Views
from pagewright.session import durable


@query("pixel_class", "select page, kind, count(*) as px, cast(sum(x * 1000 + y) as bigint) as places from fx_kind group by 1, 2")
def pixel_class(v: Views):
    kind = imaging.pixel_class(F.col("r"), F.col("g"), F.col("b"))
    return v.pixels.groupBy("page", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("px"), F.sum(F.col("x") * 1000 + F.col("y")).alias("places")
    )


@query("cell_histogram", """
    select page, cx, cy, ink, hl, dark, cast(r_sum as bigint) as r_sum, cast(g_sum as bigint) as g_sum, cast(b_sum as bigint) as b_sum from fx_hist""")
def cell_histogram(v: Views):
    return X.cell_histogram(v.pixels)


@query("page_histogram", """
    select page, cast(sum(ink) as bigint) as ink_px, cast(sum(hl) as bigint) as hl_px, cast(sum(dark) as bigint) as dark_px from fx_hist group by 1""")
def page_histogram(v: Views):
    return X.page_histogram(X.cell_histogram(v.pixels))


def _components(source: str, amount: str, least: int) -> str:
    """Cells of each component: every cell takes the smallest label that reaches it."""
    return f"""
      (with recursive active as (select * from {source} where {amount} >= {least}),
       reach(page, cx, cy, label) as (
         select page, cx, cy, cy * 100000 + cx from active
         union select a.page, a.cx, a.cy, r.label from reach r join active a on a.page = r.page and abs(a.cx - r.cx) <= 1
           and abs(a.cy - r.cy) <= 1 and r.label < a.cy * 100000 + a.cx)
       select a.*, label from active a join (select page, cx, cy, min(label) as label from reach group by all) using (page, cx, cy))"""


def _boxes(source: str, amount: str, least: int, box: int, extra: str = "") -> str:
    return f"""
      select page, min(cx) * 8 as x, min(cy) * 8 as y, (max(cx) - min(cx) + 1) * 8 as w, (max(cy) - min(cy) + 1) * 8 as h,
        cast(sum({amount}) as bigint) as px {extra} from {_components(source, amount, least)} group by page, label having sum({amount}) >= {box}"""


_MEANS = ", ".join(f"floor(sum({c}_sum) / sum(ink) + 0.5) as {c}" for c in "rgb")
_INK = f"""
    select page, x, y, w, h, px, case when greatest(r, g, b) - least(r, g, b) < 30 then 'gray'
      when r = greatest(r, g, b) then case when g > least(r, g, b) + (greatest(r, g, b) - least(r, g, b)) * cast(0.55 as double) then 'orange'
        when b > g + 25 then 'pink' else 'red' end
      when g = greatest(r, g, b) then 'green' when b > 150 and r > 110 then 'purple' else 'blue' end as hue
    from ({_boxes("fx_hist", "ink", V.INK_CELL, V.INK_BOX, ", " + _MEANS)})"""
_HL = _boxes("fx_hist", "hl", V.HL_CELL, V.HL_BOX)


def _ink(v: Views):
    return X.ink_boxes(X.cell_histogram(v.pixels))


@query("ink_boxes", _INK)
def ink_boxes(v: Views):
    return _ink(v)


@query("hl_boxes", _HL)
def hl_boxes(v: Views):
    return X.hl_boxes(X.cell_histogram(v.pixels))


@query("vector_boxes", _boxes("fx_cell", "px", 18, 40))
def vector_boxes(v: Views):
    return X.component_boxes(v.cells, "px", 18, 40)


_SHAPED = "h >= 10 and h <= 64 and w * 10 >= h * 6 and px >= 60"


@query("page_levels", f"""
    select page, n_ink, n_hl, text_ink, text_hl, {level("text_ink", "text_hl")} as level from (
      select page, count(*) filter (ink) as n_ink, count(*) filter (not ink) as n_hl, count(*) filter (ink and {_SHAPED}) as text_ink,
        count(*) filter (not ink and {_SHAPED}) as text_hl
      from fx_size left join (select page, w, h, px, true as ink from ({_INK}) union all select page, w, h, px, false from ({_HL})) using (page) group by 1)""")
def page_levels(v: Views):
    cells = durable(X.cell_histogram(v.pixels))
    return X.page_levels(v.page_sizes, X.ink_boxes(cells), X.hl_boxes(cells))


@query("hue_totals", f"""
    select page, hue, cast(sum(px) as bigint) as px from (
      select *, row_number() over (partition by page order by px desc, y, x, w, h, hue) as rn from ({_INK})) where rn <= 40 group by 1, 2""")
def hue_totals(v: Views):
    return X.hue_totals(_ink(v))


@query("underline_hints", """
    with dark as (select page, x, y from fx_pixel where greatest(r, g, b) < 130),
    runs as (select page, y, min(x) as x, count(*) as len from (
      select *, x - row_number() over (partition by page, y order by x) as island from dark) group by page, y, island),
    fit as (select r.*, x + len // 2 as mid from runs r join fx_size using (page)
      where y >= 2 and y < height - 6 and len >= 45 and len <= round(width * 0.6)),
    thin as (select * from fit f where not exists (select 1 from dark d where d.page = f.page and d.x = f.mid and d.y = f.y - 1)
      and (select count(*) from dark d where d.page = f.page and d.x = f.mid and d.y between f.y + 1 and f.y + 4) < 4)
    select t.page, t.x, t.y, t.len from thin t join dark d on d.page = t.page and d.y between t.y - 34 and t.y - 4
      and d.x >= t.x and d.x < t.x + t.len and (d.x - t.x) % 3 = 0 group by all having count(distinct d.y) >= 8""")
def underline_hints(v: Views):
    return X.underline_hints(v.pixels, v.page_sizes)


@query("ink_map", """
    select page, x, y, case when keep then r else gray end as r, case when keep then g else gray end as g, case when keep then b else gray end as b
    from (select *, (mx >= 60 and (mx - mn) / cast(mx as double) >= 0.28) as keep, cast(200 + floor(mx / 255.0 * 55 + 0.5) as int) as gray from fx_kind)""")
def ink_map(v: Views):
    return X.ink_map(v.pixels)


@query("rotate_coords", """
    select page, case page % 4 when 1 then height - 1 - y when 2 then width - 1 - x when 3 then y else x end as x,
      case page % 4 when 1 then x when 2 then height - 1 - y when 3 then width - 1 - x else y end as y, r, g, b from fx_pixel join fx_size using (page)""")
def rotate_coords(v: Views):
    return X.rotate_coords(v.pixels, v.page_sizes, F.col("page") % 4 * 90)


_TURNS = """
    select doc_id, page, words, case when words < 15 then 0 when tall * 10 < words * 7 then 0 when down >= up then 270 else 90 end as degrees
    from (select doc_id, page, count(*) as words, count(*) filter (h > w) as tall, count(*) filter (dy >= 1) as down, count(*) filter (dy <= -1) as up
      from (select *, y - lag(y) over (partition by doc_id, page order by seq) as dy from fx_word_box) group by 1, 2)"""
_DOC_TURNS = f"""
    select doc_id, degrees from (select *, row_number() over (partition by doc_id order by n desc, first) as rn from (
      select doc_id, coalesce(degrees, 0) as degrees, count(*) as n, min(page) as first from (
        select distinct doc_id, cast(1 + (2 * i * (pages - 1) + greatest(1, least(3, pages) - 1)) // (2 * greatest(1, least(3, pages) - 1)) as int) as page
        from (select doc_id, pages, unnest(range(0, least(3, pages))) as i from fx_assets)) left join ({_TURNS}) using (doc_id, page) group by 1, 2)) where rn = 1"""


@query("page_rotation", _TURNS)
def page_rotation(v: Views):
    return X.page_rotation(v.word_box)


def _turned(v: Views):
    return X.doc_rotation(v.assets.select("doc_id", "pages"), X.page_rotation(v.word_box))


@query("doc_rotation", _DOC_TURNS)
def doc_rotation(v: Views):
    return _turned(v)


def _docs(v: Views):
    return v.assets.select("doc_id", "pages").join(v.doc_dim, "doc_id")


@query("rotation_audit", f"""
    select subject_key, count(*) as docs, cast(coalesce(sum(pages), 0) as bigint) as pages from ({_DOC_TURNS}) join fx_assets using (doc_id)
    join fx_doc_dim using (doc_id) where degrees <> 0 group by rollup (subject_key)""")
def rotation_audit(v: Views):
    return X.rotation_audit(_docs(v), _turned(v))


@query("rotated_top", f"""
    select doc_id, pages, degrees from ({_DOC_TURNS}) join fx_assets using (doc_id) where degrees <> 0 order by pages desc, doc_id limit 20""")
def rotated_top(v: Views):
    return X.rotated_top(_docs(v), _turned(v)).select("doc_id", "pages", "degrees")

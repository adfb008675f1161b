"""Queries comparing candidate texts with truth texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import text
from pagewright.operators import fidelity as D
from pagewright.plans.registry import query
from pagewright.plans.sql_views import normalized, ratio, shingle_source
from pagewright.plans.views import Views

_GRAMS = "list_distinct(list_transform(range(1, len({s}) - 1), lambda i: {s}[i] || {s}[i + 1] || {s}[i + 2]))"
_SIZES = f"""
    select doc_id, truth_len, got_len, truth_tokens, got_tokens, hits, t, g,
      coalesce({ratio("hits", "truth_tokens", 10000)}, 10000) as recall,
      case when truth_tokens = 0 then case when got_tokens = 0 then 10000 else 0 end when got_tokens = 0 then 0
        else {ratio("hits", "got_tokens", 10000)} end as precision
    from (select *, len(t) as truth_tokens, len(g) as got_tokens, len(list_intersect(t, g)) as hits from (
      select doc_id, truth_len, got_len, {_GRAMS.format(s="a")} as t, {_GRAMS.format(s="b")} as g from (
        select doc_id, string_split({shingle_source("truth")}, '') as a, string_split({shingle_source("got")}, '') as b,
          length({normalized("truth")}) as truth_len, length({normalized("got")}) as got_len from fx_pair)))"""


@query("normalize_text", f"select doc_id, length({normalized('text')}) as n, sha256({normalized('text')}) as text_sha from documents")
def normalize_text(v: Views):
    clean = v.documents.select("doc_id", text.normalize_text(F.col("text")).alias("t"))
    return clean.select("doc_id", F.length("t").alias("n"), F.sha2("t", 256).alias("text_sha"))


@query("shingles", f"""
    select doc_id, n_chars, len(g) as n_grams, sha256(array_to_string(list_sort(g), ' ')) as grams_sha from (
      select doc_id, len(s) as n_chars, {_GRAMS.format(s="s")} as g from (select doc_id, string_split({shingle_source("text")}, '') as s from documents))""")
def shingles(v: Views):
    grams = v.documents.select(
        "doc_id", F.length(text.shingle_source(F.col("text"))).alias("n_chars"), text.shingles(F.col("text")).alias("_g")
    )
    joined = F.array_join(F.array_sort("_g"), " ")
    return grams.select("doc_id", "n_chars", F.size("_g").alias("n_grams"), F.sha2(joined, 256).alias("grams_sha"))


def _rated(v: Views, missed: bool = False):
    return D.fidelity(v.pair, missed=missed)


@query("fidelity", f"select * exclude (t, g) from ({_SIZES})")
def fidelity(v: Views):
    return _rated(v)


@query("fidelity_exploded", f"select doc_id, truth_tokens, got_tokens, hits, recall, precision from ({_SIZES})")
def fidelity_exploded(v: Views):
    return D.fidelity_exploded(v.pair, ["doc_id"])


@query("worst_k", f"select doc_id, recall, precision from ({_SIZES}) where truth_len >= 100 order by recall, doc_id limit 6")
def worst_k(v: Views):
    return D.worst_k(_rated(v), "doc_id").select("doc_id", "recall", "precision")


@query("fidelity_stats", f"""
    with usable as (select recall, precision from ({_SIZES}) where truth_len >= 100),
    long as (select 'recall' as metric, recall as value from usable union all select 'precision', precision from usable),
    ranked as (select metric, value, row_number() over (partition by metric order by value) - 1 as rn, count(*) over (partition by metric) as n from long)
    select metric, case when rn = n // 2 then 'median' end as stat, cast(value as double) as value from ranked where rn = n // 2
    union all select metric, 'p10', cast(value as double) from ranked where rn = n // 10
    union all select metric, 'mean', avg(value) from long group by 1""")
def fidelity_stats(v: Views):
    return D.fidelity_stats(_rated(v))


@query("recall_gate", f"""
    with rated as (select *, case when truth_tokens = 0 then 1.0::double else hits::double / truth_tokens end as share from ({_SIZES}) where truth_len >= 100)
    select usable, low_rows, floor(m * 10000 + 0.5) as median_recall, m >= 0.85::double as passed from (
      select count(*) as usable, count(*) filter (hits * 20 < truth_tokens * 17) as low_rows,
        (select share from rated order by share limit 1 offset (select count(*) // 2 from rated)) as m from rated)""")
def recall_gate(v: Views):
    return D.recall_gate(_rated(v))


@query("low_recall_rows", f"select doc_id, recall from ({_SIZES}) where truth_len >= 100 and hits * 20 < truth_tokens * 17")
def low_recall_rows(v: Views):
    return D.low_recall_rows(_rated(v)).select("doc_id", "recall")


@query("missed_shingles", f"""
    with miss as (select doc_id, [x for x in t if not list_contains(g, x)] as m, a from (select doc_id, t, g, a from ({_SIZES}) join
      (select doc_id, {shingle_source("truth")} as a from fx_pair) using (doc_id) where recall < 10000)),
    placed as (select doc_id, x, strpos(a, x) as place from (select doc_id, a, unnest(m) as x from miss))
    select doc_id, string_agg(x, ' ' order by place) as missed from (select *, row_number() over (partition by doc_id order by place) as rn from placed) where rn <= 12 group by 1""")
def missed_shingles(v: Views):
    rows = _rated(v, missed=True).filter(F.size("missed") > 0)
    return rows.select("doc_id", F.array_join("missed", " ").alias("missed"))


# A candidate page differs from its truth in the middle: letters put in, taken out, replaced or turned round. Letters beyond ASCII
# stand as one sign each, as one engine counts steps in bytes.
_EDITED = """
    select doc_id, page, t as truth, case (doc_id + page) % 5 when 0 then t
      when 1 then concat(substr(t, 1, m), 'qz', substr(t, m + 1)) when 2 then concat(substr(t, 1, m), substr(t, m + 4))
      when 3 then concat(substr(t, 1, m), translate(substr(t, m + 1, 20), 'aeiou', 'eioua'), substr(t, m + 21))
      else concat(substr(t, 1, m), reverse(substr(t, m + 1, 30)), 'k', substr(t, m + 31)) end as got
    from (select doc_id, page, t, length(t) // 2 as m from (select doc_id, page, regexp_replace(body, '[^ -~\\n]', '~', 'g') as t from fx_doc_page))"""
_DISTANCE = f"""
    select doc_id, page, length(a) as truth_len, levenshtein(a, b) as distance from (
      select doc_id, page, {normalized("truth")} as a, {normalized("got")} as b from ({_EDITED}))"""


def _edited(v: Views):
    t, m = F.col("truth"), F.col("_m")
    plain = text.pinned(v.doc_page, truth=F.regexp_replace("body", r"[^ -~\n]", "~"))
    got = (
        F.when((F.col("doc_id") + F.col("page")) % 5 == 0, t)
        .when((F.col("doc_id") + F.col("page")) % 5 == 1, F.concat(F.substr(t, F.lit(1), m), F.lit("qz"), F.substr(t, m + 1)))
        .when((F.col("doc_id") + F.col("page")) % 5 == 2, F.concat(F.substr(t, F.lit(1), m), F.substr(t, m + 4)))
        .when((F.col("doc_id") + F.col("page")) % 5 == 3, F.concat(
            F.substr(t, F.lit(1), m), F.translate(F.substr(t, m + 1, F.lit(20)), "aeiou", "eioua"), F.substr(t, m + 21)))
        .otherwise(F.concat(F.substr(t, F.lit(1), m), F.reverse(F.substr(t, m + 1, F.lit(30))), F.lit("k"), F.substr(t, m + 31)))
    )
    return plain.withColumn("_m", F.floor(F.length(t) / 2).cast("int")).select("doc_id", "page", "truth", got.alias("got"))


@query("edit_distance", _DISTANCE)
def edit_distance(v: Views):
    return D.edit_distance(_edited(v))


@query("cer_stats", f"""
    with rated as (select round(distance / greatest(truth_len, 1), 9) as cer from ({_DISTANCE}) where truth_len >= 100),
    ranked as (select cer, row_number() over (order by cer) - 1 as rn, count(*) over () as n from rated)
    select 'cer' as metric, case when rn = n // 2 then 'median' else 'p10' end as stat, cer as value from ranked where rn = n // 2 or rn = n // 10""")
def cer_stats(v: Views):
    rated = D.with_cer(D.edit_distance(_edited(v))).filter("truth_len >= 100").withColumn("cer", F.round("cer", 9))
    return D.order_stats(rated, ["cer"], {"median": D.UPPER_MEDIAN, "p10": D.FLOOR_P10})


@query("round_robin", """
    select doc_id, path, cast(round as int) as round, cast(page as int) as page, row_number() over (order by round, path) - 1 as place from (
      select doc_id, path, round, (round * 7 + 1) % pages + 1 as page,
        row_number() over (partition by doc_id, (round * 7 + 1) % pages order by round) as rn
      from (select doc_id, path, pages, unnest(range(0, 5)) as round from fx_assets))
    where rn = 1 order by round, path limit (select count(*) * 2 from documents)""")
def round_robin(v: Views):
    docs = v.assets.select("doc_id", "path", "pages")
    twice = 2 * v.table("documents").agg(F.count(F.lit(1))).scalar()
    return D.round_robin_sample(docs, twice).select("doc_id", "path", "round", "page", "place")

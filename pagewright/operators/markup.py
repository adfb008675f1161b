"""Emphasis markup: baselines, locating marks, overlaps, applying, gates, worklists."""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright import fixed_values as V
from pagewright.functions import imaging, markup, paths, text
from pagewright.operators.ordering import at_positions, attach_group_facts
from pagewright.session import durable

KEYS = ("sha", "page")
LOST_SALTS = 64

# People write numbers as text and put odd things where a list belongs, so every field is read as text first.
INSTRUCTION = T.StructType([
    *[T.StructField(name, T.StringType()) for name in ("sha", "page", "marks", "none", "clear", "_corrupt")],
])
MARKS = T.ArrayType(T.StructType([T.StructField(name, T.StringType()) for name in ("line", "text", "type")]))
_FALSY = ("false", "0", "0.0", "-0", "")


# --- baseline ---------------------------------------------------------------


def fingerprints(pages: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    return pages.select(*keys, markup.body_fingerprint(F.col(body)).alias("fp"))


def baseline_diff(old: DataFrame, new: DataFrame, keys=KEYS) -> DataFrame:
    """Pages added, changed or removed since the baseline."""
    both = old.withColumnRenamed("fp", "_old").join(new.withColumnRenamed("fp", "_new"), list(keys), "full")
    status = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "changed")
    )
    return both.select(*keys, status.alias("status")).filter(F.col("status").isNotNull())


def numbered_lines(pages: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    """1-based lines of the stripped body."""
    lines = F.split(markup.strip_marks(F.col(body)), "\n")
    return pages.select(*keys, F.posexplode(lines).alias("_pos", "line")).select(
        *keys, (F.col("_pos") + 1).alias("line_no"), "line"
    )


# --- instructions -----------------------------------------------------------


def parse_instructions(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Instruction records from JSON text; ``bad_json`` flags unreadable ones.

    Page and line may be numbers or text; a page that is no whole number gives -1, a line that is none stays null. ``marks`` that is
    no list counts as none. ``clear`` is set by anything but false, 0, empty text and null.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    read = text.pinned(df, _raw=F.from_json(F.col(raw), INSTRUCTION, options))
    part = F.col("_raw")
    page = F.when(part["page"].isNotNull(), F.coalesce(_whole(part["page"]), F.lit(-1)))
    marks = F.when(part["marks"].startswith("["), F.from_json(part["marks"], MARKS))
    rec = F.struct(
        part["sha"].alias("sha"), page.alias("page"),
        F.transform(marks, lambda m: F.struct(_whole(m["line"]).alias("line"), m["text"].alias("text"), m["type"].alias("type"))).alias("marks"),
        part["none"].alias("none"),
        (part["clear"].isNotNull() & ~part["clear"].isin(*_FALSY)).alias("clear"),
    )
    bad = part.isNull() | part["_corrupt"].isNotNull()
    return text.pinned(read, rec=F.when(~bad, rec), bad_json=bad).drop(raw, "_raw")


def _whole(value: Column) -> Column:
    """A whole number written as a number or as text, else null."""
    number = F.trim(value).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def explode_marks(instructions: DataFrame, keys=KEYS) -> DataFrame:
    """One row per mark, numbered in instruction order."""
    return instructions.select(*keys, F.posexplode("rec.marks").alias("seq", "_m")).select(
        *keys, "seq", F.col("_m.line").alias("line"), F.col("_m.text").alias("text"), F.col("_m.type").alias("type")
    )


# --- locating and overlaps --------------------------------------------------


def locate_marks(marks: DataFrame, pages: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    """Find each mark's text on its line or up to two lines away; first occurrence counts.

    Adds mark_type, hit_line (1-based), start and stop (0-based, stop exclusive) and ``why`` for
    marks that cannot be placed. A mark asks for the lines around its own by page and line number, so only these lines travel
    with it; marks found on none of them are then held against the lines of their page, each text once.
    """
    keys = list(keys)
    filed = marks.withColumn("text", F.coalesce("text", F.lit(""))).join(pages.select(*keys).distinct(), keys, "left_semi").select(*marks.columns)
    wanted = durable(filed.withColumn("_id", F.monotonically_increasing_id()))   # ids hold for good once written
    needle = F.col("text")
    blank, broken = text.trim(needle) == "", needle.contains("\n")
    marked = pages.join(wanted.select(*keys).distinct(), keys, "left_semi")
    lines = durable(
        marked.select(*keys, F.posexplode(F.split(markup.strip_marks(F.col(body)), "\n")).alias("_at", "_line"))
        .select(*keys, (F.col("_at") + 1).alias("_number"), "_line")
    )
    sought = wanted.filter(~blank & ~broken).select("_id", *keys, "text", "line")
    asked = sought.select("_id", *keys, "text", F.posexplode(F.array(*[F.col("line") + d for d in V.LINE_OFFSETS])).alias("_turn", "_number"))
    near = (
        asked.join(lines, [*keys, "_number"]).filter(F.col("_line").contains(needle))
        .groupBy("_id").agg(F.min(F.struct("_turn", F.col("_number").alias("hit_line"), (F.instr("_line", needle) - 1).alias("start"))).alias("_hit"))
    )
    hits = durable(near.select("_id", "_hit.hit_line", "_hit.start"))

    # The rest: distinct texts of a page, dealt over salts so that a page with very many of them is searched by many tasks.
    lost = sought.join(hits, "_id", "left_anti")
    texts = lost.select(*keys, "text", F.pmod(F.xxhash64("text"), F.lit(LOST_SALTS)).cast("int").alias("_salt")).distinct()
    searched = texts.select(*keys, "_salt").distinct().join(lines, keys)
    placed = (
        texts.join(searched, [*keys, "_salt"]).filter(F.col("_line").contains(needle))
        .groupBy(*keys, "text").agg(F.min("_number").alias("_elsewhere"))
    )
    elsewhere = lost.join(placed, [*keys, "text"]).select("_id", "_elsewhere")
    found = wanted.join(hits, "_id", "left").join(elsewhere, "_id", "left")
    why = (
        F.when(F.col("hit_line").isNotNull(), None)
        .when(blank, "empty text")
        .when(broken, "line break in text")
        .when(F.col("_elsewhere").isNull(), "not in the text")
        .otherwise(F.concat(F.lit("on line "), F.col("_elsewhere"), F.lit(" instead")))
    )
    return found.select(
        *marks.columns, "hit_line", "start", (F.col("start") + F.length(needle)).alias("stop"),
        F.coalesce(markup.mark_type(F.col("type")), F.lit("color")).alias("mark_type"), why.alias("why"),
    )


def _accept_spans(batches):
    """Whether each span is accepted; rows come line by line, the longest span first.

    An accepted span is at least as long as the next one, so the two cross exactly if an end of the accepted span lies strictly inside
    the other. Hence a sorted list of the ends of accepted spans, searched by bisection, decides.
    """
    line, ends = None, []
    for batch in batches:
        shapes = zip(*(batch[c].to_pylist() for c in (*batch.schema.names[:-2], "start", "stop")), strict=True)
        fates = []
        for *own, start, stop in shapes:
            if own != line:
                line, ends = own, []
            after = bisect.bisect_right(ends, start)
            accepted = after == len(ends) or ends[after] >= stop
            if accepted:
                for end in (start, stop):
                    at = bisect.bisect_left(ends, end)
                    if at == len(ends) or ends[at] != end:
                        ends.insert(at, end)
            fates.append(accepted)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fates, pa.bool_())], [*batch.schema.names, "_ok"])


def resolve_overlaps(located: DataFrame, keys=KEYS) -> DataFrame:
    """Status per mark: applied, duplicate, or the reason it failed.

    Longest marks come first, equal lengths in instruction order; a mark that crosses an accepted
    one fails. Marks on the same span share one fate, so they shrink to one row per span. Spans are dealt by line and stream
    past the line's accepted ends in sorted order: nothing but these ends, at most one per character, is held.
    """
    keys, located = list(keys), durable(located)   # read twice below, and small next to the pages
    at = [*keys, "hit_line", "start", "stop"]
    first = {t: F.min(F.when(F.col("mark_type") == t, F.col("seq"))).alias(f"_first_{t}") for t in V.MARKERS}
    spans = located.filter("hit_line is not null").groupBy(*at).agg(F.min("seq").alias("_seq"), *first.values())
    spans = durable(spans)
    ordered = (
        spans.repartition(*keys, "hit_line").sortWithinPartitions(*keys, "hit_line", F.col("start") - F.col("stop"), "_seq", "start", "stop").select(*at)
    )
    shape = T.StructType([*ordered.schema.fields, T.StructField("_ok", T.BooleanType())])
    facts = ordered.mapInArrow(_accept_spans, shape).join(spans.drop("_seq"), at)
    marked = attach_group_facts(located, facts, at, ["seq"])
    earliest = F
    for t in V.MARKERS:
        earliest = earliest.when(F.col("mark_type") == t, F.col(f"_first_{t}"))
    status = (
        F.when(F.col("why").isNotNull(), F.col("why"))
        .when(~F.col("_ok"), "partly overlaps another mark")
        .when(F.col("seq") != earliest, "duplicate")
        .otherwise("applied")
    )
    return marked.withColumn("status", status).select(*[c for c in located.columns if c != "why"], "status")


def failed_marks(resolved: DataFrame, keys=KEYS) -> DataFrame:
    """Marks that could not be placed, with the reason and shortened text."""
    return resolved.filter(~F.col("status").isin("applied", "duplicate")).select(
        *keys, "seq", "line", F.substring("text", 1, V.FAILED_TEXT_CHARS).alias("text"), "type",
        F.col("status").alias("why"),
    )


# --- applying ---------------------------------------------------------------

_NESTING = ("hl", "underline", "color")   # outer to inner on one and the same span


def _marker(kind: Column, side: int) -> Column:
    chain = F
    for name, pair in V.MARKERS.items():
        chain = chain.when(kind == name, F.lit(pair[side]))
    return chain.otherwise(F.lit(""))


def mark_page(body: Column, marks: Column) -> Column:
    """Body with markers put around spans; ``marks`` maps a 1-based line to array<struct<s,e,kind>>.

    Each span gives two boundary events. At one position inner spans close before outer ones, and
    all closings come before openings, outer first; so markers always nest.
    """
    rank = lambda m: F.array_position(F.array(*[F.lit(n) for n in _NESTING]), m["kind"]).cast("int")

    def event(at: Column, phase: int, near: Column, order: Column, token: Column) -> Column:
        return F.struct(
            at.alias("at"), F.lit(phase).alias("phase"), near.alias("near"), order.alias("rank"), token.alias("token")
        )

    def events(own: Column) -> Column:
        return F.array_sort(F.flatten(F.transform(own, lambda m: F.array(
            event(m["s"], 1, -m["e"], rank(m), _marker(m["kind"], 0)),
            event(m["e"], 0, -m["s"], -rank(m), _marker(m["kind"], 1)),
        ))))

    def build(line: Column, own: Column) -> Column:
        zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        return F.aggregate(
            events(own),
            zero,
            lambda done, e: F.struct(
                F.concat(done["out"], F.substr(line, done["at"] + 1, e["at"] - done["at"]), e["token"]).alias("out"),
                e["at"].alias("at"),
            ),
            lambda done: F.concat(done["out"], F.substr(line, done["at"] + 1)),
        )

    def one_line(line: Column, i: Column) -> Column:
        own = F.try_element_at(marks, i + 1)
        return F.when(own.isNotNull(), build(line, own)).otherwise(line)

    return F.array_join(F.transform(F.split(body, "\n"), one_line), "\n")


def apply_marks(pages: DataFrame, resolved: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    """Pages with their applied marks put in: new_body, n_marks and ``intact``.

    ``intact`` holds when stripping the new body gives back the stripped old one. Only first
    copies of a span and type are gathered per page. Accepted spans of a line never cross, so
    a line has fewer than twice as many as characters, and a page's array is bounded by its text.
    """
    keys = list(keys)
    span = F.struct(F.col("start").alias("s"), F.col("stop").alias("e"), F.col("mark_type").alias("kind"))
    lines = resolved.filter("status = 'applied'").groupBy(*keys, "hit_line").agg(F.collect_list(span).alias("_own"))
    chosen = lines.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("hit_line", "_own"))).alias("_marks"), F.sum(F.size("_own")).cast("int").alias("n_marks")
    )
    marked = F.col("_marks").isNotNull()
    base = text.pinned(pages.join(chosen, keys, "left"), _base=F.when(marked, markup.strip_marks(F.col(body))))
    staged = text.pinned(base, new_body=F.when(marked, mark_page(F.col("_base"), F.col("_marks"))).otherwise(F.col(body)))
    intact = F.when(marked, markup.strip_marks(F.col("new_body")) == F.col("_base")).otherwise(True)
    return staged.select(*pages.columns, "new_body", F.coalesce("n_marks", F.lit(0)).alias("n_marks"), intact.alias("intact"))


def clear_marks(body: Column) -> Column:
    return markup.strip_marks(body)


def _record_parts(keys) -> dict:
    sha, page = keys
    rec = F.col("rec")
    return {
        "sha_off": rec["sha"].isNotNull() & (rec["sha"] != "") & (rec["sha"] != F.col(sha).cast("string")),
        "page_off": rec["page"].isNotNull() & (rec["page"] != F.col(page)),
        "n_marks": F.when(rec["marks"].isNull(), 0).otherwise(F.size(rec["marks"])),
        "clear": F.coalesce(rec["clear"], F.lit(False)),
        "none": F.when(rec["none"] != "", rec["none"]),
    }


def usable_instructions(instructions: DataFrame, keys=KEYS) -> DataFrame:
    """Readable records whose own sha and page agree with where they are filed."""
    parts = _record_parts(keys)
    return instructions.filter(~F.col("bad_json")).filter(~parts["sha_off"] & ~parts["page_off"])


def apply_status(instructions: DataFrame, pages: DataFrame, baseline: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    """One row per instruction record: status, new_body, failed marks and unknown types."""
    keys = list(keys)
    parts = _record_parts(keys)
    marks = explode_marks(usable_instructions(instructions, keys), keys)
    # The mark's own text and line are not asked for below, so they are not written and shuffled on.
    resolved = durable(resolve_overlaps(locate_marks(marks, pages, keys, body).drop("text", "line"), keys))
    failed = resolved.groupBy(*keys).agg(
        F.count_if(~F.col("status").isin("applied", "duplicate")).alias("failed_marks"),
        F.count_if(markup.mark_type(F.col("type")).isNull()).alias("unknown_types"),
    )
    filed = pages.select(*keys, body).join(instructions.select(*keys).distinct(), keys, "left_semi")
    applied = apply_marks(filed, resolved, keys, body).select(
        *keys, F.col(body).alias("_old"), "new_body", "intact", markup.body_fingerprint(F.col(body)).alias("_fp")
    )
    base = baseline.select(*keys, F.col("fp").alias("_want"))
    joined = (
        instructions.join(applied, keys, "left").join(base, keys, "left").join(failed, keys, "left")
    )
    cleared = clear_marks(F.col("_old"))
    result = F.when(parts["n_marks"] > 0, F.col("new_body")).when(parts["clear"], cleared).otherwise(F.col("_old"))
    drifted = F.col("_want").isNotNull() & (F.col("_want") != F.col("_fp"))
    status = (
        F.when(F.col("bad_json"), "unreadable")
        .when(parts["sha_off"], "sha mismatch")
        .when(parts["page_off"], "page mismatch")
        .when(F.col("_old").isNull(), "no page")
        .when((parts["n_marks"] == 0) & parts["clear"] & (F.col("_result") != F.col("_old")), "cleared")
        .when((parts["n_marks"] == 0) & parts["clear"], "unchanged")
        .when((parts["n_marks"] == 0) & parts["none"].isNull(), "no marks and no reason")
        .when(parts["n_marks"] == 0, "none kept")
        .when(~F.col("intact"), "text would change")
        .when(drifted, "text drifted")
        .when(F.col("_result") == F.col("_old"), "unchanged")
        .otherwise("written")
    )
    rated = joined.withColumn("_result", result).withColumn("status", status)
    done = F.when(F.col("status").isin("written", "cleared"), F.col("_result")).otherwise(F.col("_old"))
    return rated.select(
        *keys,
        "status",
        done.alias("new_body"),
        F.coalesce("failed_marks", F.lit(0)).alias("failed_marks"),
        F.coalesce("unknown_types", F.lit(0)).alias("unknown_types"),
    )


def none_reasons(instructions: DataFrame, keys=KEYS) -> DataFrame:
    """How often each reason for leaving a page unmarked was given; null means none was given."""
    parts = _record_parts(keys)
    bare = usable_instructions(instructions, keys).filter((parts["n_marks"] == 0) & ~parts["clear"])
    return bare.groupBy(parts["none"].alias("reason")).agg(F.count(F.lit(1)).alias("records"))


# --- gates ------------------------------------------------------------------


def with_level(scan: DataFrame) -> DataFrame:
    return scan.withColumn("level", imaging.emphasis_level(F.col("text_ink"), F.col("text_hl")))


def review_state(scan: DataFrame, pages: DataFrame, instructions: DataFrame, baseline: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    """Scan, page, instruction and baseline side by side: the flags the gates count."""
    keys = list(keys)
    parts = _record_parts(keys)
    text_side = pages.select(
        *keys, (markup.total_marks(F.col(body)) > 0).alias("has_mark"), markup.body_fingerprint(F.col(body)).alias("_fp")
    )
    records = instructions.select(
        *keys, "bad_json", parts["n_marks"].alias("_n"), parts["none"].alias("_none"), parts["clear"].alias("_clear"),
        F.lit(True).alias("_rec"),
    )
    joined = (
        with_level(scan.filter(~F.col("is_err")))
        .join(text_side, keys)
        .join(records, keys, "left")
        .join(baseline.select(*keys, F.col("fp").alias("_want")), keys, "left")
    )
    colored, recorded = F.col("level") != "none", F.coalesce("_rec", F.lit(False))
    readable = recorded & ~F.coalesce("bad_json", F.lit(False))
    with_marks = readable & (F.col("_n") > 0)
    bare = readable & (F.col("_n") == 0)
    return joined.select(
        *keys,
        colored.alias("colored"),
        recorded.alias("recorded"),
        (F.col("_want").isNotNull() & (F.col("_want") != F.col("_fp"))).alias("body_changed"),
        (with_marks & ~F.col("has_mark")).alias("not_applied"),
        ((recorded & ~readable) | (bare & F.col("_none").isNull() & ~F.col("_clear"))).alias("bad_record"),
        (colored & readable & F.col("has_mark")).alias("marked"),
        (colored & bare & ~F.col("has_mark")).alias("none"),
    )


def emphasis_gates(state: DataFrame) -> DataFrame:
    """Gate and progress counts over :func:`review_state`, in one pass."""
    colored, recorded = F.col("colored"), F.col("recorded")
    return state.agg(
        F.count_if("body_changed").alias("body_changed"),
        F.count_if("not_applied").alias("not_applied"),
        F.count_if("bad_record").alias("bad_record"),
        F.count_if(colored).alias("colored"),
        F.count_if(colored & recorded).alias("colored_done"),
        F.count_if("marked").alias("colored_marked"),
        F.count_if("none").alias("colored_none"),
        F.count_if(~colored & recorded).alias("plain_done"),
    )


def none_heavy_docs(state: DataFrame, key: str = "sha", reviewed: int = V.NONE_HEAVY_REVIEWED, share: float = V.NONE_HEAVY_SHARE) -> DataFrame:
    """Documents that leave most of their coloured pages unmarked."""
    per = state.groupBy(key).agg(F.count_if("marked").alias("_m"), F.count_if("none").alias("none"))
    bar = F.lit(str(share)).cast("decimal(18,9)")
    return per.withColumn("reviewed", F.col("_m") + F.col("none")).filter(
        (F.col("reviewed") >= reviewed) & (F.col("none") >= F.col("reviewed") * bar)
    ).drop("_m")


def scan_crosstab(scan: DataFrame, pages: DataFrame, keys=KEYS, body: str = "body") -> DataFrame:
    """Pages per (colored, marked); marked is null for scanned pages without text."""
    side = pages.select(*keys, (markup.total_marks(F.col(body)) > 0).alias("marked"))
    joined = with_level(scan.filter(~F.col("is_err"))).join(side, list(keys), "left")
    return joined.groupBy((F.col("level") != "none").alias("colored"), "marked").agg(F.count(F.lit(1)).alias("pages"))


def missing_top(scan: DataFrame, pages: DataFrame, assets: DataFrame, keys=KEYS, body: str = "body", limit: int = V.CROSSTAB_LIMIT) -> DataFrame:
    """Subjects and material types with the most coloured pages that carry no mark."""
    bare = pages.filter(markup.total_marks(F.col(body)) == 0).select(*keys)
    colored = with_level(scan.filter(~F.col("is_err"))).filter("level <> 'none'")
    hits = colored.join(bare, list(keys), "left_semi").join(assets, keys[0])
    counts = hits.groupBy("subject_key", "material_type").agg(F.count(F.lit(1)).alias("pages"))
    return counts.orderBy(F.desc("pages"), "subject_key", "material_type").limit(limit)


# --- worklists --------------------------------------------------------------


def centre_places(n: Column, sample: int = V.SAMPLE_PER_DOC) -> Column:
    """0-based places in the middle of ``sample`` equal parts of n; every place of a small n."""
    parts = F.array(*[text.int_div(n * (2 * i + 1), F.lit(2 * sample)) for i in range(sample)])
    return F.when(n <= sample, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(parts)


def centre_sample(df: DataFrame, key: str = "sha", order: str = "page", sample: int = V.SAMPLE_PER_DOC) -> DataFrame:
    return at_positions(df, [key], order, centre_places(F.col("n"), sample))


def all_override(df: DataFrame, sampled: DataFrame, full_docs: DataFrame, key: str = "sha") -> DataFrame:
    """Every row of documents flagged for full review, the sample for the others."""
    flags = full_docs.select(key).distinct()
    return df.join(flags, key, "left_semi").unionByName(sampled.join(flags, key, "left_anti"))


def tier_worklist(
    scan: DataFrame, assets: DataFrame, done: DataFrame, pages: DataFrame, full_docs: DataFrame,
    tier: str = "a", keys=KEYS, order=V.EMPHASIS_PRIORITY,
) -> DataFrame:
    """Pages still to review: coloured ones (a), sampled plain ones (b), or both, by priority."""
    keys = list(keys)
    rated = with_level(scan.filter(~F.col("is_err"))).join(assets, keys[0]).select(
        *keys, "subject_key", "material_type", "level"
    )
    colored, plain = rated.filter("level <> 'none'"), rated.filter("level = 'none'")
    if tier == "a":
        target = colored
    else:
        target = all_override(plain, centre_sample(plain, keys[0], keys[1]), full_docs, keys[0])
        if tier != "b":
            target = colored.unionByName(target)
    left = target.join(done.select(*keys), keys, "left_anti").join(pages.select(*keys), keys, "left_semi")
    return (
        left.withColumn("tier", F.when(F.col("level") == "none", "b").otherwise("a"))
        .withColumn("priority", paths.priority(F.col("material_type"), order))
        .orderBy("subject_key", "priority", *keys)
    )


def worklist_rollup(work: DataFrame, by=("subject_key",)) -> DataFrame:
    """Remaining pages per group, fewest first; the row of nulls is the total."""
    return work.rollup(*by).agg(F.count(F.lit(1)).alias("pages")).orderBy("pages", *by)



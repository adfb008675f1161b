"""Page store: explode, worklists, checks, progress, repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright import fixed_values as V
from pagewright.functions import paths, text


def explode_pages(df: DataFrame, pages: str = "pages") -> DataFrame:
    """One row per page 1..pages; documents without pages yield none."""
    return df.filter(F.col(pages) >= 1).withColumn("page", F.explode(F.sequence(F.lit(1), F.col(pages))))


def compose_page(df: DataFrame, keys=V.FRONT_MATTER_KEYS, body: str = "body") -> DataFrame:
    """Front matter lines of ``keys`` around the right-trimmed body, as column ``md``."""
    lines = [F.concat(F.lit(f"{k}: "), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys]
    head = F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.lit(""))
    return df.withColumn("md", F.concat(head, text.rtrim(F.col(body)), F.lit("\n")))


def split_front_matter(df: DataFrame, md: str = "md") -> DataFrame:
    return df.withColumn("head", text.front_matter_head(F.col(md))).withColumn(
        "body", F.substr(F.col(md), F.length("head") + 1)
    )


def parse_front_matter(df: DataFrame, head: str = "head") -> DataFrame:
    return df.withColumn("fields", text.front_matter_map(F.col(head)))


def split_errors(df: DataFrame, goal: str, key: str, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that passed, and dead letters with goal, time, key and shortened error."""
    good = df.filter(F.col(error).isNull()).drop(error)
    bad = df.filter(F.col(error).isNotNull()).select(
        F.lit(goal).alias("goal"),
        F.current_timestamp().alias("at"),
        F.col(key).cast("string").alias("key"),
        F.substring(error, 1, V.ERROR_CHARS).alias("error"),
    )
    return good, bad


def map_pages(df: DataFrame, body_function, schema: str | T.StructType, key: str = "key") -> DataFrame:
    """Apply a caller's Python function to rows in Arrow batches; a failing row carries its error.

    ``body_function`` takes one row as a dict and returns a dict. An exception that has
    ``stop_pipeline`` set ends the job, any other becomes the row's ``error``.
    """
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = shape.fieldNames()

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for record in batch.to_dict("records"):
                out = {name: None for name in names}
                out[key] = record[key]
                try:
                    out.update(body_function(record), error=None)
                except Exception as problem:
                    if getattr(problem, "stop_pipeline", False):
                        raise
                    out["error"] = str(problem)
                rows.append(out)
            yield pd.DataFrame(rows, columns=[*names, "error"])

    return df.mapInPandas(run, T.StructType([*shape.fields, T.StructField("error", T.StringType())]))


def worklist(assets: DataFrame, store: DataFrame, keys=("content_sha", "page")) -> DataFrame:
    """Expected pages that are not stored yet."""
    return explode_pages(assets).join(store.select(*keys), list(keys), "left_anti")


def next_batch(pending: DataFrame, n: int, order=V.BATCH_PRIORITY, path: str = "path") -> DataFrame:
    """First ``n`` pending pages by material priority, with the total still pending."""
    total = pending.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = pending.withColumn("_priority", paths.priority(F.col("material_type"), order))
    return ranked.orderBy("_priority", path, "page").limit(n).drop("_priority").withColumn("total_pending", total)


_CHECKED_HEAD = r"^---\r?\n([\s\S]*?)\r?\n---"


def check_pages(df: DataFrame, sha: str = "sha", page: str = "page", md: str = "md") -> DataFrame:
    """First rule a page breaks, as ``why``; ``ok`` when it breaks none."""
    c = F.col(md)
    staged = df.withColumn("_head", F.regexp_extract(c, _CHECKED_HEAD, 0))
    head = F.concat(F.regexp_replace("_head", r"\r?\n---\z", ""), F.lit("\n"))
    staged = staged.withColumn("_fields", F.regexp_replace(head, r"^---\r?\n", ""))
    staged = staged.withColumn("_body", text.trim(F.substr(c, F.length("_head") + 1)))
    fields, body = F.col("_fields"), F.col("_body")
    missing = F.filter(
        F.array(*[F.when(~fields.rlike(f"(?m)^{k}:"), F.lit(k)) for k in V.REQUIRED_KEYS]),
        lambda k: k.isNotNull(),
    )

    def differs(key: str, want) -> object:
        values = F.regexp_extract_all(fields, F.lit(f"(?m)^{key}:([^\\n]*)$"), F.lit(1))
        return ~F.exists(values, lambda v: text.trim(v) == want.cast("string"))

    why = (
        F.when(F.col("_head") == "", "no front matter")
        .when(F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ",")))
        .when(differs("sha", F.col(sha)), "sha mismatch")
        .when(differs("page", F.col(page)), "page mismatch")
        .when(F.length(body) < V.MIN_BODY_CHARS, F.concat(F.lit("body "), F.length(body), F.lit(" chars")))
        .when(body.rlike(V.REFUSAL), "refusal")
        .otherwise("ok")
    )
    return text.pinned(staged, why=why).drop("_head", "_fields", "_body")


def progress_by_subject(expected: DataFrame, checked: DataFrame, keys=("sha", "page"), md: str = "md") -> DataFrame:
    """Done, total, share, pending, problems and mean bytes per done page; a null subject is the total."""
    joined = expected.join(checked.select(*keys, "why", F.octet_length(md).alias("_bytes")), list(keys), "left")
    done = F.col("why") == "ok"
    out = joined.rollup("subject_key").agg(
        F.count_if(done).alias("done"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("why").isNull()).alias("pending"),
        F.count_if(F.col("why") != "ok").alias("problems"),
        F.coalesce(F.sum(F.when(done, F.col("_bytes"))), F.lit(0)).alias("_done_bytes"),
    )
    # Whole-number halves-up rounding keeps the shares independent of the engine.
    permille = text.ratio(F.col("done"), F.col("total"), 1000)
    mean = F.coalesce(text.ratio(F.col("_done_bytes"), F.col("done"), 1), F.lit(0))
    return out.withColumn("permille_done", permille).withColumn("mean_bytes", mean).drop("_done_bytes")


def completeness(assets: DataFrame, store: DataFrame, key: str = "content_sha") -> DataFrame:
    """Stored against expected pages per document."""
    stored = store.groupBy(key).agg(F.count(F.lit(1)).alias("present"))
    return (
        assets.filter(F.coalesce("pages", F.lit(0)) > 0)
        .join(stored, key, "left")
        .withColumn("present", F.coalesce("present", F.lit(0)))
        .withColumn("complete", F.col("present") == F.col("pages"))
    )


def strip_leaked_label(df: DataFrame, labels=V.LEAKED_LABELS, md: str = "md") -> DataFrame:
    """Drop the first non-empty body line when it is a known label; adds the flag ``stripped``."""
    c = F.col(md)
    staged = df.withColumn("_head", text.front_matter_head(c))
    staged = staged.withColumn("_lines", F.split(F.substr(c, F.length("_head") + 1), "\r?\n"))
    first = F.array_position(F.transform("_lines", lambda line: line != ""), True).cast("int")
    staged = staged.withColumn("_first", first)
    lines, at = F.col("_lines"), F.col("_first")
    hit = (F.col("_head") != "") & (at > 0) & F.get(lines, at - 1).isin(*labels)
    kept = F.concat(F.slice(lines, F.lit(1), at - 1), F.slice(lines, at + 1, F.size(lines)))
    return (
        staged.withColumn("stripped", F.coalesce(hit, F.lit(False)))
        .withColumn(md, F.when(F.col("stripped"), F.concat("_head", F.array_join(kept, "\n"))).otherwise(c))
        .drop("_head", "_lines", "_first")
    )


def assert_count(df: DataFrame, condition, expected: int | None) -> DataFrame:
    """Pass rows through; fail the job when the number of matching rows is not ``expected``."""
    if expected is None:
        return df
    got = df.agg(F.count_if(condition).alias("n")).scalar()
    message = F.concat(F.lit(f"expected {expected} rows, found "), got.cast("string"))
    guard = F.when(got != expected, F.raise_error(message)).otherwise(F.lit(True))
    return df.filter(guard.cast("boolean"))


def drop_leading_blank(df: DataFrame, md: str = "md") -> DataFrame:
    """Remove one blank line right after the front matter; adds the flag ``changed``."""
    c = F.col(md)
    staged = df.withColumn("_head", text.front_matter_head(c))
    rest = F.substr(c, F.length("_head") + 1)
    staged = staged.withColumn("changed", (F.col("_head") != "") & rest.rlike(r"^\r?\n"))
    cut = F.concat("_head", F.regexp_replace(rest, r"^\r?\n", ""))
    return staged.withColumn(md, F.when(F.col("changed"), cut).otherwise(c)).drop("_head")


def reconcile_counts(assets: DataFrame, rendered: DataFrame, key: str = "content_sha") -> DataFrame:
    """Documents whose rendered page count differs from the manifest; unrendered ones are ignored."""
    got = rendered.groupBy(key).agg(F.count(F.lit(1)).alias("rendered"))
    return assets.join(got, key).filter(~F.col("rendered").eqNullSafe(F.col("pages")))


def stage_status(stages: dict) -> DataFrame:
    """Stage name to (frame, wanted count frame): got, want and a mark per stage."""
    out = None
    for name, (have, want) in stages.items():
        got = have.agg(F.count(F.lit(1)).alias("got")).withColumn("stage", F.lit(name))
        row = got.withColumn("want", want.agg(F.count(F.lit(1)).alias("n")).scalar())
        out = row if out is None else out.unionByName(row)
    mark = F.when(F.col("got") == 0, "none").when(F.col("got") >= F.col("want"), "done").otherwise("partial")
    return out.select("stage", "got", "want", mark.alias("mark"))


def needs_render(assets: DataFrame, store: DataFrame, rendered: DataFrame, key: str = "content_sha") -> DataFrame:
    """PDF documents with stored text and pages but no render."""
    pdfs = assets.filter((F.col("ext") == ".pdf") & (F.col("pages") > 0))
    stored, done = store.select(key).distinct(), rendered.select(key).distinct()
    return pdfs.join(stored, key, "left_semi").join(done, key, "left_anti")


def invalidate(store: DataFrame, keys: DataFrame, on=("content_sha",)) -> DataFrame:
    """The store without the pages of the listed documents."""
    return store.join(keys.select(*on).distinct(), list(on), "left_anti")

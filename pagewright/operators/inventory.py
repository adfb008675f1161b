"""Asset inventory: classification, hashing, duplicates, selection, rollups, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import imaging, paths, text
from pagewright.operators.ordering import attach_group_facts, with_global_index


def skip_assets(
    df: DataFrame,
    dirs=V.SKIP_DIRS,
    names=V.SKIP_NAMES,
    extensions=V.SKIP_EXTENSIONS,
    pattern: str | None = V.SKIP_PATTERN,
    path: str = "path",
) -> DataFrame:
    """Drop files under a listed folder, with a listed name or extension, or a matching name."""
    p = F.col(path)
    name = paths.file_name(p)
    segments = F.split(p, "/")
    folders = F.slice(segments, F.lit(1), F.size(segments) - 1)
    keep = ~name.isin(*names) & ~paths.extension(p).isin(*extensions)
    if dirs:
        keep &= ~F.arrays_overlap(folders, F.array(*[F.lit(d) for d in dirs]))
    if pattern:
        keep &= ~name.rlike(pattern)
    return df.filter(keep)


def path_fields(df: DataFrame, subjects: DataFrame, path: str = "path") -> DataFrame:
    """Subject by first folder, category, file name and extension.

    ``subjects`` has one row per folder: folder, key, area, quota. The join carries no hint:
    Spark broadcasts the table only when it is small enough.
    """
    dim = subjects.select(
        F.col("folder").alias("subject_folder"),
        F.col("key").alias("_key"),
        F.col("area").alias("_area"),
        F.col("quota").alias("_quota"),
    )
    p = F.col(path)
    joined = df.withColumn("_top", paths.top_folder(p)).join(
        dim, F.col("_top") == F.col("subject_folder"), "left"
    )
    subject = F.coalesce("_key", F.lit("_root"))
    return joined.select(
        *df.columns,
        F.concat_ws("/", subject, p).alias("source_key"),
        "subject_folder",
        subject.alias("subject_key"),
        F.coalesce("_area", F.lit(0)).alias("area"),
        F.coalesce("_quota", F.lit(0)).alias("exam_questions"),
        paths.parent_name(p).alias("category"),
        paths.file_name(p).alias("filename"),
        paths.extension(p).alias("ext"),
    )


def content_hash(content: Column, digits: int = V.HASH_HEX, cap: int | None = None) -> Column:
    """Leading hex digits of SHA-256 over all bytes; 64 ``digits`` give the whole digest.

    A ``cap`` hashes only so many leading bytes: contents that differ later then count as copies.
    """
    data = content.cast("binary")
    if cap:
        data = F.substring(data, 1, cap)
    return F.substring(F.sha2(data, 256), 1, digits)


def size_mb(size_bytes: Column) -> Column:
    return F.round(size_bytes / F.lit(1048576.0), 3)


def even_pages(pages: Column, sample: int = V.PROBE_PAGES) -> Column:
    """Evenly spread page numbers, first and last included; empty when there are no pages."""
    n = F.least(F.lit(sample), pages)
    steps = F.greatest(F.lit(1), n - 1)
    spread = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: 1 + imaging.round_half_up(i * (pages - 1) / steps)
    )
    return F.when(pages >= 1, F.array_distinct(spread)).otherwise(F.array().cast("array<int>"))


def even_sample(df: DataFrame, sample: int = V.PROBE_PAGES, pages: str = "pages") -> DataFrame:
    return df.withColumn("page", F.explode(even_pages(F.col(pages), sample)))


def text_class(df: DataFrame, body: str = "body", profile=text.TextProfile()) -> DataFrame:
    dense = text.pinned(df, _dense=text.squeeze_out(F.col(body)))
    counted = text.pinned(dense, _c=text.page_counts(F.col("_dense"), profile))
    return counted.select(*df.columns, "_c.*", text.page_class(F.col("_c")).alias("page_class"))


def doc_text_layer(df: DataFrame, keys) -> DataFrame:
    """A document takes the class of its worst page; mostly empty documents are scans."""
    real = F.count_if(F.col("page_class") != "EMPTY")
    bad = F.count_if(F.col("page_class") == "MOJIBAKE")
    voted = df.groupBy(*keys).agg(
        F.count("page_class").alias("n_pages"), real.alias("n_real"), bad.alias("n_bad")
    )
    layer = (
        F.when(F.col("n_real") == 0, "SCAN")
        .when(F.col("n_bad") > 0, "MOJIBAKE")
        .when(F.col("n_real") * 2 < F.col("n_pages"), "SCAN")
        .otherwise("CLEAN")
    )
    return voted.withColumn("text_layer", layer)


def with_extract_route(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "extract_route",
        paths.extract_route(F.col("ext"), F.col("text_layer"), F.col("material_type")),
    )


def dup_groups(df: DataFrame, keys=("content_sha", "size_bytes"), path: str = "path") -> DataFrame:
    """Mark exact copies: group id in order of first path, and the first path as primary.

    Groups shrink to one row each before the shuffle, and their ids go back to the copies
    through a join that splits large groups.
    """
    facts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(path).alias("first_path"))
        .filter(F.col("copies") >= 2)
    )
    named = with_global_index(facts, ["first_path"], "_no").withColumn(
        "dup_group", F.format_string("dup%03d", "_no")
    )
    marked = attach_group_facts(df, named.drop("_no"), list(keys), [path])
    return marked.withColumn(
        "is_primary", F.coalesce(F.col(path) == F.col("first_path"), F.lit(True))
    ).drop("copies", "first_path")


def dedup_savings(df: DataFrame) -> DataFrame:
    primary = F.col("is_primary")
    pages = F.coalesce("pages", F.lit(0))
    first_copy = F.col("dup_group").isNotNull() & primary
    return df.agg(
        F.count(F.lit(1)).alias("assets"),
        F.count_if(primary).alias("primary_assets"),
        F.sum(pages).alias("pages"),
        F.sum(F.when(primary, pages).otherwise(0)).alias("primary_pages"),
        F.count_if(first_copy).alias("dup_groups"),
        F.sum(F.when(primary, 0).otherwise(pages)).alias("pages_saved"),
    )


def reuse_probe(df: DataFrame, cache: DataFrame, probe, key: str = "content_sha") -> tuple[DataFrame, DataFrame]:
    """Probe only content not cached yet.

    ``probe`` maps a frame of distinct uncached keys to the columns of ``cache``. Returns the
    assets with their probe columns, and the cache including the new entries. One piece of
    content may have any number of copies, so the probe results go back through a split join.
    """
    present = df.select(key).distinct()
    missing = present.join(cache.select(key), key, "left_anti")
    found = cache.withColumn("from_cache", F.lit(True)).unionByName(
        probe(missing).select(*cache.columns).withColumn("from_cache", F.lit(False))
    )
    spread = [c for c in df.columns if c != key]
    probed = attach_group_facts(df, present.join(found, key), [key], spread)
    return probed, found.drop("from_cache")


def select_assets(
    df: DataFrame,
    types=None,
    routes=None,
    subject: str | None = None,
    ext: str | None = None,
    primary_only: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Conjunction of filters; a limit of 0 or None keeps every row."""
    out = df
    if primary_only:
        out = out.filter("is_primary")
    if types:
        out = out.filter(F.col("material_type").isin(*types))
    if routes:
        out = out.filter(F.col("extract_route").isin(*routes))
    if subject:
        out = out.filter(F.col("subject_key") == subject)
    if ext:
        out = out.filter(F.col("ext") == ext)
    return out.orderBy("path").limit(limit) if limit else out


def total_pages(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))


def rollup_assets(df: DataFrame, dims) -> DataFrame:
    """File and page counts per value of each dimension, all dimensions in one pass."""
    sides = df.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.coalesce("pages", F.lit(0))).alias("pages"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
    )
    which, value = F, F
    for d in dims:
        here = F.col(f"_g_{d}") == 0
        which, value = which.when(here, F.lit(d)), value.when(here, F.col(d).cast("string"))
    return sides.select(which.alias("dim"), value.alias("value"), "files", "pages").orderBy("dim", F.desc("pages"), "value")


def inventory_gates(df: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per check: name, bad count and pass flag.

    ``expected`` lists material_type and want, the number of primary files wanted.
    """
    absent = df.agg(
        F.count_if(F.col("extract_route").isNull()).alias("route"),
        F.count_if(F.col("content_sha").isNull()).alias("sha"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("every row has a route").alias("name"), F.col("route").alias("bad")),
                F.struct(F.lit("every row has a hash").alias("name"), F.col("sha").alias("bad")),
            )
        )
    )
    primary = df.filter("is_primary")
    twice = (
        primary.groupBy("content_sha")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("bad"))
        .select(F.lit("no hash twice among primaries").alias("name"), "bad")
    )
    counts = primary.groupBy("material_type").agg(F.count(F.lit(1)).alias("n"))
    wanted = expected.join(counts, "material_type", "left").select(
        F.concat(F.lit("file count of "), "material_type").alias("name"),
        F.abs(F.coalesce("n", F.lit(0)) - F.col("want")).alias("bad"),
    )
    checks = absent.unionByName(twice).unionByName(wanted)
    return checks.withColumn("passed", F.col("bad") == 0)

"""Sampling, leak scan, bulk and gate reports."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions.text import pinned


def stratified_sample(df: DataFrame, stratum: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows per stratum, the same ones on every run.

    The rank filter lets Spark keep only the first n rows of a stratum per input partition, so a
    large stratum is cut down before the shuffle.
    """
    draw = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))), 256)
    order = Window.partitionBy(stratum).orderBy("_draw", key)
    ranked = df.withColumn("_draw", draw).withColumn("_rn", F.row_number().over(order))
    return ranked.filter(F.col("_rn") <= n).drop("_draw", "_rn")


def dense_filter(df: DataFrame, rotated: DataFrame, types, key: str) -> DataFrame:
    """Documents that are rotated or of a listed type."""
    flag = rotated.select(key).distinct().withColumn("_rotated", F.lit(True))
    return df.join(flag, key, "left").filter(
        F.col("_rotated").isNotNull() | F.col("material_type").isin(*types)
    ).drop("_rotated")


# Rules of this library's own, in the form of the fixed ones: id, target column, pattern.
OWN_RULES = (
    ("email", "content", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("phone", "content", r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    ("secret", "content", r"(?i)\b(?:token|secret|password|api_key)[ ]*=[ ]*\"[0-9A-Za-z_-]{20,}\""),
)
DEFAULT_RULES = (*V.LEAK_PATTERNS, *OWN_RULES)
# Literals of which one must occur for the pattern to match: far cheaper to look for first.
LITERALS = {
    "local-path": (":\\",), "api-key": ("sk-", "gho_", "AIza"), "drive-id": ("driveFileId", "drive_file_id", "fileId"),
    "l1-content": ("sha:",), "source-key": ("source_key:",), "email": ("@",), "phone": ("+",), "secret": ("=",),
}


def source_folder_rule(*folders: str) -> tuple[str, str, str]:
    """A rule for paths of the folders that hold the source material, for a caller to add: drive:\\folder or /folder/."""
    import re

    names = "|".join(re.escape(f) for f in folders)
    return ("drive-path", "content", rf"[A-Za-z]:\\(?:{names})|/(?:{names})/")


def leak_scan(
    docs: DataFrame,
    rules=DEFAULT_RULES,
    allow: DataFrame | None = None,
    allow_by_rule: DataFrame | None = None,
    path: str = "path",
    content: str = "content",
) -> DataFrame:
    """Rule and path of every hit, never the text that matched; all rules in one pass.

    A rule is its id, its target ("path" or "content") and a pattern. ``allow`` lists exempt paths, ``allow_by_rule`` exempt
    (rule, path) pairs.
    """
    def hit(rule: str, target: str, pattern: str) -> Column:
        column = F.col(path if target == "path" else content)
        match = column.rlike(pattern)
        return reduce(or_, [column.contains(one) for one in LITERALS[rule]]) & match if rule in LITERALS else match

    tested = F.array(*[F.when(hit(*rule), F.lit(rule[0])) for rule in rules])
    found = pinned(docs.select(path, content), _hits=tested)
    hits = found.select(path, F.explode(F.filter("_hits", lambda r: r.isNotNull())).alias("rule"))
    if allow is not None:
        hits = hits.join(allow.select(path).distinct(), path, "left_anti")
    if allow_by_rule is not None:
        hits = hits.join(allow_by_rule.select("rule", path).distinct(), ["rule", path], "left_anti")
    return hits.select("rule", path)


def dedup_violations(hits: DataFrame, path: str = "path") -> DataFrame:
    return hits.dropDuplicates(["rule", path])


def bulk_gate(paths: DataFrame, limit: int = V.BULK_LIMIT, name: str = V.BULK_NAME, allowed: str = V.BULK_ALLOWED, exempt=(), path: str = "path") -> DataFrame:
    """One row: document files outside the allowed folders, and whether that is too many."""
    p = F.col(path)
    bulk = paths.filter(p.rlike(name) & ~p.rlike(allowed))
    if exempt:
        bulk = bulk.filter(~p.isin(*exempt))
    return bulk.agg(F.count(F.lit(1)).alias("files"), F.min(path).alias("example")).withColumn(
        "violation", F.col("files") > limit
    )


def check(name: str, passed: DataFrame, detail: str | None = None) -> DataFrame:
    """A gate row from a one-row frame with ``ok`` (true, false, or null for not run) and ``detail``."""
    status = F.when(F.col("ok").isNull(), "skip").when(F.col("ok"), "pass").otherwise("fail")
    note = F.lit(detail) if detail is not None else F.col("detail").cast("string")
    return passed.select(F.lit(name).alias("name"), status.alias("status"), note.alias("detail"))


def named_checks(gates: DataFrame) -> DataFrame:
    """Gate rows from a frame of name, bad and passed, as the inventory's gates are; the detail is the number of bad cases."""
    status = F.when(F.col("passed").isNull(), "skip").when(F.col("passed"), "pass").otherwise("fail")
    return gates.select("name", status.alias("status"), F.col("bad").cast("string").alias("detail"))


def gate_report(checks) -> DataFrame:
    """All gate rows in one table."""
    out = None
    for one in checks:
        out = one if out is None else out.unionByName(one)
    return out


def gate_totals(report: DataFrame) -> DataFrame:
    """Counts per status; the run fails when any check fails."""
    tally = {s: F.count_if(F.col("status") == s).alias(s) for s in ("pass", "fail", "skip")}
    return report.agg(F.count(F.lit(1)).alias("checks"), *tally.values()).withColumn("failed", F.col("fail") > 0)


def log_reconcile(quarantine: DataFrame, store: DataFrame, key: str = "key") -> DataFrame:
    """Distinct quarantined keys: solved when the store holds them by now, open otherwise."""
    done = store.select(key).distinct().withColumn("_done", F.lit(True))
    return quarantine.select("goal", key).distinct().join(done, key, "left").select(
        "goal", key, F.when(F.col("_done"), "solved").otherwise("open").alias("state")
    )

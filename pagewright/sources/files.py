"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_assets(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """One row per file below ``root``: path relative to it, size and optionally the bytes.

    Without ``content`` only the listing is read, the bytes are pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("://")[-1]
    plain = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
    relative = F.substr(plain, F.instr(plain, F.lit(base)) + len(base) + 1)
    out = files.select(relative.alias("path"), F.col("length").alias("size_bytes"), "content")
    return out if content else out.drop("content")

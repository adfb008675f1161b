"""Written tables: incremental append, forced rebuild, partition rewrite, JSON lines."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.session import durable
from pagewright.sources import versions


def read_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last version of the store, or an empty frame when nothing was written yet; a folder without versions is read whole."""
    return versions.read_version(spark, path, schema)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, folder = versions.hadoop_path(spark, path)
    fs.delete(folder, True)


def _same(left: DataFrame, right: DataFrame, columns):
    """Null-safe equality of ``columns``, as a join condition."""
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def _same_partitions(stored: DataFrame, new: DataFrame, partition_by) -> DataFrame:
    """The store cut to the value range of the new rows' partitions, which Spark turns into a filter on folders."""
    for column in partition_by:
        low, high = new.agg(F.min(column)).scalar(), new.agg(F.max(column)).scalar()
        stored = stored.filter(F.col(column).isNull() | F.col(column).between(low, high))
    return stored


def _once(new: DataFrame, keys, order) -> DataFrame:
    """One row per key: the first in ``order``, by default in the order of all other columns."""
    rest = [c for c in new.columns if c not in keys]
    if not rest:
        return new.distinct()
    chosen = F.min_by(F.struct(*rest), F.struct(*(order or rest)))
    return new.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, "_row.*").select(*new.columns)


def _known(new: DataFrame, path: str, keys, partition_by) -> tuple[DataFrame | None, DataFrame | None]:
    """Of the new keys those that the store holds, and the files that hold them, from its index; Nones for a store without versions."""
    spark = new.sparkSession
    number = versions.latest(spark, path)
    if number is None:
        return None, None
    hits = versions.suspects(spark, path, versions.version_table(spark, path, number), new, keys)
    opened = versions.read_files(spark, path, new.schema, versions.file_names(hits))
    stored = _same_partitions(opened, hits, partition_by).select(*keys)
    return stored.join(hits.select(*keys).distinct(), _same(stored, hits, keys), "left_semi"), hits


def unstored(new: DataFrame, path: str, keys, partition_by=(), order=()) -> DataFrame:
    """Rows whose key the store does not hold, once per key.

    Partition columns belong to the key: a row is known by its key and partition together. The key index tells which files may
    hold which key; only these are opened, and of them the key columns only.
    """
    whole = list(dict.fromkeys([*keys, *partition_by]))
    once = _once(new, whole, order)
    stored, _ = _known(once, path, whole, partition_by)
    if stored is None:
        stored = _same_partitions(read_store(new.sparkSession, path, new.schema), new, partition_by).select(*whole)
    return once.join(stored, _same(once, stored, whole), "left_anti")


def incremental_write(new: DataFrame, path: str, keys, partition_by=(), force: bool = False, order=()) -> DataFrame:
    """Append rows whose key is not stored yet, once per key; a rerun adds nothing.

    ``force`` replaces the stored rows of these keys instead; every other key stays, and only files that hold one of the keys are
    rewritten. Of rows with one key the first in ``order`` is taken, so a repeated batch writes the same rows. The write is one
    new version of the store: readers see all of it or nothing.
    """
    spark = new.sparkSession
    whole = list(dict.fromkeys([*keys, *partition_by]))
    if force and versions.latest(spark, path) is not None:
        once = durable(_once(new, whole, order))
        _, hits = _known(once, path, whole, partition_by)
        held = versions.read_files(spark, path, new.schema, versions.file_names(hits))
        rest = held.join(once.select(*whole), _same(held, once, whole), "left_anti")
        versions.commit(rest.unionByName(once), path, keys, partition_by, dead=hits)
    else:
        if force:
            remove_folder(spark, path)
        versions.commit(unstored(new, path, keys, partition_by, order), path, keys, partition_by)
    return read_store(spark, path, new.schema)


def rewrite_partitions(spark: SparkSession, path: str, kept: DataFrame, touched: DataFrame, partition_by: str) -> None:
    """Replace the touched partitions of a store by their rows in ``kept``, whatever their values, null included.

    The files of these partitions leave the next version of the store, so a partition without rows is simply no longer named.
    """
    # Both inputs may read the very store that is about to change.
    values = durable(touched.select(partition_by).distinct())
    rows = kept.join(values, kept[partition_by].eqNullSafe(values[partition_by]), "left_semi")
    table = versions.version_table(spark, path, versions.latest(spark, path))
    dead = table.join(values, table["part"][partition_by].eqNullSafe(values[partition_by]), "left_semi")
    shape = table.select("keys", "parts").first()
    versions.commit(rows, path, shape["keys"], shape["parts"], dead=dead)


def write_bucketed(df: DataFrame, name: str, path: str, keys, buckets: int) -> DataFrame:
    """A table laid out by key, so that joins of two such tables on the keys need no shuffle.

    Meant for stores that are joined by page key again and again: pages, baselines, instructions.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a fixed schema; an absent path is an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)

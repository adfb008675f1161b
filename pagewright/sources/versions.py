"""Versions of a store and the key index of its files.

A store is a folder of immutable Parquet files, one ``commit=`` folder per write. A version is a small table that names the files that are
live and says what each holds; it is published by one rename, so a reader sees the whole write or nothing of it, and a writer that
stops half-way leaves the version before. With every commit goes a key index: for each file a Bloom filter over its keys, in blocks of
``BITS`` bits, and in the version table the cells of the key hash and the smallest and largest key of the file. A new key is held against
the filters of the files that share its cell, so files without a hit are not opened at all.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.session import durable

#: Cells of the key hash. Rows leave the de-duplication dealt by the same hash, so with a number of shuffle partitions that divides this one a file holds few cells.
CELLS = 256
BITS = 32768
KEYS_PER_BLOCK = 2048   # 16 bits a key
PROBES = 4


def hadoop_path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def latest(spark: SparkSession, path: str) -> int | None:
    """Number of the last published version, or None."""
    numbers = [int(n) for n in folder_names(spark, f"{path}/_versions") if n.isdigit()]
    return max(numbers, default=None)


def version_table(spark: SparkSession, path: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{path}/_versions/{number:010d}")


def read_files(spark: SparkSession, path: str, schema: T.StructType, files: list[str]) -> DataFrame:
    """The rows of some files of the store; files written before the store had versions lie beside the commits."""
    frame = None
    for own in ([f for f in files if "/commit=" in f], [f for f in files if "/commit=" not in f]):
        if own:
            rows = spark.read.schema(schema).option("basePath", path).parquet(*own).select(*schema.fieldNames())
            frame = rows if frame is None else frame.unionByName(rows)
    return spark.createDataFrame([], schema) if frame is None else frame


def file_names(table: DataFrame) -> list[str]:
    """Paths of files, which the table holds as URIs: as many as it has rows, as Spark's own listing of a folder holds them on the driver."""
    return sorted(unquote(r[0]) for r in table.select("file").distinct().toLocalIterator())


def read_version(spark: SparkSession, path: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """A version of the store, the last one by default; a folder without versions is read as it is."""
    number = latest(spark, path) if number is None else number
    if number is not None:
        return read_files(spark, path, schema, file_names(version_table(spark, path, number)))
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


# --- the key index ----------------------------------------------------------


def _cell(keys) -> Column:
    return F.pmod(F.hash(*keys), F.lit(CELLS))


def _hashed(keys) -> Column:
    return F.xxhash64(*keys)


def _block(hashed: Column, blocks: Column) -> Column:
    return F.pmod(hashed, blocks.cast("long")).cast("int")


def _probes(keys) -> Column:
    """Bit positions of a key in its block of the filter."""
    second = F.xxhash64(F.lit("probe"), *keys)
    return F.array(*[F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(PROBES)])


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def _index_commit(spark: SparkSession, path: str, rows: DataFrame, commit: str, keys, parts) -> DataFrame:
    """Write the filters of a commit's files; returns the rows of the version table for them. Reads key columns only."""
    keyed = rows.select(F.col("_metadata.file_path").alias("file"), *keys)
    part = F.struct(*parts) if parts else F.struct(F.lit(None).cast("string").alias("none"))
    facts = durable(keyed.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(_cell(keys)).alias("cells"), F.min(F.struct(*keys)).alias("low"),
        F.max(F.struct(*keys)).alias("high"), F.first(part).alias("part"),
    ).withColumn("blocks", F.ceil(F.col("n") / KEYS_PER_BLOCK).cast("int")).withColumn("commit", F.lit(commit)).withColumn("keys", F.array(*[F.lit(k) for k in keys]))
        .withColumn("parts", F.array(*[F.lit(p) for p in parts]).cast("array<string>")))
    placed = keyed.join(facts.select("file", "blocks"), "file").select(
        "file", _block(_hashed(keys), F.col("blocks")).alias("block"), F.explode(_probes(keys)).alias("position")
    )
    placed.groupBy("file", "block").agg(F.bitmap_construct_agg("position").alias("bitmap")).write.parquet(f"{path}/_filters/{commit}")
    return facts


def _filters(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    commits = sorted(r[0] for r in table.select("commit").distinct().collect())
    shape = "file string, block int, bitmap binary"
    return spark.read.schema(shape).parquet(*[f"{path}/_filters/{c}" for c in commits]) if commits else spark.createDataFrame([], shape)


def suspects(spark: SparkSession, path: str, table: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Which file may hold which of the new keys: the key columns and file. Reads the index only, no file of the store.

    A stored key is always among them with its file; another key with a chance of well below one per cent a file.
    """
    key = F.struct(*keys)
    asked = new.select(*keys, _cell(keys).alias("_cell"), _hashed(keys).alias("_hash"), _probes(keys).alias("_probes"))
    heads = table.select("file", "blocks", "low", "high", F.explode("cells").alias("_cell"))
    near = asked.join(heads, "_cell").filter((key >= F.col("low")) & (key <= F.col("high"))).withColumn("block", _block(F.col("_hash"), F.col("blocks")))
    hit = near.join(_filters(spark, path, table), ["file", "block"]).filter(F.forall("_probes", lambda p: _is_set(F.col("bitmap"), p)))
    return durable(hit.select(*keys, "file"))


# --- commits ----------------------------------------------------------------


def publish_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Give a finished folder its name: one rename, which fails if the name is taken."""
    fs, goal = hadoop_path(spark, target)
    fs.mkdirs(goal.getParent())
    jvm = spark._jvm
    kinds = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    source = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(staged))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(source, fs.makeQualified(goal), kinds)


def _publish(spark: SparkSession, path: str, staged: str, number: int) -> None:
    """Make a staged version table the next version; fails if another writer was first."""
    publish_folder(spark, staged, f"{path}/_versions/{number:010d}")


def commit(rows: DataFrame, path: str, keys, parts=(), dead: DataFrame | None = None) -> int:
    """Add ``rows`` as new files and leave out the ``dead`` ones (a frame with ``file``); returns the new version's number.

    ``rows`` may read the store itself, since no live file is touched. Partition columns belong to the key.
    """
    spark = rows.sparkSession
    keys = list(dict.fromkeys([*keys, *parts]))
    before = latest(spark, path)
    name = uuid.uuid4().hex[:16]
    kept = None
    if before is not None:
        kept = version_table(spark, path, before)
        if dead is not None:
            kept = kept.join(durable(dead.select("file").distinct()), "file", "left_anti")
    elif folder_names(spark, path):
        old = spark.read.schema(rows.schema).parquet(path)
        kept = _index_commit(spark, path, old, f"adopted-{name}", keys, parts)
    folder = f"{path}/commit={name}"
    writer = rows.write
    (writer.partitionBy(*parts) if parts else writer).parquet(folder)
    written = spark.read.schema(rows.schema).option("basePath", path).parquet(folder)
    table = _index_commit(spark, path, written, name, keys, list(parts))
    if kept is not None:
        table = kept.unionByName(table)
    number = 0 if before is None else before + 1
    staged = f"{path}/_versions/_staged-{name}"
    table.write.parquet(staged)
    _publish(spark, path, staged, number)
    return number


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions, and the commits and filters that none of these names. Returns the removed folders.

    Not to be run while a writer is at work: what it has staged is named by no version yet.
    """
    numbers = sorted(int(n) for n in folder_names(spark, f"{path}/_versions") if n.isdigit())
    if not numbers:
        return []
    stay = numbers[-keep:]
    tables = [version_table(spark, path, n).select("commit") for n in stay]
    live = set()
    for table in tables:
        live |= {r[0] for r in table.distinct().collect()}
    gone = [f"_versions/{n}" for n in folder_names(spark, f"{path}/_versions") if not (n.isdigit() and int(n) in stay)]
    gone += [n for n in folder_names(spark, path) if n.startswith("commit=") and n.removeprefix("commit=") not in live]
    gone += [f"_filters/{n}" for n in folder_names(spark, f"{path}/_filters") if n not in live]
    for folder in gone:
        fs, target = hadoop_path(spark, f"{path}/{folder}")
        fs.delete(target, True)
    return sorted(gone)

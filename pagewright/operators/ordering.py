"""Exact ordering, running totals and group facts that never gather a group in one task.

A window without a partition key, or over a key that holds a large share of the rows,
runs in one task. The helpers here spread that work: order by range and combine one small row per range. The ranges are either
materialised once, for inputs that are dear to compute or have ties, or cut at stated keys, for inputs that are cheap to read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import durable

SALTS = 256


def _ranged(df: DataFrame, order) -> DataFrame:
    """Globally sorted rows, fixed in place, with the number of their partition."""
    return durable(df.orderBy(*order)).withColumn("_pid", F.spark_partition_id())


def _starts(ranged: DataFrame, amount: Column) -> DataFrame:
    """Total before each partition: one row per partition, so its size is the partition count."""
    per_partition = ranged.groupBy("_pid").agg(F.sum(amount).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per_partition.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))


def with_global_index(df: DataFrame, order, name: str = "idx") -> DataFrame:
    """0-based place of each row in the total order of ``order``."""
    ranged = _ranged(df, order).withColumn(
        "_offset", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    starts = F.broadcast(_starts(ranged, F.lit(1)))
    return ranged.join(starts, "_pid").withColumn(name, F.col("_start") + F.col("_offset")).drop(
        "_pid", "_offset", "_start"
    )


#: Sampled order keys per range, when ranges are cut without storing rows.
KEYS_PER_RANGE = 32


def key_bounds(df: DataFrame, order, ranges: int) -> list:
    """Order keys that cut the rows into about ``ranges`` even parts, each the first key of a part, ascending.

    They are taken from the ``KEYS_PER_RANGE * ranges`` keys with the smallest hash, so the driver sees no more than
    that, and the same rows give the same bounds.
    """
    if ranges < 2:
        return []
    picked = df.select(*order).orderBy(F.xxhash64(*order)).limit(KEYS_PER_RANGE * ranges)
    keys = [tuple(r) for r in picked.orderBy(*order).collect()]
    places = sorted({len(keys) * i // ranges for i in range(1, ranges)} - {0})
    bounds = [keys[p] for p in places if p < len(keys)]
    return [b for i, b in enumerate(bounds) if i == 0 or b != bounds[i - 1]]


def range_number(df: DataFrame, order, bounds: list) -> Column:
    """How many of the ascending ``bounds`` lie at or before a row's order key, found by halving; nulls come first."""
    if not bounds:
        return F.lit(0)
    types = df.select(*order).schema
    cut = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, types, strict=True)]) for b in bounds])
    widths = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, widths)), F.lit(0),
        lambda at, width: F.when(F.get(cut, at + width - 1) <= F.struct(*order), at + width).otherwise(at),
    )


def with_prefix_sum(df: DataFrame, order, amount: Column, name: str, ranges: int | None = None) -> DataFrame:
    """Sum of ``amount`` over the rows up to and including this one in the total order, without storing a row.

    The order keys are read for the bounds of the ranges, then keys and amounts for the total of each range; the rows
    themselves are shuffled once, and each range adds what lies before it. ``ranges`` is ``spark.sql.shuffle.partitions`` unless
    given. ``df`` gives the same rows whenever it is read, and ``order`` tells all rows apart and ascends.
    """
    order = list(order)
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = range_number(df, order, key_bounds(df, order, parts))
    ranged = df.withColumn("_range", number).withColumn("_amount", amount)
    totals = ranged.groupBy("_range").agg(F.sum("_amount").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("_range"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_within", F.sum("_amount").over(upto))
    # One start per range, of which there are ``ranges`` at most.
    return summed.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_within")).drop(
        "_range", "_amount", "_start", "_within"
    )


def with_prefix_index(df: DataFrame, order, name: str = "idx", ranges: int | None = None) -> DataFrame:
    """0-based place of each row in the total order of ``order``, without storing a row; see ``with_prefix_sum``."""
    return with_prefix_sum(df, order, F.lit(1).cast("long"), name, ranges).withColumn(name, F.col(name) - 1)


def with_group_index(df: DataFrame, keys, order, name: str = "idx") -> DataFrame:
    """0-based place of each row within its group: its global index less the first index of its group."""
    keys = list(keys)
    numbered = with_global_index(df, [*keys, *order], "_global")
    firsts = numbered.groupBy(*keys).agg(F.min("_global").alias("_first"))
    placed = attach_group_facts(numbered, firsts, keys, order)
    return placed.withColumn(name, F.col("_global") - F.col("_first")).drop("_global", "_first")


def with_running_sum(df: DataFrame, order, amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` over the rows up to and including this one in the total order."""
    ranged = _ranged(df, order)
    starts = F.broadcast(_starts(ranged, F.col(amount)))
    upto = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(starts, "_pid")
        .withColumn(name, F.col("_start") + F.sum(amount).over(upto))
        .drop("_pid", "_start")
    )


def attach_group_facts(df: DataFrame, facts: DataFrame, keys, spread) -> DataFrame:
    """Left join of one-row-per-group ``facts``, with every group split over salts.

    A row's salt is a hash of its ``spread`` columns. The salts that occur in a group, at most ``SALTS`` of them, fetch the
    group's facts first; the rows then join by group and salt, so a group of any size is spread, as are rows
    with a null key. One plan serves every size.
    """
    keys = list(keys)
    columns = [c for c in facts.columns if c not in keys]
    payload = facts.select(*keys, F.struct(*columns).alias("_fact"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    fetched = salted.select(*keys, "_salt").dropna(subset=keys).distinct().join(payload, keys)
    joined = salted.join(fetched, [*keys, "_salt"], "left")
    return joined.select(*[F.col(c) for c in df.columns], *[F.col(f"_fact.{c}").alias(c) for c in columns])


def at_positions(df: DataFrame, keys, order: str, wanted: Column, width: int = 4096) -> DataFrame:
    """Rows of each group at chosen 0-based places along a whole-number column.

    ``wanted`` is an array expression over ``n``, the group's row count. ``order`` is unique
    within a group. Ranks come from counts per stretch of ``width`` values; only stretches that
    hold a wanted place are ranked row by row, so no task ever holds more than one stretch.
    """
    keys = list(keys)
    stretched = df.withColumn("_stretch", F.floor(F.col(order) / width))
    counts = stretched.groupBy(*keys, "_stretch").agg(F.count(F.lit(1)).alias("_rows"))
    along = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    hits = (
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(along), F.lit(0)))
        .withColumn("n", F.sum("_rows").over(whole))
        .withColumn(
            "_places",
            F.filter(
                F.array_distinct(wanted),
                lambda p: (p >= F.col("_before")) & (p < F.col("_before") + F.col("_rows")),
            ),
        )
        .filter(F.size("_places") > 0)
        .select(*keys, "_stretch", "_before", "_places")
    )
    within = Window.partitionBy(*keys, "_stretch").orderBy(order)
    return (
        stretched.join(hits, [*keys, "_stretch"])
        .withColumn("_place", F.col("_before") + F.row_number().over(within) - 1)
        .filter(F.array_contains("_places", F.col("_place")))
        .select(*df.columns)
    )

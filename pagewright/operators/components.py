"""Connected components of pairs, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import durable


def smallest_members(pairs: DataFrame, keys) -> DataFrame:
    """Pairs (a, b) within groups of ``keys`` to (a label, the smallest label it is connected with, ``merged``).

    Every round hooks each label to its smallest neighbour, follows these hooks to their ends by doubling, and replaces the labels
    of the pairs by the ends; at least half of the labels of a component vanish, so the rounds are few. No component meets in one row.
    """
    keys = list(keys)
    edges = durable(pairs.filter("a <> b").select(*keys, "a", "b").distinct())
    whole = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(*keys, "a").agg(F.min("b").alias("up")).select(*keys, F.col("a").alias("label"), F.least("a", "up").alias("merged"))
        hooks = _followed(durable(hooks), keys)
        ends = {side: hooks.select(*keys, F.col("label").alias(side), F.col("merged").alias(f"_{side}")) for side in "ab"}
        edges = durable(
            edges.join(ends["a"], [*keys, "a"]).join(ends["b"], [*keys, "b"])
            .select(*keys, F.col("_a").alias("a"), F.col("_b").alias("b")).filter("a <> b").distinct()
        )
        if whole is None:
            whole = hooks
        else:
            later = hooks.select(*keys, F.col("label").alias("merged"), F.col("merged").alias("_end"))
            whole = durable(whole.join(later, [*keys, "merged"], "left").select(*keys, "label", F.coalesce("_end", "merged").alias("merged")))
    empty = edges.select(*keys, F.col("a").alias("label"), F.col("b").alias("merged"))
    return empty if whole is None else whole


def _followed(hooks: DataFrame, keys) -> DataFrame:
    """Each label with the end of its chain of hooks."""
    while True:
        further = hooks.select(*keys, F.col("label").alias("merged"), F.col("merged").alias("_next"))
        step = durable(hooks.join(further, [*keys, "merged"], "left").select(*keys, "label", F.coalesce("_next", "merged").alias("_next"), "merged"))
        moved = step.filter("_next <> merged").isEmpty()
        hooks = step.select(*keys, "label", F.col("_next").alias("merged"))
        if moved:
            return hooks

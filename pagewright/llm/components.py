"""Connected components of an edge table: forests of parts of the edges, then alternating large-star and small-star steps."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import durable

#: Edges that a task contracts together.
PART_EDGES = 1 << 17


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Every node of these edges with the smallest one that they reach from it; nodes that are their own smallest have no row."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        for ends in (a, b, least[a], least[b]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if np.array_equal(new, least):
            break
        least = new
    child = least != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(nodes[least[child]])], ["u", "v"])


def _contracted(batches):
    """The edges of a task as stars, ``PART_EDGES`` edges at a time."""
    held, total = [], 0
    for batch in batches:
        held.append([batch[c].to_numpy(zero_copy_only=False) for c in ("u", "v")])
        total += len(batch)
        if total >= PART_EDGES:
            yield _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, total = [], 0
    if held:
        yield _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges to (u, v) with v the smallest node that u reaches; nodes that are their own smallest have no row.

    Each round first turns the edges of every part into stars, so that few edges are left, then joins every node to the minimum of its
    neighbours; minima are partial aggregates and the joins can be split by key, so a node with very many neighbours is no bottleneck. Ends
    when a round changes nothing, or when all edges were one part.
    """
    edges = durable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    before = _state(edges)
    while before[0]:
        parts = ceil(before[0] / PART_EDGES)
        stars = edges.coalesce(parts).mapInArrow(_contracted, "u long, v long")
        if before[0] < PART_EDGES:
            return durable(stars)
        stars = durable(stars)
        both = stars.select("u", "v").unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        edges = durable(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges

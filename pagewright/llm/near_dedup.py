"""Near-duplicate documents by HyperMinHash.

A document's set are the hashes of its word shingles. Equal sets are one class from the start. Each class gets ``BUCKETS`` registers of
16 bits: the leading-zero count of the smallest hash in the bucket and ten bits of its mantissa. Bands of registers are the
candidate keys. Candidates are compared by registers (share of equal ones, less the expected chance collisions), what passes is
confirmed on the full sets.

Only connectivity matters, so links are looked for in two passes. A bucket's pivot is the member that shares most buckets with others, which
is the middle of a family of copies. First every class is checked against the pivot it meets most often. Then, in every bucket
whose members are not yet of one component, registers are compared between components, block by block. Rows that come near another
component are gathered by chains of near components, and the full sets of a chain meet in blocks of bounded size, where a union-find keeps only
links that join something. So rows stay linear in the number of texts, also in families whose pairs all lie just under the
threshold. No bucket is cut, no candidate is dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, mixed, text_bytes, unused, whole_text, word_codes, word_hashes
from pagewright.llm.components import connected_components
from pagewright.session import durable

INDEX_BITS = 8
BUCKETS = 1 << INDEX_BITS
MANTISSA = 10
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21
#: How rarely a pair at the very threshold may share no band.
MISS = 1e-8


def band_rows(similarity: float) -> int:
    """The most registers per band with which a pair at the threshold is missed less often than ``MISS``."""
    return max(r for r in range(1, 17) if r == 1 or (1 - similarity**r) ** (BUCKETS // r) < MISS)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    out = []
    for start, end in chunks(texts):
        codes, starts, distinct = word_codes([t.lower() if t else t for t in texts[start:end]])
        words = word_hashes(distinct)[codes] if distinct else np.zeros(0, np.uint64)
        odd = np.uint64(0x9DDFEA08EB382D69)
        rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for k in range(width):
            rolled = rolled * odd + words[k:len(words) - width + 1 + k] if len(rolled) else rolled
        rolled = mixed(rolled)
        for i in range(end - start):
            a, b = starts[i], starts[i + 1]
            if b - a >= width:
                out.append(np.unique(rolled[a:b - width + 1]))
            elif b > a:
                out.append(np.array([xxhash.xxh64_intdigest(words[a:b].tobytes(), 7)], dtype=np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a set; 0 is an empty bucket."""
    out = np.zeros(BUCKETS, np.uint16)
    if len(hashes):
        rest = hashes << np.uint64(INDEX_BITS)
        exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
        zeros = (54 - exponent).astype(np.uint64)
        mantissa = (rest << np.minimum(zeros, np.uint64(63))) >> np.uint64(64 - MANTISSA)
        value = (zeros << np.uint64(MANTISSA)) | (np.uint64((1 << MANTISSA) - 1) - mantissa)
        np.maximum.at(out, (hashes >> np.uint64(64 - INDEX_BITS)).astype(np.int64), value.astype(np.uint16))
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """Registers folded to one byte, 0 still an empty bucket. Equal ones stay equal, so estimates can only rise."""
    folded = (mixed(values) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return np.where(values > 0, folded, np.uint8(0))


def chance_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers expected to be equal by chance in two disjoint sets of n and m members."""
    ratio = np.minimum(n, m) / np.maximum(np.maximum(n, m), 1)
    return 2.0 ** (INDEX_BITS - MANTISSA) * 0.169919487159739 * 4 * ratio / (1 + ratio) ** 2


def estimates(equal: np.ndarray, used: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates from equal and used registers, corrected for chance collisions."""
    return np.maximum(equal - chance_collisions(n, m), 0) / np.maximum(used, 1)


def _bound(similarity: float) -> float:
    """Estimates from here on are confirmed: six standard deviations under the threshold."""
    return similarity - 6 * math.sqrt(similarity * (1 - similarity) / BUCKETS)


def _whole_runs(batches, keys: list[str]):
    """Tables that hold whole runs of rows with equal keys, from batches sorted by them, with the places where runs start and end."""
    def cut(table):
        columns = [table[c].to_numpy() for c in keys]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if len(table) > 1 else np.zeros(0, int)
        return table, list(zip(np.r_[0, edges], np.r_[edges, len(table)], strict=True))

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        last = len(table) - 1
        if last < 0:
            continue
        start = int(np.argmax(np.all([table[c].to_numpy() == table[c][last].as_py() for c in keys], axis=0)))
        if start:
            yield cut(table.slice(0, start))
        held = table.slice(start)
    if held is not None and len(held):
        yield cut(held)


def _root(parents: np.ndarray, i: int) -> int:
    while parents[i] != i:
        parents[i] = parents[parents[i]]
        i = parents[i]
    return int(i)


def _near_rows(batches, similarity: float):
    """Of each run of rows with the same (band, low, high), the rows whose registers come near a row of another component.

    Each such row once: (rep, u, v) with u its component and v the smallest component that near rows chain it to.
    """
    bound = _bound(similarity)
    for table, runs in _whole_runs(batches, ["band", "low", "high"]):
        ids, comps, sizes, blocks = (table[c].to_numpy() for c in ("rep", "comp", "n", "block"))
        low, high = table["low"].to_numpy(), table["high"].to_numpy()
        regs = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint8).reshape(-1, BUCKETS)
        out = []
        for a, b in runs:
            places = np.arange(a, b)
            names, which, many = np.unique(comps[a:b], return_inverse=True, return_counts=True)
            if len(names) < 2:
                continue
            largest, parents, near_rows = which == many.argmax(), np.arange(len(names)), np.zeros(b - a, bool)
            # Rows outside the largest component meet all rows of other components, each pair once.
            for i in places[~largest]:
                others = places[(largest | (places > i)) & (which != which[i - a])]
                others = others[blocks[others] != blocks[i]] if low[a] != high[a] else others
                small, large = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
                others = others[small >= similarity * large]
                if len(others):
                    equal = ((regs[others] == regs[i]) & (regs[i] > 0)).sum(axis=1)
                    used = ((regs[others] > 0) | (regs[i] > 0)).sum(axis=1)
                    near = others[estimates(equal, used, sizes[i], sizes[others]) >= bound]
                    if len(near):
                        near_rows[near - a] = near_rows[i - a] = True
                        for c in np.unique(which[near - a]):
                            x, y = _root(parents, which[i - a]), _root(parents, c)
                            parents[max(x, y)] = min(x, y)
            roots = np.array([_root(parents, k) for k in range(len(names))])
            out.append((ids[a:b][near_rows], comps[a:b][near_rows], names[roots[which[near_rows]]]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rep", "u", "v"])


def _set_links(batches, percent: int):
    """Of each run of rows with the same (cluster, low, high), links between components that join them, confirmed on the full sets.

    Intersections come from the posting lists of the run's shingles. A link inside what is joined already is left out, so a run of n rows
    gives at most n - 1 links, however many pairs are near.
    """
    for table, runs in _whole_runs(batches, ["cluster", "low", "high"]):
        every, comps = table["rep"].to_numpy(), table["comp"].to_numpy()
        left, right = [], []
        for a, b in runs:
            ids = every[a:b]
            _, which, many = np.unique(comps[a:b], return_inverse=True, return_counts=True)
            if len(many) < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].slice(a, b - a).to_pylist()]
            sizes = np.array([len(s) for s in sets])
            starts = np.r_[0, np.cumsum(sizes)]
            _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            owners = np.repeat(np.arange(b - a), sizes)[np.argsort(codes, kind="stable")]
            lists = np.r_[0, np.cumsum(counts)]
            parents = np.arange(len(many))
            for i in np.flatnonzero(which != many.argmax()):
                mine = codes[starts[i]:starts[i + 1]]
                mine = mine[counts[mine] > 1]
                long = counts[mine]
                at = np.repeat(lists[mine] - np.r_[0, np.cumsum(long)][:-1], long) + np.arange(long.sum())
                both = np.bincount(owners[at], minlength=b - a)
                for j in np.flatnonzero((100 * both >= percent * (sizes[i] + sizes - both)) & (which != which[i])):
                    x, y = _root(parents, which[i]), _root(parents, which[j])
                    if x != y:
                        parents[max(x, y)] = min(x, y)
                        left.append(min(ids[i], ids[j]))
                        right.append(max(ids[i], ids[j]))
        yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in (left, right)], ["u", "v"])


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (u, v) pairs whose sets have 100 * intersection >= 100 * similarity * union."""
    percent = round(similarity * 100)

    def confirm(batches):
        for batch in batches:
            keep = []
            for su, sv in zip(batch["su"].to_pylist(), batch["sv"].to_pylist(), strict=True):
                a, b = np.frombuffer(su, np.uint64), np.frombuffer(sv, np.uint64)
                close = 100 * min(len(a), len(b)) >= percent * max(len(a), len(b))
                both = len(np.intersect1d(a, b, assume_unique=True)) if close else 0
                keep.append(bool(both) and 100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("su"))
    two = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("sv"))
    return pairs.join(one, "u").join(two, "v").mapInArrow(confirm, "u long, v long")


def _cluster_blocks(near: DataFrame, clusters: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """The rows of each cluster dealt into pairs of chunks: every row outside the cluster's largest component meets every row.

    A chunk has about ``block`` rows and ``BLOCK_SHINGLES`` shingles. Rows of the largest component need not meet one another, so
    their copies grow with the other rows only.
    """
    rows = (
        near.select("rep", F.col("u").alias("comp")).distinct().join(sizes, "rep")
        .join(clusters.select(F.col("u").alias("comp"), F.col("v").alias("cluster")), "comp", "left")
        .withColumn("cluster", F.coalesce("cluster", "comp"))
    )
    parts = rows.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
    main = F.max(F.struct("m", (-F.col("comp")).alias("minus"), "w"))
    facts = parts.groupBy("cluster").agg(main.alias("main"), F.sum("m").alias("m"), F.sum("w").alias("w")).select(
        "cluster", (-F.col("main.minus")).alias("main"),
        F.greatest(F.ceil((F.col("m") - F.col("main.m")) / block), F.ceil((F.col("w") - F.col("main.w")) / BLOCK_SHINGLES)).alias("few"),
        F.greatest(F.ceil(F.col("main.m") / block), F.ceil(F.col("main.w") / BLOCK_SHINGLES)).alias("most"),
    )
    inside = F.col("comp") == F.col("main")
    mixed_id = F.xxhash64("rep", F.lit(1))
    return (
        rows.join(facts, "cluster")
        .withColumn("block", F.when(inside, F.col("few") + F.pmod(mixed_id, "most")).otherwise(F.pmod(mixed_id, "few")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("few")).otherwise(F.col("few") + F.col("most")) - 1)))
        .select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "rep", "comp")
    )


def near_classes(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, block: int = BLOCK, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents with Jaccard similarity of at least ``similarity`` (in whole per cent) are linked; ``component_id`` is the smallest id that a
    document reaches. A text with fewer than ``width`` words is one shingle; a null or empty text has none and stays alone.
    Repeated rows are one class; ids must be whole numbers, a row without id is linked like any other, but is never kept.
    """

    def sketch(batches):
        for batch in batches:
            sets = shingle_sets(text_bytes(batch["text"]), width)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            ], ["doc_id", "n", "digest", "registers"])

    def full(batches):
        for batch in batches:
            sets = shingle_sets(text_bytes(batch["text"]), width)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "shingles"]
            )

    per_band = band_rows(similarity)

    def bands(batches):
        for batch in batches:
            if not len(batch):
                continue
            regs = np.frombuffer(b"".join(batch["registers"].to_pylist()), np.uint16).reshape(-1, BUCKETS)
            ids = batch["rep"].to_numpy(zero_copy_only=False)
            for k in range(BUCKETS // per_band):
                part = regs[:, k * per_band:(k + 1) * per_band].astype(np.uint64)
                key = np.full(len(ids), k + 1, np.uint64)
                for c in range(per_band):
                    key = mixed(key * np.uint64(0x9DDFEA08EB382D69) + part[:, c] + np.uint64(1))
                some = part.any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array(ids[some])], ["band", "rep"])

    def narrowed(batches):
        for batch in batches:
            marks = [narrow(np.frombuffer(r, np.uint16)).tobytes() for r in batch["registers"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["rep"], batch["n"], pa.array(marks, pa.binary())], ["rep", "n", "marks"])

    texts = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    sketches = durable(texts.mapInArrow(sketch, "doc_id long, n long, digest binary, registers binary"))
    # Classes are named by a row number, which the checkpoint fixes: ids may repeat or be null.
    rows = sketches.filter("n > 0").withColumn("row", F.monotonically_increasing_id())
    classes = durable(rows.groupBy("digest", "n").agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("first_id"), F.any_value("registers").alias("registers")
    ))
    banded = classes.select("rep", "registers").mapInArrow(bands, "band long, rep long")
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = durable(banded.join(shared, "band"))
    degrees = members.groupBy("rep").agg(F.sum("m").alias("degree"))
    pivots = members.join(degrees, "rep").groupBy("band").agg(
        F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("pivot")
    )
    wanted = members.select("rep").distinct().join(classes, "rep").select("rep", "digest", "first_id")
    known = wanted.select("first_id").distinct()
    sets = durable(
        texts.join(known, texts["doc_id"].eqNullSafe(known["first_id"]), "left_semi").select("text")
        .mapInArrow(full, "digest binary, shingles binary")
        .groupBy("digest").agg(F.any_value("shingles").alias("shingles"))
        .join(wanted, "digest").select("rep", "shingles")
    )
    best = (
        members.join(pivots, "band").filter("rep <> pivot").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("hits"))
        .groupBy("rep").agg(F.max_by("pivot", F.struct("hits", -F.col("pivot"))).alias("pivot"))
        .select(F.col("pivot").alias("u"), F.col("rep").alias("v"))
    )
    first = durable(_confirmed(best, sets, similarity))
    found = connected_components(first)

    labelled = members.join(found.withColumnRenamed("u", "rep"), "rep", "left").select(
        "band", "rep", "m", F.coalesce("v", "rep").alias("comp")
    )
    # Rows outside the largest component of a band meet every row of it; rows of the largest one do not meet one another.
    counts = labelled.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("own"), F.first("m").alias("m"))
    open_bands = counts.groupBy("band", "m").agg(F.max(F.struct("own", (-F.col("comp")).alias("minus"))).alias("main")).filter("main.own < m").select(
        "band", (-F.col("main.minus")).alias("main"),
        F.ceil((F.col("m") - F.col("main.own")) / block).alias("few"), F.ceil(F.col("main.own") / block).alias("most"),
    )
    inside, mixed_id = F.col("comp") == F.col("main"), F.xxhash64("rep")
    blocks = (
        labelled.join(open_bands, "band")
        .withColumn("block", F.when(inside, F.col("few") + F.pmod(mixed_id, "most")).otherwise(F.pmod(mixed_id, "few")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("few")).otherwise(F.col("few") + F.col("most")) - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .join(classes.select("rep", "n", "registers").mapInArrow(narrowed, "rep long, n long, marks binary"), "rep")
        .select("band", "low", "high", "block", "rep", "comp", "n", "marks")
        .repartition("band", "low", "high").sortWithinPartitions("band", "low", "high", "rep")
    )
    near = durable(blocks.mapInArrow(lambda b: _near_rows(b, similarity), "rep long, u long, v long").distinct())
    dealt = _cluster_blocks(near, connected_components(near.select("u", "v")), classes.select("rep", "n"), block)
    percent = round(similarity * 100)
    second = durable(
        dealt.join(sets, "rep").repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "rep")
        .mapInArrow(lambda b: _set_links(b, percent), "u long, v long")
    )
    final = connected_components(found.unionByName(second)).withColumnRenamed("u", "rep").withColumnRenamed("v", "root")
    rooted = classes.select("digest", "n", "rep", "first_id").join(final, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    settled = rooted.join(smallest, "root").select("digest", "n", "component_id")
    placed = sketches.select("doc_id", "n", "digest").join(settled, ["digest", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all their columns.

    A row without id is named by a hash of its text, which sorts behind usual ids: it stays when its class has no smaller name, and of
    equal texts without id one row stays; texts without shingles all stay. Columns of any name are kept.
    """
    name, kept_id, shingles = unused(docs, "_name", "_id", "_n")
    id_column = options.get("id_column", "doc_id")
    hashed = F.shiftrightunsigned(F.xxhash64(whole_text(options.get("text_column", "text"))), 2).bitwiseOR(1 << 62)
    named = docs.withColumn(name, F.coalesce(F.col(id_column), hashed))
    classes = near_classes(named, **{**options, "id_column": name}).filter("kept")
    stay = durable(classes.groupBy(F.col("doc_id").alias(kept_id)).agg(F.max("n_shingles").alias(shingles)))
    with_id, without = named.filter(F.col(id_column).isNotNull()), named.filter(F.col(id_column).isNull())
    same = F.col(name) == F.col(kept_id)
    found = without.join(stay, same)
    parts = [with_id.join(stay, same, "left_semi"), found.filter(F.col(shingles) == 0), found.filter(F.col(shingles) > 0).dropDuplicates([name])]
    whole = [part.select(*docs.columns) for part in parts]
    return whole[0].unionByName(whole[1]).unionByName(whole[2])

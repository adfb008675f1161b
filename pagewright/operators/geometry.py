"""Pages as long tables of pixels, cells and word boxes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright import fixed_values as V
from pagewright.functions import imaging
from pagewright.operators.components import smallest_members
from pagewright.operators.inventory import even_pages
from pagewright.session import durable


def _rgb():
    return F.col("r"), F.col("g"), F.col("b")


def cell_histogram(pixels: DataFrame, keys=("page",), cell: int = V.CELL) -> DataFrame:
    """Ink, highlight and dark pixel counts and ink colour sums per square cell."""
    top, dull = imaging.brightness(*_rgb()), imaging.saturation(*_rgb()) < V.MIN_SATURATION
    staged = pixels.filter((top < V.DARK_BELOW) | ~dull).select(
        *keys, "x", "y", *_rgb(), imaging.pixel_class(*_rgb()).alias("_k")
    )
    ink = F.col("_k") == "ink"
    sums = [F.sum(F.when(ink, F.col(c)).otherwise(0)).alias(f"{c}_sum") for c in ("r", "g", "b")]
    return staged.groupBy(
        *keys, F.floor(F.col("x") / cell).cast("int").alias("cx"), F.floor(F.col("y") / cell).cast("int").alias("cy")
    ).agg(
        F.count_if(ink).alias("ink"), F.count_if(F.col("_k") == "hl").alias("hl"),
        F.count_if(F.col("_k") == "dark").alias("dark"), *sums,
    ).filter(F.col("ink") + F.col("hl") + F.col("dark") > 0)


def page_histogram(cells: DataFrame, keys=("page",)) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.sum(c).alias(f"{c}_px") for c in ("ink", "hl", "dark")])


TILE = 256
SPAN = 64


def tile_labels(tile, row, column):
    """Label of every cell: the number of the first cell of its 8-connected component within its tile; cells come in order of
    tile, row and column.

    Cells of a row that stand side by side are one run. Runs of neighbouring rows that touch are pairs; runs take the smaller
    label of a pair and then the label of their label until nothing changes.
    """
    if not len(row):
        return np.zeros(0, np.int64)
    wide = int(column.max()) + 4
    line = (tile * (int(row.max()) + 2) + row) * wide
    fresh = np.r_[True, np.diff(line + column) != 1]
    run = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(row)] - 1
    begin, end = (line + column)[first] + 1, (line + column)[last] + 1
    # In the row below, the runs that reach from one place before the run to one after it.
    low = np.searchsorted(end, begin + wide - 1, "left")
    high = np.searchsorted(begin, end + wide + 1, "right")
    touching = np.maximum(high - low, 0)
    upper = np.repeat(np.arange(len(first)), touching)
    lower = np.arange(len(upper)) - np.repeat(np.cumsum(touching) - touching, touching) + np.repeat(low, touching)
    label = np.arange(len(first))
    while True:
        a, b = label[upper], label[lower]
        if (a == b).all():
            return first[label][run]
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label[label] != label).any():
            label = label[label]


LABELS = T.ArrayType(T.LongType())


def _labels_of_tiles(tiles: pd.Series) -> pd.Series:
    """Tiles as ascending arrays of cells (row << 32 | column) to the same with labels, which are cells as well."""
    sizes = tiles.map(len).to_numpy()
    if not len(sizes):
        return pd.Series([], dtype=object)
    cells, starts = np.concatenate(tiles.to_list()), np.cumsum(sizes) - sizes
    tile = np.repeat(np.arange(len(sizes)), sizes)
    # Places count from the tile's own corner, so that numbers stay small on pages of any size.
    row = (cells >> 32) - np.repeat(cells[starts] >> 32, sizes)
    column = cells & 0xFFFFFFFF
    column = column - np.repeat(np.minimum.reduceat(column, starts), sizes)
    labels = cells[tile_labels(tile, row, column)]
    return pd.Series(np.split(labels, starts[1:]))


def label_components(cells: DataFrame, amount: str, cell_min: int, keys=("page",), tile: int = TILE) -> DataFrame:
    """Active cells with the label of their 8-connected component.

    Cells connect within square tiles first: a tile's cells travel as one array of at most
    tile x tile numbers, many tiles to a batch, and are labelled together. Then the labels that touch across tile borders
    are merged by joins, so no page meets in one row. A page of ordinary size is one tile and has no borders.
    """
    keys = list(keys)
    rest = [c for c in cells.columns if c not in keys]
    active = cells.filter(F.col(amount) >= cell_min).withColumn(
        "cell_id", F.shiftleft(F.col("cy").cast("long"), 32) + F.col("cx")
    )
    tiles = active.groupBy(
        *keys, F.floor(F.col("cx") / tile).alias("_tx"), F.floor(F.col("cy") / tile).alias("_ty")
    ).agg(F.sort_array(F.collect_list(F.struct("cell_id", *rest))).alias("_cells"))
    labelled = tiles.withColumn("_labels", F.pandas_udf(_labels_of_tiles, LABELS)(F.col("_cells.cell_id")))
    local = durable(
        labelled.select(*keys, "_tx", "_ty", F.explode(F.arrays_zip("_cells", "_labels")).alias("_z")).select(
            *keys, "_tx", "_ty", *[F.col(f"_z._cells.{c}").alias(c) for c in rest], F.col("_z._labels").alias("label")
        )
    )
    edge = (F.pmod("cx", F.lit(tile)).isin(0, tile - 1)) | (F.pmod("cy", F.lit(tile)).isin(0, tile - 1))
    border = local.filter(edge).select(*keys, "cx", "cy", "_tx", "_ty", "label")
    steps = F.array(*[
        F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy
    ])
    reach = border.select(*keys, F.col("label").alias("a"), "_tx", "_ty", "cx", "cy", F.explode(steps).alias("_d")).select(
        *keys, "a", (F.col("cx") + F.col("_d.dx")).alias("cx"), (F.col("cy") + F.col("_d.dy")).alias("cy"), "_tx", "_ty",
    ).filter((F.floor(F.col("cx") / tile) != F.col("_tx")) | (F.floor(F.col("cy") / tile) != F.col("_ty")))
    pairs = reach.drop("_tx", "_ty").join(border.withColumnRenamed("label", "b"), [*keys, "cx", "cy"]).select(*keys, "a", "b").distinct()
    merged = smallest_members(pairs, keys)
    return (
        local.join(merged, [*keys, "label"], "left")
        .withColumn("component", F.coalesce("merged", "label"))
        .select(*keys, *rest, "component")
    )


def component_boxes(
    cells: DataFrame, amount: str, cell_min: int, box_min: int, keys=("page",), cell: int = V.CELL, hue: bool = False
) -> DataFrame:
    """Bounding box, pixel count and optionally mean hue of each component worth keeping."""
    labelled = label_components(cells, amount, cell_min, keys)
    sums = [F.sum(f"{c}_sum").alias(f"_{c}") for c in ("r", "g", "b")] if hue else []
    boxes = labelled.groupBy(*keys, "component").agg(
        (F.min("cx") * cell).alias("x"),
        (F.min("cy") * cell).alias("y"),
        ((F.max("cx") - F.min("cx") + 1) * cell).alias("w"),
        ((F.max("cy") - F.min("cy") + 1) * cell).alias("h"),
        F.sum(amount).alias("px"),
        *sums,
    ).filter(F.col("px") >= box_min)
    if hue:
        mean = [imaging.round_half_up(F.col(f"_{c}") / F.col("px")) for c in ("r", "g", "b")]
        boxes = boxes.withColumn("hue", imaging.hue_name(*mean)).drop("_r", "_g", "_b")
    return boxes.drop("component")


def ink_boxes(cells: DataFrame, keys=("page",)) -> DataFrame:
    return component_boxes(cells, "ink", V.INK_CELL, V.INK_BOX, keys, hue=True)


def hl_boxes(cells: DataFrame, keys=("page",)) -> DataFrame:
    return component_boxes(cells, "hl", V.HL_CELL, V.HL_BOX, keys)


def page_levels(pages: DataFrame, ink: DataFrame, hl: DataFrame, keys=("page",)) -> DataFrame:
    """Box counts, text-shaped box counts and emphasis level per page, pages without boxes included."""
    shaped = imaging.text_shaped(F.col("w"), F.col("h"), F.col("px"))
    both = ink.select(*keys, shaped.alias("_t"), F.lit(True).alias("_ink")).unionByName(
        hl.select(*keys, shaped.alias("_t"), F.lit(False).alias("_ink"))
    )
    is_ink, text_like = F.col("_ink"), F.col("_t")
    per = both.groupBy(*keys).agg(
        F.count_if(is_ink).alias("n_ink"), F.count_if(~is_ink).alias("n_hl"),
        F.count_if(is_ink & text_like).alias("text_ink"), F.count_if(~is_ink & text_like).alias("text_hl"),
    )
    full = pages.select(*keys).join(per, list(keys), "left").fillna(0, ["n_ink", "n_hl", "text_ink", "text_hl"])
    return full.withColumn("level", imaging.emphasis_level(F.col("text_ink"), F.col("text_hl")))


def hue_totals(ink: DataFrame, keys=("page",), top: int = V.HUE_BOXES) -> DataFrame:
    """Ink pixels per hue over the largest boxes of each page (long form)."""
    order = Window.partitionBy(*keys).orderBy(F.desc("px"), "y", "x", "w", "h", "hue")
    largest = ink.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= top)
    return largest.groupBy(*keys, "hue").agg(F.sum("px").alias("px"))


def hue_map(totals: DataFrame, keys=("page",)) -> DataFrame:
    """The totals as one map per page; there are six hue names."""
    return totals.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("hue", "px"))).alias("hues"))


def underline_hints(pixels: DataFrame, sizes: DataFrame, keys=("page",)) -> DataFrame:
    """Thin dark horizontal runs with text above and a clear pixel over their middle.

    ``sizes`` has width and height per page. Runs are islands of neighbouring dark pixels in a
    pixel row; every test after that holds runs against runs by equal pixel row and stretch of columns.
    """
    keys = list(keys)
    dark = pixels.filter(imaging.brightness(*_rgb()) < V.RULE_DARK_BELOW).select(*keys, "x", "y")
    island = F.col("x") - F.row_number().over(Window.partitionBy(*keys, "y").orderBy("x"))
    runs = dark.withColumn("_i", island).groupBy(*keys, "y", "_i").agg(
        F.min("x").alias("x"), F.count(F.lit(1)).cast("int").alias("len")
    ).drop("_i")
    size = sizes.select(*keys, "width", "height")
    longest = imaging.round_half_up(F.col("width") * 0.6)
    fit = (
        runs.join(size, keys)
        .filter((F.col("y") >= 2) & (F.col("y") < F.col("height") - 6))
        .filter((F.col("len") >= 45) & (F.col("len") <= longest))
        .withColumn("mid", F.col("x") + F.shiftright("len", 1))
    )
    # Dark runs by pixel row and stretch of SPAN columns: what lies at a place, or over a run, is found by equal keys.
    stretches = F.sequence(F.floor(F.col("x") / SPAN), F.floor((F.col("x") + F.col("len") - 1) / SPAN))
    held = runs.select(*keys, F.col("y").alias("_py"), F.col("x").alias("_from"), (F.col("x") + F.col("len") - 1).alias("_to"), F.explode(stretches).alias("_span"))
    # Five places per run decide thickness: the one above must be clear, and one of four below.
    probes = fit.select(*keys, "x", "y", "len", "mid", F.explode(F.array(*[F.lit(d) for d in (-1, 1, 2, 3, 4)])).alias("_dy")).select(
        "*", (F.col("y") + F.col("_dy")).alias("_py"), F.floor(F.col("mid") / SPAN).alias("_span")
    )
    at = [*keys, "_py", "_span"]
    dark_at = probes.join(held, at).filter(F.col("mid").between(F.col("_from"), F.col("_to"))).select(*keys, "x", "y", "len", "_dy")
    seen = dark_at.groupBy(*keys, "x", "y", "len").agg(F.count_if(F.col("_dy") < 0).alias("_up"), F.count_if(F.col("_dy") > 0).alias("_down"))
    thick = seen.filter((F.col("_up") > 0) | (F.col("_down") >= 4))
    thin = fit.select(*keys, "x", "y", "len").join(thick, [*keys, "x", "y", "len"], "left_anti")
    rows = thin.select("*", F.explode(F.sequence(F.lit(4), F.least(F.lit(34), F.col("y")))).alias("_dy"), stretches.alias("_spans")).filter(F.col("_dy") <= F.col("y"))
    windows = rows.select(*keys, "x", "y", "len", "_dy", (F.col("y") - F.col("_dy")).alias("_py"), F.explode("_spans").alias("_span"))
    # Every third column of the run counts: the first of them within the overlap must not lie behind it.
    low = F.greatest("x", "_from")
    third = low + F.pmod(F.col("x") - low, F.lit(3))
    over = windows.join(held, at).filter(third <= F.least(F.col("_to"), F.col("x") + F.col("len") - 1))
    return over.groupBy(*keys, "x", "y", "len").agg(F.count_distinct("_dy").alias("_above")).filter("_above >= 8").drop("_above")


def ink_map(pixels: DataFrame) -> DataFrame:
    """Coloured pixels kept, everything else faded to light gray."""
    r, g, b = _rgb()
    top = imaging.brightness(r, g, b)
    keep = (imaging.saturation(r, g, b) >= V.MIN_SATURATION) & (top >= 60)
    # 200 + round(top / 255 * 55), in whole numbers.
    gray = (200 + F.floor((top * 110 + 255) / 510)).cast("int")
    return pixels.withColumns({c: F.when(keep, F.col(c)).otherwise(gray) for c in ("r", "g", "b")})


def rotate_coords(pixels: DataFrame, sizes: DataFrame, degrees: Column | int, keys=("page",)) -> DataFrame:
    """Pixel places after a clockwise turn by 0, 90, 180 or 270 degrees."""
    turn = degrees if isinstance(degrees, Column) else F.lit(degrees)
    turn = F.pmod(F.pmod(turn, F.lit(360)) + 360, F.lit(360))
    w, h, x, y = F.col("width"), F.col("height"), F.col("x"), F.col("y")
    nx = F.when(turn == 90, h - 1 - y).when(turn == 180, w - 1 - x).when(turn == 270, y).otherwise(x)
    ny = F.when(turn == 90, x).when(turn == 180, h - 1 - y).when(turn == 270, w - 1 - x).otherwise(y)
    joined = pixels.join(sizes.select(*keys, "width", "height"), list(keys))
    return joined.withColumns({"x": nx, "y": ny}).drop("width", "height")


def page_rotation(words: DataFrame, keys=("doc_id", "page"), stretch: int = 4096) -> DataFrame:
    """Turn that sets a page upright: 0, 90 or 270 degrees.

    Steps between neighbouring words are taken within stretches of the reading order, and the
    step from one stretch to the next from their end values, so a page of any number of words
    is never one group.
    """
    keys = list(keys)
    boxes = words.filter(F.col("n_chars") >= 2).withColumn("_part", F.floor(F.col("seq") / stretch))
    along = Window.partitionBy(*keys, "_part").orderBy("seq")
    step = F.col("y") - F.lag("y").over(along)
    parts = (
        boxes.withColumn("_step", step)
        .groupBy(*keys, "_part")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(F.col("h") > F.col("w")).alias("_tall"),
            F.count_if(F.col("_step") >= 1).alias("_down"),
            F.count_if(F.col("_step") <= -1).alias("_up"),
            F.min_by("y", "seq").alias("_y0"),
            F.max_by("y", "seq").alias("_y1"),
        )
    )
    jump = F.col("_y0") - F.lag("_y1").over(Window.partitionBy(*keys).orderBy("_part"))
    whole = parts.withColumn("_jump", jump).groupBy(*keys).agg(
        F.sum("_n").alias("words"),
        F.sum("_tall").alias("_tall"),
        (F.sum("_down") + F.count_if(F.col("_jump") >= 1)).alias("_down"),
        (F.sum("_up") + F.count_if(F.col("_jump") <= -1)).alias("_up"),
    )
    share = F.lit(str(V.TALL_SHARE)).cast("decimal(18,9)")
    degrees = (
        F.when(F.col("words") < V.MIN_WORDS, 0)
        .when(F.col("_tall") < F.col("words") * share, 0)
        .when(F.col("_down") >= F.col("_up"), 270)
        .otherwise(90)
    )
    return whole.select(*keys, "words", degrees.alias("degrees"))


def doc_rotation(docs: DataFrame, rotations: DataFrame, key: str = "doc_id", sample: int = V.ROTATION_PAGES) -> DataFrame:
    """Majority turn over evenly spread pages; the first seen wins a tie, unread pages count as 0."""
    picked = docs.select(key, F.explode(even_pages(F.col("pages"), sample)).alias("page"))
    votes = (
        picked.join(rotations.select(key, "page", "degrees"), [key, "page"], "left")
        .withColumn("degrees", F.coalesce("degrees", F.lit(0)))
        .groupBy(key, "degrees")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("page").alias("_first"))
    )
    best = F.max_by("degrees", F.struct(F.col("_n"), -F.col("_first")))
    return votes.groupBy(key).agg(best.alias("degrees"))


def rotation_audit(docs: DataFrame, turned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rotated documents and pages per subject; the row with a null subject is the total."""
    hits = docs.join(turned.filter("degrees <> 0"), key)
    return hits.rollup("subject_key").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"))


def rotated_top(docs: DataFrame, turned: DataFrame, key: str = "doc_id", limit: int = 20) -> DataFrame:
    return docs.join(turned.filter("degrees <> 0"), key).orderBy(F.desc("pages"), key).limit(limit)

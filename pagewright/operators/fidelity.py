"""Fidelity of a candidate text against a truth text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import text
from pagewright.operators.ordering import with_global_index, with_running_sum
from pagewright.session import durable


def with_shingles(df: DataFrame, truth: str = "truth", got: str = "got", k: int = V.SHINGLE) -> DataFrame:
    """Normalised lengths and shingle sets of both texts, which are dropped; adds ``same``.

    A candidate equal to its truth takes over the truth's values. The shingle source differs from
    the normalised text only where a break tag can occur, so both come from one pass otherwise.
    """
    t, g, same = F.col(truth), F.col(got), F.col("same")
    one = text.pinned(df, same=t == g, _t=text.normalize_text(t))
    two = text.pinned(one, _g=F.when(same, F.col("_t")).otherwise(text.normalize_text(g)))

    def grams(raw: Column, clean: Column) -> Column:
        return text.grams(F.when(raw.contains("<"), text.shingle_source(raw)).otherwise(clean), k)

    three = text.pinned(two, truth_grams=grams(t, F.col("_t")))
    four = text.pinned(three, got_grams=F.when(same, F.col("truth_grams")).otherwise(grams(g, F.col("_g"))))
    lengths = {"truth_len": F.length("_t"), "got_len": F.length("_g")}
    return four.withColumns(lengths).drop(truth, got, "_t", "_g")


def fidelity(df: DataFrame, truth: str = "truth", got: str = "got", missed: bool = True) -> DataFrame:
    """Shingle recall and precision (in 1/10000) per row, with the first missed shingles."""
    keep = [c for c in df.columns if c not in (truth, got)]
    t, g = F.col("truth_grams"), F.col("got_grams")
    extra = {"missed": missed_shingles(t, g)} if missed else {}
    counted = text.pinned(
        with_shingles(df, truth, got),
        hits=F.when(F.col("same"), F.size(t)).otherwise(F.size(F.array_intersect(t, g))),
        truth_tokens=F.size(t), got_tokens=F.size(g), **extra,
    )
    rates = text.overlap_of_counts(F.col("hits"), F.col("truth_tokens"), F.col("got_tokens"))
    return counted.withColumn("_o", rates).select(
        *keep, "truth_len", "got_len", "truth_tokens", "got_tokens", *extra, "_o.*"
    )


def missed_shingles(truth: Column, got: Column, limit: int = V.MISSED_LIMIT) -> Column:
    """First truth shingles the candidate lacks, in first-seen order."""
    return F.slice(F.array_except(truth, got), 1, limit)


def fidelity_exploded(df: DataFrame, keys, truth: str = "truth", got: str = "got") -> DataFrame:
    """The same rates through one row per (key, gram), for texts too large for one array pair."""
    keys = list(keys)
    sides = text.pinned(df, _t=text.shingles(F.col(truth)), _g=text.shingles(F.col(got)))
    both = F.array(*[F.struct(F.col(side).alias("grams"), F.lit(bit).alias("_bit")) for side, bit in (("_t", 1), ("_g", 2))])
    flagged = sides.select(*keys, F.inline(both)).select(*keys, "_bit", F.explode("grams").alias("gram"))
    seen = flagged.groupBy(*keys, "gram").agg(F.bit_or("_bit").alias("_in"))
    counts = seen.groupBy(*keys).agg(
        F.count_if(F.col("_in") == 3).alias("hits"),
        F.count_if(F.col("_in") != 2).alias("truth_tokens"),
        F.count_if(F.col("_in") != 1).alias("got_tokens"),
    )
    full = df.select(*keys).join(counts, keys, "left").fillna(0, ["hits", "truth_tokens", "got_tokens"])
    rates = text.overlap_of_counts(F.col("hits"), F.col("truth_tokens"), F.col("got_tokens"))
    return full.withColumn("_o", rates).select(*keys, "truth_tokens", "got_tokens", "_o.*")


#: Texts whose differing middle is longer than this are searched in bands, shorter ones take the whole matrix.
LONG_MIDDLE = 4096
FIRST_BAND = 64


def _within(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance of two arrays if it is at most ``band``, else a larger number; cells off the diagonal by more than that are never touched."""
    if abs(len(a) - len(b)) > band:
        return band + 1
    along = np.arange(2 * band + 1)
    edge = np.full(band, -1, np.int64)
    padded = np.concatenate([edge, b, edge, edge])
    row = np.where(along >= band, along - band, 4 * band + len(a))
    for i in range(len(a)):
        turned = row + (padded[i:i + 2 * band + 1] != a[i])
        turned[:-1] = np.minimum(turned[:-1], row[1:] + 1)
        row = np.minimum.accumulate(turned - along) + along
        if row.min() > band:
            return band + 1
    return int(row[len(b) - len(a) + band])


def _banded_distance(truth: pd.Series, got: pd.Series) -> pd.Series:
    """Edit distances from bands that get four times as wide until the distance fits in; null where a side is null."""
    out = []
    for pair in zip(truth, got, strict=True):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        a, b = (np.frombuffer(side.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for side in pair)
        band = FIRST_BAND
        while (found := _within(a, b, band)) > band:
            band *= 4
        out.append(found)
    return pd.Series(out, dtype="Int32")


def edit_distance(df: DataFrame, truth: str = "truth", got: str = "got", threshold: int | None = None) -> DataFrame:
    """Levenshtein distance of the normalised texts, as ``distance``, and ``truth_len``.

    With a ``threshold`` larger distances are given as -1, which bounds the work per row.

    Shared ends never change the distance. They are cut first, so the quadratic part runs over
    the differing middle only, which is short for faithful copies. Every step is a column of
    its own because the prefix search reads its inputs many times. Long middles are searched in bands that get four times as wide
    until the distance fits in, so their work grows with length x distance.
    """
    keep = [c for c in df.columns if c not in (truth, got)]
    staged = text.pinned(
        df, _a=text.normalize_text(F.col(truth)), _b=text.normalize_text(F.col(got))
    ).withColumn("truth_len", F.length("_a"))
    for _ in range(2):
        staged = staged.withColumn("_same", text.common_prefix_length(F.col("_a"), F.col("_b")))
        cut = {c: F.reverse(F.substr(F.col(c), F.col("_same") + 1)) for c in ("_a", "_b")}
        staged = staged.withColumns(cut)
    if threshold is not None:
        distance = F.levenshtein("_a", "_b", threshold)
    else:
        long = F.greatest(F.length("_a"), F.length("_b")) > LONG_MIDDLE
        banded = F.pandas_udf(_banded_distance, "int")
        staged = staged.withColumn("_far", banded(F.when(long, F.col("_a")), F.when(long, F.col("_b"))))
        distance = F.when(long, F.col("_far")).otherwise(F.levenshtein("_a", "_b"))
    return text.pinned(staged, distance=distance).select(*keep, "truth_len", "distance")


def with_cer(df: DataFrame) -> DataFrame:
    return df.withColumn("cer", F.col("distance") / F.greatest(F.col("truth_len"), F.lit(1)))


def round_robin_sample(docs: DataFrame, n: int, path: str = "path", pages: str = "pages") -> DataFrame:
    """Pages picked by going round the documents, each round at a shifted page.

    The page of a round depends on the document alone, so repeats within a document drop out
    in its own row. Picks are cut by their index in the order of round and path, which is given as ``place``.
    """
    rounds = F.sequence(F.lit(0), F.lit(V.SAMPLE_ROUNDS - 1))
    plan = docs.filter(F.col(pages) > 0).withColumn(
        "_pages", F.transform(rounds, lambda r: (r * V.SAMPLE_STRIDE + 1) % F.col(pages) + 1)
    )
    picks = plan.select(*docs.columns, "_pages", F.posexplode("_pages").alias("round", "page"))
    fresh = picks.filter(F.array_position("_pages", F.col("page")) == F.col("round") + 1)
    return with_global_index(fresh.drop("_pages"), ["round", path], "place").filter(F.col("place") < n)


def order_stats(df: DataFrame, metrics, places: dict) -> DataFrame:
    """Values at exact ranks: one row per (metric, name), ranks counted from 0 as functions of n.

    Equal values are counted first, and the counts are summed along the value order in ranges.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])))
    counted = long.filter("value is not null").groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))
    summed = with_running_sum(counted, ["metric", "value"], "n", "upto")
    spans = summed.groupBy("metric").agg(
        F.min(F.col("upto") - F.col("n")).alias("_base"), F.sum("n").alias("total")
    )
    ranks = spans.select("metric", "_base", F.inline(F.array(*[
        F.struct(F.lit(name).alias("stat"), place(F.col("total")).cast("long").alias("_rank"))
        for name, place in places.items()
    ])))
    at = F.col("_base") + F.col("_rank")
    # One row per metric and statistic: as small as the two argument lists.
    return (
        summed.join(F.broadcast(ranks), "metric")
        .filter((F.col("upto") > at) & (F.col("upto") - F.col("n") <= at))
        .select("metric", "stat", "value")
    )


UPPER_MEDIAN = lambda n: F.shiftright(n, 1)
FLOOR_P10 = lambda n: text.int_div(n, F.lit(10))


def fidelity_stats(df: DataFrame, metrics=("recall", "precision"), min_chars: int = V.MIN_TRUTH_CHARS) -> DataFrame:
    """Mean, upper median and floor-indexed p10 per metric over rows with enough truth text."""
    # The metrics are read twice and are narrow; the texts behind them are neither.
    usable = durable(df.filter(F.col("truth_len") >= min_chars).select(*metrics))
    picks = order_stats(usable, metrics, {"median": UPPER_MEDIAN, "p10": FLOOR_P10})
    means = usable.agg(*[F.avg(m).alias(m) for m in metrics]).select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit("mean").alias("stat"), F.col(m).alias("value"))
        for m in metrics
    ])))
    return picks.unionByName(means)


def worst_k(df: DataFrame, key: str, k: int = V.WORST_LIMIT, min_chars: int = V.MIN_TRUTH_CHARS) -> DataFrame:
    return df.filter(F.col("truth_len") >= min_chars).orderBy("recall", key).limit(k)


def recall_gate(df: DataFrame, min_median: float = V.RECALL_GATE, min_chars: int = V.MIN_TRUTH_CHARS) -> DataFrame:
    """One row: median recall in 1/10000, the rows below the bar, and whether the gate passes.

    Rows and median are compared exactly; only the median that is shown is rounded.
    """
    usable = durable(df.filter(F.col("truth_len") >= min_chars).select("hits", "truth_tokens", _share().alias("_share")))
    median = order_stats(usable, ["_share"], {"median": UPPER_MEDIAN}).agg(F.max("value").alias("m")).scalar()
    return usable.agg(
        F.count(F.lit(1)).alias("usable"), F.count_if(_below(min_median)).alias("low_rows")
    ).select("usable", "low_rows", median.alias("_median")).select(
        "usable", "low_rows", F.floor(F.col("_median") * 10000 + 0.5).cast("double").alias("median_recall"),
        (F.col("_median") >= min_median).alias("passed"),
    )


def _share() -> Column:
    """Recall as it is, 1 without truth shingles. Equal counts give equal numbers, and a share equal to the bar
    gives the number that the bar is written as."""
    return F.when(F.col("truth_tokens") == 0, F.lit(1.0)).otherwise(F.col("hits") / F.col("truth_tokens"))


def _below(bar: float) -> Column:
    exact = F.lit(str(bar)).cast("decimal(18,9)")
    return (F.col("truth_tokens") > 0) & (F.col("hits") < F.col("truth_tokens") * exact)


def low_recall_rows(df: DataFrame, min_recall: float = V.RECALL_GATE, min_chars: int = V.MIN_TRUTH_CHARS) -> DataFrame:
    """Every usable row whose recall lies below the bar."""
    return df.filter((F.col("truth_len") >= min_chars) & _below(min_recall))

"""Quality rules: fixed rules, then robust multivariate outliers.

Five statistics of a text become a vector. Per language and source a minimum-covariance-determinant estimate is found
by concentration steps: mean and covariance are taken over the ``share`` of rows with the smallest Mahalanobis distance, again
and again, from two starts (coordinate-wise medians; mean and covariance of all rows), of which the one that ends with the smaller determinant
counts. A text whose distance lies beyond ``cutoff`` is rejected.

Every estimate of a group is drawn towards its language by one formula, ``(n * own + PULL * language) / (n + PULL)`` with n rows, so a group
of any size has an estimate of its own and no size switches the rule.

Every step is a DataFrame aggregate over one small row per document, with partial sums, so a group that holds a third of
all rows is summed where its rows lie; estimates come back to the rows by a salted join. Medians and the cut of the concentration step are read off histograms of
whole-number bins, and sums are exact decimals: the result does not depend on partitions or order.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import pinned
from pagewright.llm.common import SPACE, space_words, whole_text
from pagewright.operators.ordering import attach_group_facts
from pagewright.session import durable

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: Vectors are kept in whole thousandths.
UNIT = 1000
VECTOR = ("length", "word_length", "symbols", "lines", "repeats")
#: Standard deviation of the noise every coordinate is given, whose square is added to its variance: shares are 0 in nearly all clean
#: texts, and groups of few rows have singular covariances, which a smallest variance alone would not mend.
FLOORS = (0.3, 0.15, 0.7, 0.7, 0.7)
#: A group's estimates weigh its own rows against so many rows of its language.
PULL = 50
CHI2_MEDIAN = 4.351
#: The 99.999 % quantile of chi-square with as many degrees as the vector has coordinates.
CHI2_CUTOFF = 30.856
DISTANCE_BINS = 16


def _window_hashes(words: Column) -> Column:
    """A hash for every window of eight words, null for shorter texts; ``words`` should be pinned."""
    n = F.size(words)
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))


def _repeated_starts(hashes: Column) -> Column:
    """Starts of the windows that occur more than once, in order: equal hashes are neighbours when sorted."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    firsts = F.filter(
        F.zip_with(pairs, F.slice(pairs, 2, F.greatest(F.size(pairs) - 1, F.lit(0))), lambda a, b: F.when(
            a["h"] == b["h"], F.array(a["i"], b["i"])
        )),
        lambda x: x.isNotNull(),
    )
    return F.array_sort(F.array_distinct(F.flatten(firsts)))


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang, source and the counts of each text; a null text has none."""
    text = F.col("_text")
    base = docs.select(
        F.col(id_column).alias("doc_id"), F.col("lang").alias("lang"), F.col("source").alias("source"),
        whole_text(text_column).alias("_text"),
    )
    split = pinned(base, _words=space_words(text))
    words = F.col("_words")
    hashed = pinned(split, _hashes=_window_hashes(words))
    starts = pinned(hashed, _starts=F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"), _repeated_starts(F.col("_hashes"))
    ))
    covered = F.aggregate(
        "_starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("end")),
        lambda s, x: F.struct((s["n"] + x + WINDOW - F.greatest(x, s["end"])).alias("n"), (x + WINDOW).alias("end")),
        lambda s: s["n"],
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    counted = pinned(starts, _lines=lines)
    symbols = F.when(F.rlike(text, F.lit(SYMBOLS)), F.regexp_count(text, F.lit(SYMBOLS))).otherwise(0)
    return counted.select(
        "doc_id", "lang", "source",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def _vector() -> list[Column]:
    """Transformed statistics: logarithms of counts and of percentages."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    values = (
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / words),
        F.log1p(100 * F.col("n_symbols") / words),
        F.log1p(100 * F.col("n_dup_lines") / lines),
        F.log1p(100 * F.col("n_repeat_words") / words),
    )
    return [F.round(v * UNIT).cast("long").alias(name) for v, name in zip(values, VECTOR, strict=True)]


def _cut(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The smallest bin up to which ``share`` of a group's rows lie, from the counts of its bins."""
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    reached = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    return reached.filter(F.col("upto") >= F.col("total") * F.lit(share)).groupBy(*keys).agg(F.min("bin").alias("cut"))


def _drawn(own: Column, language: Column, n: Column) -> Column:
    return (n * own + PULL * language) / (n + PULL)


def _moments(rows: DataFrame) -> DataFrame:
    """Centre, inverse covariance and logarithm of the determinant per group and start, in the unit of the vector."""
    p = range(len(VECTOR))
    pairs = [(i, j) for i in p for j in p if j <= i]
    whole = {v: F.col(v).cast("decimal(20,0)") for v in VECTOR}
    names = ["n", *[f"s{i}" for i in p], *[f"q{i}{j}" for i, j in pairs]]
    own = rows.groupBy("group", "language", "start").agg(
        F.count(F.lit(1)).cast("decimal(20,0)").alias("n"),
        *[F.sum(whole[v]).alias(f"s{i}") for i, v in enumerate(VECTOR)],
        *[F.sum((F.col(VECTOR[i]) * F.col(VECTOR[j])).cast("decimal(20,0)")).alias(f"q{i}{j}") for i, j in pairs],
    )
    every = own.groupBy("language", "start").agg(*[F.sum(c).cast("double").alias(f"l{c}") for c in names])
    both = own.select("group", "language", "start", *[F.col(c).cast("double").alias(c) for c in names]).join(every, ["language", "start"])

    def estimate(lead: str) -> tuple[list[Column], dict]:
        mean = [F.col(f"{lead}s{i}") / F.col(f"{lead}n") for i in p]
        return mean, {(i, j): F.col(f"{lead}q{i}{j}") / F.col(f"{lead}n") - mean[i] * mean[j] for i, j in pairs}

    (mean, cov), (mean_of_all, cov_of_all) = estimate(""), estimate("l")
    n = F.col("n")
    centre = [_drawn(mean[i], mean_of_all[i], n) for i in p]
    cell = {
        (i, j): _drawn(cov[max(i, j), min(i, j)], cov_of_all[max(i, j), min(i, j)], n) + ((FLOORS[i] * UNIT) ** 2 if i == j else 0.0)
        for i in p for j in p
    }
    found = pinned(both, centre=F.array(*centre), covariance=F.array(*cell.values()))
    swept = pinned(found, swept=_inverse(F.col("covariance"), len(VECTOR)))
    return swept.select("group", "start", "centre", F.col("swept.a").alias("inverse"), F.col("swept.logdet").alias("logdet"))


def _inverse(matrix: Column, n: int) -> Column:
    """Inverse ``a`` of a positive definite n x n matrix, given row by row as an array, by sweeping every pivot, and ``logdet``."""

    def sweep(state: Column, k: Column) -> Column:
        a = state["a"]

        def cell(x: Column) -> Column:
            i, j = F.floor(x / n).cast("int"), x % n
            pivot, down, across = F.get(a, k * n + k), F.get(a, i * n + k), F.get(a, k * n + j)
            return (
                F.when((i == k) & (j == k), 1 / pivot).when(i == k, across / pivot).when(j == k, -down / pivot)
                .otherwise(F.get(a, x) - down * across / pivot)
            )

        return F.struct(
            F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), cell).alias("a"), (state["logdet"] + F.log(F.get(a, k * n + k))).alias("logdet")
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.struct(matrix.alias("a"), F.lit(0.0).alias("logdet")), sweep)


def _distances(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance of each row to the estimate of its group and start, and its bin."""
    p = range(len(VECTOR))
    kept = ["row", "group", "language", "start", *VECTOR]
    known = attach_group_facts(rows.select(*kept), facts.select("group", "start", "centre", "inverse"), ["group", "start"], ["row"]).select(
        *kept, "inverse", *[(F.col(v) - F.get("centre", F.lit(i))).alias(f"z{i}") for i, v in enumerate(VECTOR)]
    )
    terms = [F.get("inverse", F.lit(i * len(VECTOR) + j)) * F.col(f"z{i}") * F.col(f"z{j}") for i in p for j in p]
    squared = pinned(known, d2=F.greatest(reduce(add, terms), F.lit(0.0)))
    return squared.select(*kept, "d2", F.floor(F.log2(1 + F.col("d2")) * DISTANCE_BINS).alias("bin"))


def robust_distances(rows: DataFrame, share: float = 0.75, steps: int = 4) -> DataFrame:
    """row and its robust squared distance ``d2``. ``rows`` has row, lang, source and the vector; null lang or source is a value of its own."""
    grouped = durable(rows.select(
        "row", F.to_json(F.struct("lang", "source")).alias("group"), F.to_json(F.struct("lang")).alias("language"), *VECTOR
    ))
    medians, means = F.lit(0), F.lit(1)
    spots = grouped.select("group", F.posexplode(F.array(*VECTOR)).alias("at", "bin"))
    centres = _cut(spots, ["group", "at"], 0.5)
    p = range(len(VECTOR))
    at_once = [F.max(F.when(F.col("at") == i, F.col("cut"))).cast("double") for i in p]
    unit = [F.lit(1 / (FLOORS[i] * UNIT) ** 2 if i == j else 0.0) for i in p for j in p]
    first = centres.groupBy("group").agg(F.array(*at_once).alias("centre")).select(
        "group", medians.alias("start"), "centre", F.array(*unit).alias("inverse"), F.lit(0.0).alias("logdet")
    )
    facts = durable(first.unionByName(_moments(grouped.withColumn("start", means))))
    started = grouped.withColumn("start", F.explode(F.array(medians, means)))
    for _ in range(steps):
        placed = _distances(started, facts)
        inner = attach_group_facts(placed, _cut(placed, ["group", "start"], share), ["group", "start"], ["row"]).filter("bin <= cut")
        facts = durable(_moments(inner))
    best = facts.groupBy("group").agg(F.min_by(F.struct("centre", "inverse"), F.struct("logdet", "start")).alias("best"))
    placed = durable(_distances(grouped.withColumn("start", medians), best.select("group", medians.alias("start"), "best.*")))
    sizes = placed.groupBy("group", "language").agg(F.count(F.lit(1)).alias("n"))
    middle = sizes.join(_cut(placed, ["group"], 0.5), "group").join(_cut(placed, ["language"], 0.5).withColumnRenamed("cut", "every"), "language")
    scale = middle.select("group", _drawn(_bin_start("cut"), _bin_start("every"), F.col("n")).alias("middle"))
    return attach_group_facts(placed, scale, ["group"], ["row"]).select("row", (F.col("d2") / F.greatest(F.col("middle") / CHI2_MEDIAN, F.lit(1.0))).alias("d2"))


def _bin_start(bin: str) -> Column:
    return F.pow(F.lit(2.0), F.col(bin) / DISTANCE_BINS) - 1


def quality_rules(
    docs: DataFrame, cutoff: float = CHI2_CUTOFF, share: float = 0.75, steps: int = 4, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows of eight. ``kept`` is false for those, else
    it is the verdict of the robust distance. Rows that fail take no part in the estimates. A null or empty text has no
    words and fails; null language or source is a group of its own; repeated rows are each counted and
    reported; an empty table gives no rows; other columns are not read.
    """
    stats = durable(document_statistics(docs, id_column, text_column)).withColumn("row", F.monotonically_increasing_id())
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = stats.withColumn("base_failed", failed)
    vectors = judged.filter(~F.col("base_failed")).select("row", "lang", "source", *_vector())
    distances = robust_distances(vectors, share, steps)
    return judged.join(distances, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(False))).alias("kept"),
        F.col("d2").alias("distance"),
    )

"""Card files: quoted CSV without a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions.text import pinned, squeeze_out

#: A code point that no text holds stands for the commas between fields while a row is cut up.
FIELD_END = "\ufdd0"


def _marked(parts: Column, last: Column) -> Column:
    """The row with marks for separators: of its parts between quotes every second one lies inside of quotes and stays as it is.

    Outside, CRs go and commas become marks. An empty part between two inner ones is a doubled quote.
    """

    def part(own: Column, i: Column) -> Column:
        plain = F.translate(F.replace(own, F.lit("\r"), F.lit("")), ",", FIELD_END)
        doubled = (own == "") & (i > 0) & (i < last)
        return F.when(i % 2 == 1, own).when(doubled, F.lit('"')).otherwise(plain)

    return F.array_join(F.transform(parts, part), "")


def _file_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of the files, CRs kept, with file, block of the file and a place that ascends within the block."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )


def _card_rows(lines: DataFrame) -> DataFrame:
    """Path, row and text of each card row: a line ends a row where the quotes up to its end, counted from the file's beginning, are even in number.

    Quotes are summed along the blocks of a file. A block hands on one row: whether it holds an odd number of quotes, and how many rows end
    in it if it begins outside and if it begins inside of quotes. So a file of any size is read by many tasks.
    """
    along = Window.partitionBy("path", "_block").orderBy("_at")
    upto, before = (along.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("_odd", F.sum(quotes).over(upto) % 2)
    ends = {f"_ends{i}": F.count_if(F.col("_odd") == i) for i in (0, 1)}
    blocks = counted.groupBy("path", "_block").agg(F.max_by("_odd", "_at").alias("_turn"), *[n.alias(name) for name, n in ends.items()])
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_open", F.coalesce(F.sum("_turn").over(earlier), F.lit(0)) % 2).withColumn(
        "_first", F.coalesce(F.sum(F.when(F.col("_open") == 0, F.col("_ends0")).otherwise(F.col("_ends1"))).over(earlier), F.lit(0))
    ).select("path", "_block", "_open", "_first")
    placed = counted.withColumns({name: n.over(before) for name, n in ends.items()}).join(starts, ["path", "_block"])
    row = F.col("_first") + F.when(F.col("_open") == 0, F.col("_ends0")).otherwise(F.col("_ends1"))
    gathered = placed.groupBy("path", row.alias("row")).agg(F.array_sort(F.collect_list(F.struct("_block", "_at", "value"))).alias("_lines"))
    return gathered.select("path", "row", F.array_join(F.col("_lines.value"), "\n").alias("_line"))


def read_cards_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows front, back, path and row (0-based place within the file, blank rows counted); all-blank rows are dropped.

    Fields may be quoted and then hold commas, line ends, CRs and doubled quotes; outside of quotes CRs are dropped, as is a byte order
    mark. An empty field is null. Files are read in blocks; only a row is held whole.
    """
    rows = pinned(_card_rows(_file_lines(spark, paths)), _parts=F.split("_line", '"'))
    fields = F.split(_marked(F.col("_parts"), F.size("_parts") - 1), FIELD_END)
    cut = pinned(rows.select("path", "row", "_parts"), _fields=fields)
    raw = cut.select(*[F.nullif(F.get("_fields", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(("front", "back"))], "path", F.col("row").cast("long").alias("row"))
    blank = lambda c: squeeze_out(F.coalesce(c, F.lit(""))) == ""
    return raw.filter(~(blank("front") & blank("back")))

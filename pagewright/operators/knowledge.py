"""Knowledge objects: cards, quota ranges, item assembly, merges, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions import text
from pagewright.operators.ordering import attach_group_facts, with_group_index, with_prefix_index


def default_subjects(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(V.SUBJECTS)]
    return spark.createDataFrame(rows, "ord int, folder string, key string, area int, quota int, session int")


def default_rounds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(V.ROUNDS), "exam_round int, exam_year int")


# --- cards ------------------------------------------------------------------


def card_attributes(df: DataFrame, filename: str = "filename") -> DataFrame:
    """Chapter range and chapter name from a card file's name; else the name's stem."""
    name = F.col(filename)
    stem = F.regexp_replace(name, r"(.)\.[^.]*$", "$1")
    return (
        df.withColumn("chapter", F.coalesce(text.matched(name, V.CARD_NAME, 3), stem))
        .withColumn("chapter_from", text.to_int(text.matched(name, V.CARD_NAME, 1)))
        .withColumn("chapter_to", text.to_int(text.matched(name, V.CARD_NAME, 2)))
    )


def _sides(df: DataFrame) -> DataFrame:
    return df.withColumn("front", text.trim(F.coalesce("front", F.lit("")))).withColumn(
        "back", text.trim(F.coalesce("back", F.lit("")))
    )


def _is_kept() -> Column:
    return (F.col("front") != "") & (F.col("back") != "")


def clean_cards(df: DataFrame, order=("path", "row")) -> DataFrame:
    """Trimmed cards with both sides, numbered over all files in ``order``, which tells all rows apart."""
    kept = _sides(df).filter(_is_kept())
    number = F.col("_no") + 1
    return (
        with_prefix_index(kept, order, "_no")
        .withColumn("id", F.format_string("%s-%05d", "subject_key", number))
        .drop("_no")
    )


def cards_per_file(df: DataFrame, file: str = "path") -> DataFrame:
    return _sides(df).groupBy(file).agg(
        F.count(F.lit(1)).alias("parsed"), F.count_if(_is_kept()).alias("kept")
    )


# --- quota ranges -----------------------------------------------------------


def quota_ranges(subjects: DataFrame) -> DataFrame:
    """Number range of each subject within its session, by running quota.

    ``subjects`` is the subject dimension: session, ord, key, quota.
    """
    along = Window.partitionBy("session").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("quota").over(along)
    return subjects.withColumn("n_to", upto).withColumn("n_from", F.col("n_to") - F.col("quota") + 1)


def assert_layout(subjects: DataFrame, totals: DataFrame, grand_total: int | Column) -> DataFrame:
    """Every session sum, and the total with a null session, that differs from the plan.

    ``totals`` lists session and want.
    """
    sums = subjects.rollup("session").agg(F.sum("quota").alias("got"), F.grouping("session").alias("_all"))
    whole = sums.filter("_all = 1").select("session", "got").withColumn(
        "want", grand_total if isinstance(grand_total, Column) else F.lit(grand_total)
    )
    parts = sums.filter("_all = 0").select("session", "got").join(totals, "session", "full")
    return parts.unionByName(whole).filter(~F.col("got").eqNullSafe(F.col("want")))


def range_lookup(df: DataFrame, ranges: DataFrame, bucket: int = 64) -> DataFrame:
    """Subject key whose range holds (session, number); null outside every range.

    Ranges are cut at multiples of ``bucket``, so the join has equal keys on both sides and
    stays a hash join when the range table is too large to broadcast.
    """
    cut = F.sequence(F.floor(F.col("n_from") / bucket), F.floor(F.col("n_to") / bucket))
    pieces = ranges.select(
        F.col("session").alias("_session"),
        F.col("key").alias("subject_key"),
        F.col("n_from").alias("_from"),
        F.col("n_to").alias("_to"),
        F.explode(cut).alias("_piece"),
    )
    number = F.col("number")
    match = (
        (F.col("session") == F.col("_session"))
        & (F.floor(number / bucket) == F.col("_piece"))
        & number.between(F.col("_from"), F.col("_to"))
    )
    return df.join(pieces, match, "left").drop("_session", "_from", "_to", "_piece")


def round_year(df: DataFrame, rounds: DataFrame) -> DataFrame:
    return df.join(rounds.select("exam_round", "exam_year"), "exam_round", "left")


def paper_attributes(df: DataFrame, filename: str = "filename") -> tuple[DataFrame, DataFrame]:
    """Round and session from a paper's name; names that give neither or zero are rejected."""
    name = F.col(filename)
    read = df.withColumn("exam_round", text.to_int(text.matched(name, V.ROUND_IN_NAME))).withColumn(
        "session", text.to_int(text.matched(name, V.SESSION_IN_NAME))
    )
    good = (F.coalesce("exam_round", F.lit(0)) > 0) & (F.coalesce("session", F.lit(0)) > 0)
    return read.filter(good), read.filter(~good)


def crosscheck_notes(notes: DataFrame, ranges: DataFrame) -> DataFrame:
    """Subjects whose notice is missing or names another session or range; ``bad`` per subject.

    ``notes`` has subject_key and note.
    """
    note = F.col("note")
    said = ranges.join(notes.withColumnRenamed("subject_key", "key"), "key", "left")
    session = text.to_int(text.matched(note, V.NOTE_SESSION))
    first = text.to_int(text.matched(note, V.NOTE_RANGE, 1))
    last = text.to_int(text.matched(note, V.NOTE_RANGE, 2))
    agrees = (
        session.eqNullSafe(F.col("session")) & first.eqNullSafe(F.col("n_from")) & last.eqNullSafe(F.col("n_to"))
    )
    why = F.when(note.isNull(), "no notice").when(~agrees, "differs")
    return said.select("key", "session", "n_from", "n_to", why.alias("why"), why.isNotNull().alias("bad"))


# --- items ------------------------------------------------------------------


def explode_items(df: DataFrame, items: str) -> DataFrame:
    """One row per element of an array of structs, with its place in the page."""
    keep = [c for c in df.columns if c != items]
    return df.select(*keep, F.posexplode(items).alias("pos", "_item")).select(*keep, "pos", "_item.*")


def first_wins(df: DataFrame, key, order) -> DataFrame:
    """The first row of each key in ``order``, which must be total within a key."""
    return _one_of(df, key, order, F.min_by)


def last_wins(df: DataFrame, key, order) -> DataFrame:
    """The last row of each key in ``order``."""
    return _one_of(df, key, order, F.max_by)


def _one_of(df: DataFrame, key, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    chosen = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*key, "_row.*").select(*df.columns)


def repeats(df: DataFrame, key, order) -> DataFrame:
    """The rows :func:`first_wins` leaves out."""
    facts = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_copies"), F.min(F.struct(*order)).alias("_first")
    ).filter(F.col("_copies") > 1)
    marked = attach_group_facts(df, facts, list(key), order)
    return marked.filter(F.col("_first").isNotNull() & (F.struct(*order) != F.col("_first"))).drop(
        "_copies", "_first"
    )


def join_answers(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions with answer and area label; both null when there is no answer."""
    return questions.join(answers.select("id", "answer", "area_label"), "id", "left")


def area_of_label(label: Column) -> Column:
    chain = F
    for pattern, area in V.AREA_WORDS:
        chain = chain.when(label.rlike(pattern), F.lit(area))
    return chain.otherwise(F.lit(0))


def cross_check(df: DataFrame) -> DataFrame:
    """Rows whose answer sheet names another area than the one derived from the number."""
    labelled = df.withColumn("label_area", area_of_label(F.coalesce("area_label", F.lit(""))))
    return labelled.filter((F.col("label_area") != 0) & ~F.col("label_area").eqNullSafe(F.col("area")))


def final_order(df: DataFrame, order=("exam_round", "session", "number"), name: str = "seq") -> DataFrame:
    """Items with their 0-based place in the global order, which tells all items apart."""
    return with_prefix_index(df, order, name)


# --- gates ------------------------------------------------------------------


def grid_gate(items: DataFrame, rounds: DataFrame, want: dict) -> DataFrame:
    """Count per (round, session), empty cells included, against the plan ``want``."""
    plan = F.create_map(*[F.lit(x) for pair in want.items() for x in pair])
    grid = rounds.select("exam_round", F.explode(plan).alias("session", "want"))
    counts = items.groupBy("exam_round", "session").agg(F.count(F.lit(1)).alias("got"))
    return (
        grid.join(counts, ["exam_round", "session"], "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .withColumn("passed", F.col("got") == F.col("want"))
    )


def record_gates(items: DataFrame) -> DataFrame:
    """Counts of broken records, in one pass."""
    low, high = V.ANSWER_RANGE
    options = F.when(F.col("options").isNull(), 0).otherwise(F.size("options"))
    stem = text.trim(F.coalesce("stem", F.lit("")))
    return items.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(options != V.OPTION_COUNT).alias("bad_options"),
        F.count_if(F.col("answer").isNull()).alias("no_answer"),
        F.count_if(~F.col("answer").between(low, high)).alias("bad_answer"),
        (F.count(F.lit(1)) - F.count_distinct("id")).alias("repeated_ids"),
        F.count_if(F.col("subject_key").isNull()).alias("no_subject"),
        F.count_if(F.length(stem) < V.MIN_STEM_CHARS).alias("empty_stem"),
        F.count_if(F.coalesce("figure_withheld", F.lit(False))).alias("withheld"),
    )


def coverage_pivot(papers: DataFrame, sessions=tuple(V.SESSION_TOTALS)) -> DataFrame:
    """Pages per round and session, one column per session."""
    wide = papers.groupBy("exam_round").pivot("session", list(sessions)).agg(F.max("pages"))
    return wide.select("exam_round", *[F.col(str(s)).alias(f"session_{s}") for s in sessions])


# --- guides -----------------------------------------------------------------


SUBJECT_COLUMNS = ("subject_order", "subject_name", "area", "exam_questions", "session")


def merge_by_subject(df: DataFrame, subject: str, order, arrays, subjects: DataFrame, source=()) -> DataFrame:
    """Entries of a subject's documents in document order, with the subject's place in the subject list and its attributes.

    Every document adds one entry of kind ``sources``, a JSON object of its ``source`` columns, if any are named. Documents
    of subjects that ``subjects`` (ord, folder, key, area, quota, session) lacks are left out. The merged lists stay in long form, so a
    subject with any number of documents is spread over tasks. Struct elements become JSON text.
    """
    lists = [F.struct(F.lit(a).alias("kind"), _as_text(df, a).alias("items")) for a in arrays]
    if source:
        lists.append(F.struct(F.lit("sources").alias("kind"), F.array(F.to_json(F.struct(*source))).alias("items")))
    entries = (
        df.select(F.col(subject).alias("subject_key"), *order, F.explode(F.array(*lists)).alias("_k"))
        .select("subject_key", *order, "_k.kind", F.posexplode("_k.items").alias("_pos", "entry"))
    )
    listed = entries.join(subjects.select(F.col("key").alias("subject_key")), "subject_key", "left_semi")
    placed = with_group_index(listed, ["subject_key", "kind"], [*order, "_pos"], "place").drop("_pos")
    return placed.join(subject_attributes(subjects), "subject_key")


def subject_attributes(subjects: DataFrame) -> DataFrame:
    return subjects.select(
        F.col("key").alias("subject_key"), F.col("ord").alias("subject_order"), F.col("folder").alias("subject_name"), "area",
        F.col("quota").alias("exam_questions"), "session",
    )


def guide_heads(entries: DataFrame, kinds) -> DataFrame:
    """One row per merged subject, in the order of the subject list: its attributes and the length of each list."""
    sizes = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds]
    return entries.groupBy("subject_key", *SUBJECT_COLUMNS).agg(*sizes).orderBy("subject_order")


def _as_text(df: DataFrame, array: str) -> Column:
    element = df.schema[array].dataType.elementType
    if element.typeName() == "struct":
        return F.transform(array, lambda e: F.to_json(e))
    return F.col(array).cast("array<string>")


def guide_gates(entries: DataFrame, subjects: DataFrame, content=("study_order", "recommended_materials", "notes"), ranked: str = "unit_priority") -> DataFrame:
    """Per subject: is it missing, has it no content, has it no ranked units."""
    per = entries.groupBy("subject_key").agg(
        F.count_if(F.col("kind").isin(*content)).alias("_content"),
        F.count_if(F.col("kind") == ranked).alias("_ranked"),
    )
    return subjects.select(F.col("key").alias("subject_key")).join(per, "subject_key", "left").select(
        "subject_key",
        F.col("_content").isNull().alias("missing"),
        F.coalesce(F.col("_content") == 0, F.lit(False)).alias("no_content"),
        F.coalesce(F.col("_ranked") == 0, F.lit(False)).alias("no_ranks"),
    )

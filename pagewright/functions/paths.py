"""Path expressions: name, extension, folders, material types, routes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright import fixed_values as V


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot; a leading dot alone is no extension."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]*)$", 1))


def parent_name(path: Column) -> Column:
    """Name of the containing folder, or null for a file at the root."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.get(parts, F.size(parts) - 2))


def top_folder(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def default_material_rules() -> list:
    """Ordered (predicate, type) rules; a predicate takes (parent, name, ext, path)."""
    in_papers = lambda p, n, e, f: p.contains(V.PAST_PAPER_FOLDER)

    def has_word(word: str):
        return lambda p, n, e, f: p.contains(word) | n.contains(word)

    return [
        (lambda p, n, e, f: e.isin(*V.NOTE_EXTENSIONS), "note"),
        (lambda p, n, e, f: in_papers(p, n, e, f) & n.contains(V.ANSWER_SHEET_WORD), "past-paper-answer"),
        (in_papers, "past-paper"),
        (lambda p, n, e, f: n.contains(V.STUDY_GUIDE_WORD), "study-guide"),
        (lambda p, n, e, f: n.contains(V.D_GRADE_WORD), "d-grade-list"),
        (lambda p, n, e, f: e.isin(*V.AUDIO_EXTENSIONS) | f.endswith(V.COPY_SUFFIX), "audio"),
        (lambda p, n, e, f: e == ".mp4", "video"),
        (lambda p, n, e, f: e == ".csv", "flashcard-csv"),
        (lambda p, n, e, f: e.isin(*V.SHEET_EXTENSIONS), "spreadsheet"),
        (lambda p, n, e, f: e == ".zip", "goodnotes"),
        *[(has_word(word), kind) for word, kind in V.MATERIAL_KEYWORDS],
    ]


def first_match(rules, otherwise: str, *args: Column) -> Column:
    """The value of the first rule whose predicate holds."""
    chain = F
    for predicate, value in rules:
        chain = chain.when(predicate(*args), F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def material_type(path: Column, rules=None) -> Column:
    parent = F.coalesce(parent_name(path), F.lit(""))
    return first_match(
        rules or default_material_rules(), "etc", parent, file_name(path), extension(path), path
    )


def extract_route(ext: Column, text_layer: Column, material: Column) -> Column:
    return (
        F.when(ext == ".pdf", F.when(text_layer == "CLEAN", "pdftotext").otherwise("vision"))
        .when(ext == ".csv", "direct-csv")
        .when(ext.isin(*V.OLD_SHEET_EXTENSIONS), "xls-ole2")
        .when(ext.isin(*V.AUDIO_EXTENSIONS) | (material == "audio"), "audio-defer")
        .when(ext == ".zip", "goodnotes-defer")
        .otherwise("manual")
    )


def priority(value: Column, order) -> Column:
    """1-based place in an ordered list; unknown values come after all listed ones."""
    places = F.array_position(F.array(*[F.lit(v) for v in order]), value)
    return F.when(F.coalesce(places, F.lit(0)) == 0, len(order) + 1).otherwise(places).cast("int")

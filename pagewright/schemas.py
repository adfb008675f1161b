"""Row types of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


STRING, INT, LONG, BOOL, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DoubleType()

ASSET = _struct(
    ("source_key", STRING), ("path", STRING), ("subject_folder", STRING), ("subject_key", STRING), ("area", INT),
    ("exam_questions", INT), ("category", STRING), ("filename", STRING), ("ext", STRING), ("material_type", STRING),
    ("size_bytes", LONG), ("pages", INT), ("producer", STRING), ("text_layer", STRING), ("extract_route", STRING),
    ("content_sha", STRING), ("dup_group", STRING), ("is_primary", BOOL),
)
PROBE = _struct(("content_sha", STRING), ("pages", INT), ("producer", STRING), ("text_layer", STRING))
PAGE = _struct(
    ("sha", STRING), ("page", INT), ("pages_total", INT), ("source_key", STRING), ("subject_key", STRING),
    ("material_type", STRING), ("extract_route", STRING), ("body", STRING),
)
OPTION = _struct(("n", INT), ("text", STRING))
QUESTION_ITEM = _struct(
    ("number", INT), ("stem", STRING), ("stem_box", STRING), ("options", T.ArrayType(OPTION)), ("figure_withheld", BOOL),
    ("has_figure", BOOL),
)
QUESTION_PAGE = _struct(
    ("sha", STRING), ("source_key", STRING), ("exam_round", INT), ("session", INT), ("page", INT),
    ("page_questions", T.ArrayType(QUESTION_ITEM)),
)
ANSWER_ITEM = _struct(("session", INT), ("number", INT), ("answer", INT), ("area_label", STRING))
ANSWER_PAGE = _struct(("sha", STRING), ("exam_round", INT), ("page", INT), ("answers", T.ArrayType(ANSWER_ITEM)))
CARD = _struct(
    ("id", STRING), ("subject_key", STRING), ("chapter", STRING), ("chapter_from", INT), ("chapter_to", INT),
    ("front", STRING), ("back", STRING), ("source", STRING), ("source_key", STRING), ("source_sha", STRING),
)
GUIDE_DOC = _struct(
    ("subject_key", STRING), ("material_type", STRING), ("source_key", STRING), ("source_sha", STRING),
    ("study_order", T.ArrayType(STRING)),
    ("unit_priority", T.ArrayType(_struct(("unit", STRING), ("rank", INT), ("note", STRING)))),
    ("recommended_materials", T.ArrayType(_struct(
        ("title", STRING), ("category", STRING), ("post_no", STRING), ("description", STRING)
    ))),
    ("notes", T.ArrayType(STRING)),
)
SCAN = _struct(
    ("sha", STRING), ("page", INT), ("ink_px", LONG), ("hl_px", LONG), ("dark_px", LONG), ("n_ink", INT), ("n_hl", INT),
    ("n_rule", INT), ("text_ink", INT), ("text_hl", INT), ("hues", T.MapType(STRING, LONG)), ("level", STRING), ("err", STRING),
)
BASELINE = _struct(("sha", STRING), ("page", INT), ("fp", STRING))
MARK = _struct(("sha", STRING), ("page", INT), ("seq", INT), ("line", INT), ("text", STRING), ("type", STRING))
USAGE = _struct(
    ("t", T.TimestampType()), ("model", STRING), ("tok_in", LONG), ("tok_out", LONG), ("cached", LONG), ("tag", STRING)
)
QUARANTINE = _struct(("goal", STRING), ("at", T.TimestampType()), ("key", STRING), ("error", STRING))
ROTATION = _struct(("source_key", STRING), ("sha", STRING), ("pages", INT), ("degrees", INT))
WORD_BOX = _struct(
    ("doc_id", LONG), ("page", INT), ("seq", INT), ("n_chars", INT), ("x", DOUBLE), ("y", DOUBLE), ("w", DOUBLE), ("h", DOUBLE)
)
PIXEL = _struct(("page", INT), ("x", INT), ("y", INT), ("r", INT), ("g", INT), ("b", INT))

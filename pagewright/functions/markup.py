"""Emphasis markup expressions: aliases, stripping, counting, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.functions.text import trim


def mark_type(name: Column) -> Column:
    """Canonical mark type of an alias, or null."""
    pairs = [F.lit(part) for pair in V.MARK_ALIASES.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(trim(F.coalesce(name, F.lit("")))))


def strip_marks(text: Column, rounds: int = V.STRIP_ROUNDS) -> Column:
    """Remove balanced markers, innermost rounds included; unbalanced ones stay.

    A fold over the steps keeps the expression small, and a step whose closing marker does not
    occur any more costs one substring search instead of a regex pass.
    """
    passes = (("</mark>", V.HL_MARK), ("</u>", V.UNDERLINE_MARK), ("**", V.COLOR_MARK))

    def step(done: Column, number: Column) -> Column:
        chain = F
        for i, (closing, pattern) in enumerate(passes):
            chain = chain.when((number == i) & done.contains(closing), F.regexp_replace(done, pattern, "$1"))
        return chain.otherwise(done)

    steps = F.array(*[F.lit(i) for _ in range(rounds) for i in range(len(passes))])
    return F.aggregate(steps, text, step)


def count_marks(text: Column) -> Column:
    def n(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return F.struct(
        n(V.COLOR_MARK).alias("color"), n(V.HL_MARK).alias("hl"), n(V.UNDERLINE_MARK).alias("underline")
    )


def total_marks(text: Column) -> Column:
    marks = count_marks(text)
    return marks["color"] + marks["hl"] + marks["underline"]


def body_fingerprint(body: Column) -> Column:
    return F.substring(F.sha2(strip_marks(body), 256), 1, V.FINGERPRINT_HEX)

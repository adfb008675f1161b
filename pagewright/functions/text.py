"""Text expressions: whitespace, page classes, front matter, shingles, edit distance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright import fixed_values as V


def squeeze_out(text: Column) -> Column:
    """Drop every whitespace character."""
    return F.regexp_replace(text, f"[{V.WS}]+", "")


#: The characters of the class ``V.WS`` one by one.
WS_CHARS = "\t\n\x0b\f\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def rtrim(text: Column) -> Column:
    return F.rtrim(text, F.lit(WS_CHARS))


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARS))


def collated(text: Column, collation: str = "UNICODE") -> Column:
    """Text that sorts by a collation; plain columns sort by code point."""
    return F.collate(text, collation)


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """A capture group, or null when the pattern does not occur."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def to_int(text: Column) -> Column:
    return text.try_cast("int")


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever is done with them later.

    The optimizer moves a filter below a projection by writing the projected expressions into
    the condition, which repeats them. A generator of one row is not rewritten in that way, so
    costly expressions go through one.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


# --- page classes -----------------------------------------------------------


@dataclass(frozen=True)
class TextProfile:
    """What readable text of a corpus looks like, as regex character classes."""

    script: str = V.HANGUL
    common: str = V.COMMON_HANGUL
    expected: str = V.EXPECTED_CHARS


LATIN = TextProfile(script=r"A-Za-z\x{00C0}-\x{024F}", common="etaoinrsETAOINRS")


def page_counts(dense: Column, profile: TextProfile = TextProfile()) -> Column:
    """Struct of the four counts that decide the class of a page's text without whitespace."""

    def without(chars: str) -> Column:
        return F.length(F.regexp_replace(dense, f"[{chars}]+", ""))

    return F.struct(
        F.length(dense).alias("n_chars"),
        without(profile.script + profile.expected).alias("n_odd"),
        (F.length(dense) - without(profile.script)).alias("n_script"),
        (F.length(dense) - without(profile.common)).alias("n_common"),
    )


def page_class(counts: Column) -> Column:
    """EMPTY, MOJIBAKE or CLEAN from :func:`page_counts`, in whole-number arithmetic."""
    chars, odd = counts["n_chars"], counts["n_odd"]
    script, common = counts["n_script"], counts["n_common"]
    too_odd = (odd > V.ODD_FLOOR) & (odd * 100 > chars * V.ODD_PERCENT)
    readable = (script >= V.MIN_SCRIPT_CHARS) & (common * 100 > script * V.COMMON_PERCENT)
    return (
        F.when(chars < V.MIN_PAGE_CHARS, "EMPTY")
        .when(too_odd, "MOJIBAKE")
        .when(readable, "CLEAN")
        .otherwise("MOJIBAKE")
    )


# --- front matter -----------------------------------------------------------


def page_key(sha: Column, page: Column) -> Column:
    digits = page.cast("string")
    return F.concat_ws("-", sha, F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))


def page_of_name(name: Column) -> Column:
    """Page number of an image file name such as ``p-0012.png``."""
    return to_int(matched(name, r"-(\d+)\.png$"))


def front_matter_head(text: Column) -> Column:
    """The front matter block with its closing line; empty when there is none."""
    return F.regexp_extract(text, V.FRONT_MATTER, 0)


def front_matter_body(text: Column) -> Column:
    return F.substr(text, F.length(front_matter_head(text)) + 1)


def front_matter_map(head: Column) -> Column:
    """Key to value; the first of a repeated key counts, as in the per-key checks."""
    pairs = F.regexp_extract_all(head, F.lit(r"(?m)^([A-Za-z0-9_]+):[^\n]*$"), F.lit(0))
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.substring_index(p, ":", 1).alias("key"),
            trim(F.substr(p, F.length(F.substring_index(p, ":", 1)) + 2)).alias("value"),
        ),
    )
    # An expression inside of a lambda is computed for every element; the argument of one is computed once.
    once = F.transform(F.array(entries), lambda every: F.filter(
        every, lambda e, i: ~F.exists(F.slice(every, F.lit(1), i), lambda o: o["key"] == e["key"])
    ))
    return F.map_from_entries(F.get(once, F.lit(0)))


def front_matter_value(head: Column, key: str) -> Column:
    return trim(matched(head, f"(?m)^{key}:([^\\n]*)$"))


# --- fidelity ---------------------------------------------------------------


#: Markup characters, those of the class ``V.MARKUP_CHARS``, and whitespace.
_NOISE = "*#`|>_~-\u2013\u2014[]()" + WS_CHARS


def _without_tags(text: Column, fill: str) -> Column:
    """Drop figure and unreadable tags; text without any skips the regex passes."""
    cut = F.regexp_replace(F.regexp_replace(text, V.FIGURE_TAG, fill), V.UNREADABLE_TAG, fill)
    return F.when(text.contains("[FIGURE:") | text.contains("[UNREADABLE]"), cut).otherwise(text)


def normalize_text(text: Column) -> Column:
    """Only the content characters, in lower case; markup and whitespace go in one pass."""
    return F.lower(F.translate(_without_tags(text, ""), _NOISE, ""))


def shingle_source(text: Column) -> Column:
    out = _without_tags(text, " ")
    out = F.when(text.contains("<"), F.regexp_replace(out, V.BREAK_TAG, " ")).otherwise(out)
    return F.lower(F.translate(out, _NOISE, ""))


def grams(source: Column, k: int = V.SHINGLE) -> Column:
    """Distinct character k-grams in first-seen order, in one linear pass.

    A lookahead yields the gram that starts at every position; cutting substrings by
    number would walk the UTF-8 text from its start for each gram.
    """
    found = F.regexp_extract_all(source, F.lit(f"(?s)(?=({'.' * k}))"), F.lit(1))
    return F.array_distinct(found)


def shingles(text: Column, k: int = V.SHINGLE) -> Column:
    return grams(shingle_source(text), k)


def int_div(a: Column, b: Column) -> Column:
    """Whole-number quotient of non-negative numbers; null for a zero divisor."""
    return ((a - a % F.nullif(b, F.lit(0))) / F.nullif(b, F.lit(0))).cast("long")


def ratio(part: Column, whole: Column, scale: int) -> Column:
    """``part / whole`` in units of 1/scale, halves rounded up, without floating point."""
    part, whole = part.cast("long"), whole.cast("long")
    return int_div(part * (2 * scale) + whole, whole * 2)


def overlap_of_counts(hits: Column, n_truth: Column, n_got: Column) -> Column:
    """Struct of hits, and recall and precision in 1/10000; empty sides follow fixed rules."""
    whole = F.lit(10000).cast("long")
    none = F.lit(0).cast("long")
    recall = F.coalesce(ratio(hits, n_truth, 10000), whole)
    precision = (
        F.when(n_truth == 0, F.when(n_got == 0, whole).otherwise(none))
        .when(n_got == 0, none)
        .otherwise(ratio(hits, n_got, 10000))
    )
    return F.struct(hits.alias("hits"), recall.alias("recall"), precision.alias("precision"))


def common_prefix_length(a: Column, b: Column) -> Column:
    """Length of the longest shared prefix, by halving steps over whole substrings.

    Both arguments are read at every step: pass columns, not long expressions.
    """
    limit = F.least(F.length(a), F.length(b))

    def step(found: Column, power: Column) -> Column:
        reach = found + power
        fits = (reach <= limit) & (F.substr(a, F.lit(1), reach) == F.substr(b, F.lit(1), reach))
        return F.when(fits, reach).otherwise(found)

    powers = F.array(*[F.lit(1 << i) for i in range(29, -1, -1)])
    return F.aggregate(F.filter(powers, lambda p: p <= limit), F.lit(0), step)

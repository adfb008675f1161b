"""Columns and array helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``docs`` has it; Spark does not tell cases apart."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def space_words(text: Column) -> Column:
    """Words between ASCII white space, as an array."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def word_codes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """White-space words of each text as codes into a list of distinct words.

    Returns the codes of all words in order, the place where each text starts (one more
    entry than texts), and the distinct words.
    """
    lists = [t.split() if t else [] for t in texts]
    starts = np.zeros(len(lists) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    flat = [w for x in lists for w in x]
    coded = pa.array(flat, type=pa.large_binary()).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, coded.dictionary.to_pylist()


def held_out(column: str, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id, as text, leaves ``rest``; a null id reads as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus == rest


CHUNK_BYTES = 4 << 20


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> list[tuple[int, int]]:
    """Stretches of texts of about ``limit`` bytes together, so that work arrays stay small; no text is cut."""
    cuts, start, total = [], 0, 0
    for i, t in enumerate(texts):
        total += len(t) if t else 0
        if total >= limit:
            cuts.append((start, i + 1))
            start, total = i + 1, 0
    if start < len(texts):
        cuts.append((start, len(texts)))
    return cuts


def text_bytes(column) -> list[bytes | None]:
    """An Arrow string column as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads the bits of whole numbers."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(33)
    v *= np.uint64(0xFF51AFD7ED558CCD)
    v ^= v >> np.uint64(33)
    v *= np.uint64(0xC4CEB9FE1A85EC53)
    v ^= v >> np.uint64(33)
    return v


def word_hashes(distinct: list[bytes], seed: int = 0) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in distinct], dtype=np.uint64)

"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into marked words: blanks with the letters after them, and line ends. No piece of the vocabulary reaches over such a cut, so the
best segmentation of a text is that of its words. The distinct words of a batch are sorted, which is a trie walked
depth-first: a word keeps the forward scores of the prefix it shares with the word before it, and only the rest is computed.
Characters outside the vocabulary fall back to their bytes, so every text comes back unchanged.

The vocabulary file is a parameter. Segmentation maximises the sum of piece scores; for a vocabulary trained by merges this is the best
path under its scores, not the merge order, and its ids decode alike.
"""

import hashlib
import os
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm.common import chunks, text_bytes, whole_text

MODEL = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")
MARK = "▁"
BYTE_COST = 10.0
PIECE_CHUNK = 2 << 20
#: Words whose paths a task keeps for its next texts.
KEPT_WORDS = 150_000
_WORD = re.compile(r" *[^ \n]+| +|\n")
_INNER = re.compile(r"[^ ] |\n")


@dataclass
class Vocabulary:
    """Scores and ids of the pieces (marks as blanks), the ids of the 256 bytes, and the bytes of every id."""

    scores: dict[str, tuple[float, int]]
    byte_ids: list[int]
    spelled: list[bytes]
    longest: int
    byte_score: float

    def state(self) -> tuple:
        return self.scores, self.byte_ids, self.spelled, self.longest, self.byte_score


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; pieces that would reach over a word's end are not used for encoding."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, byte_ids, spelled = {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            spelled.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelled.append(b"")
        else:
            plain = piece.replace(MARK, " ")
            spelled.append(plain.encode("utf-8"))
            if not _INNER.search(plain):
                scores[plain] = (model.get_score(i), i)
    lowest = min(s for s, _ in scores.values())
    return Vocabulary(scores, byte_ids, spelled, max(map(len, scores)), lowest - BYTE_COST)


def marked_words(text: str) -> list[str]:
    return _WORD.findall(" " + text) if text else []


def viterbi_words(words: list[str], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each word; ``words`` are sorted and distinct. Of equal scores the path with the longer last piece wins."""
    scores, longest, byte_ids, byte_score = vocabulary.scores, vocabulary.longest, vocabulary.byte_ids, vocabulary.byte_score
    find = scores.get
    best, back, ids = [0.0], [0], [None]
    before, out = "", []
    for word in words:
        n, shared = len(word), 0
        limit = min(n, len(before))
        while shared < limit and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1:], back[shared + 1:], ids[shared + 1:]
        for end in range(shared + 1, n + 1):
            top, start_at, own = None, end - 1, None
            for start in range(max(0, end - longest), end):
                hit = find(word[start:end])
                if hit is not None:
                    score = best[start] + hit[0]
                    if top is None or score > top:
                        top, start_at, own = score, start, hit[1]
            if top is None:
                raw = word[end - 1].encode("utf-8", "surrogatepass")
                top, own = best[end - 1] + byte_score * len(raw), [byte_ids[b] for b in raw]
            best.append(top)
            back.append(start_at)
            ids.append(own)
        path, at = [], n
        while at:
            own = ids[at]
            if own.__class__ is list:
                path.extend(reversed(own))
            else:
                path.append(own)
            at = back[at]
        path.reverse()
        out.append(path)
        before = word
    return out


def encode_texts(texts: list[bytes | None], vocabulary: Vocabulary, kept: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order, and where each text starts. ``kept`` carries paths of words from call to call."""
    kept = {} if kept is None else kept
    if len(kept) > KEPT_WORDS:
        kept.clear()
    lists = [marked_words(t.decode("utf-8", "surrogatepass")) if t else [] for t in texts]
    counts = np.array([len(x) for x in lists], np.int64)
    coded = pa.array([w for x in lists for w in x], type=pa.large_string()).dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    new = sorted(w for w in distinct if w not in kept)
    # Paths are kept as bytes of 32-bit numbers, a few times smaller than lists.
    kept.update(zip(new, (np.array(p, "<i4").tobytes() for p in viterbi_words(new, vocabulary)), strict=True))
    paths = [kept[w] for w in distinct]
    lengths = np.array([len(p) // 4 for p in paths], np.int64)
    flat = np.frombuffer(b"".join(paths), "<i4")
    first = np.r_[0, np.cumsum(lengths)]
    own = lengths[codes]
    ends = np.r_[0, np.cumsum(own)]
    ids = flat[np.repeat(first[:-1][codes] - ends[:-1], own) + np.arange(ends[-1])] if len(codes) else flat[:0]
    return ids, ends[np.r_[0, np.cumsum(counts)]]


def decode_ids(ids, spelled: list[bytes]) -> bytes:
    """The text of a list of ids: pieces and bytes joined, less the blank that encoding puts in front."""
    return b"".join([spelled[i] for i in ids])[1:]


def encode_documents(docs: DataFrame, model_path: str = MODEL, name: str = "pieces", text_column: str = "text") -> DataFrame:
    """``docs`` with an array of piece ids; a null or empty text gets an empty array, a column of that name is replaced.

    The text travels to Python once, in its own column.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_path).state())

    def encode(batches):
        vocabulary, kept = Vocabulary(*shared.value), {}
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch[text_column]), 0).to_numpy(zero_copy_only=False)
            # Slices of a few megabytes of text, so that neither bytes nor ids of a whole batch are held at once.
            owner = np.cumsum(sizes, dtype=np.int64) // PIECE_CHUNK
            for start, end in zip(*_runs(owner), strict=True):
                part = batch.slice(start, end - start)
                ids, starts = encode_texts(text_bytes(part[text_column]), vocabulary, kept)
                column = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in columns], column], [*columns, name])

    columns = [c for c in docs.columns if c != name]
    shape = T.StructType([*[docs.schema[c] for c in columns], T.StructField(name, T.ArrayType(T.IntegerType()))])
    return docs.select(*columns).mapInArrow(encode, shape)


def _runs(owner: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches of equal values."""
    cuts = (np.flatnonzero(np.diff(owner)) + 1).tolist()
    return ([0, *cuts], [*cuts, len(owner)]) if len(owner) else ([], [])


def decode_documents(encoded: DataFrame, model_path: str = MODEL, ids_column: str = "pieces", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its piece ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model_path).spelled)

    @F.pandas_udf("string")
    def decode(lists: pd.Series) -> pd.Series:
        return pd.Series([decode_ids(x, shared.value).decode("utf-8", "surrogatepass") for x in lists], dtype=object)

    return encoded.withColumn(name, decode(F.coalesce(F.col(ids_column), F.array().cast("array<int>"))))


def piece_digests(docs: DataFrame, model_path: str = MODEL, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_pieces, n_bytes, ids_sha256 (ids as little-endian 32-bit numbers), round_trip.

    Whole texts are encoded and decoded again; ``round_trip`` says whether the bytes came back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_path).state())

    def digest(batches):
        vocabulary, kept = Vocabulary(*shared.value), {}
        for batch in batches:
            raw = text_bytes(batch["text"])
            numbers, sizes, shas, same = [], [], [], []
            for start, end in chunks(raw, PIECE_CHUNK):
                ids, starts = encode_texts(raw[start:end], vocabulary, kept)
                for i in range(end - start):
                    own = ids[starts[i]:starts[i + 1]]
                    numbers.append(len(own))
                    sizes.append(len(raw[start + i]))
                    shas.append(hashlib.sha256(own.astype("<i4").tobytes()).hexdigest())
                    same.append(decode_ids(own.tolist(), vocabulary.spelled) == raw[start + i])
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(same, pa.bool_()),
            ], ["doc_id", "n_pieces", "n_bytes", "ids_sha256", "round_trip"])

    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    return rows.mapInArrow(digest, "doc_id long, n_pieces long, n_bytes long, ids_sha256 string, round_trip boolean")

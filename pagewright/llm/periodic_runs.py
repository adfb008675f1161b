"""Periodic runs of words: stretches that repeat themselves, such as looping boilerplate.

A run is a maximal stretch of words with smallest period q. Runs are found by a suffix automaton with link-cut access: the nodes of the automaton's suffix
tree remember, in preferred paths, where their strings last ended. Appending word i makes the path from the node of the prefix to the root preferred and recolours it to i; every old
segment of that path tells that a suffix of at most its deepest length also ended at some earlier place e. If the distance i - e is at most that length, the
suffix and its copy overlap or touch: a square of period i - e ends at word i. Each square is extended to both sides to its run, once.

Before that, an exact filter on all words: a run of at least ``min_length`` words and ``min_power`` periods repeats a stretch of
``min_length - min_length // min_power`` words at a distance of one period, and such stretches cover the whole run. So the automaton is only built on stretches of words
covered by grams of that width that occur twice in the same text. Texts share nothing, hence nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, mixed, text_bytes, whole_text, word_codes

MIN_LENGTH = 24
MIN_POWER = 3
SHAPE = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, longest lengths, and the node of every prefix; nodes count from 1 (the root), 0 is none."""
    link, length, follow, prefixes = [0, 0], [0, 0], [{}, {}], []
    last = 1
    for word in words:
        node = len(link)
        link.append(1)
        length.append(length[last] + 1)
        follow.append({})
        at = last
        while at and word not in follow[at]:
            follow[at][word] = node
            at = link[at]
        if at:
            target = follow[at][word]
            if length[target] == length[at] + 1:
                link[node] = target
            else:
                copy = len(link)
                link.append(link[target])
                length.append(length[at] + 1)
                follow.append(dict(follow[target]))
                while at and follow[at].get(word) == target:
                    follow[at][word] = copy
                    at = link[at]
                link[target] = link[node] = copy
        prefixes.append(node)
        last = node
    return link, length, prefixes


class LastEnds:
    """A link-cut tree over a rooted tree: preferred paths as splay trees ordered by depth, one colour a path.

    The colour stands at the root of a path's splay tree, 0 for paths never visited.
    """

    def __init__(self, parents: list[int]):
        self.up = list(parents)
        self.left = [0] * len(parents)
        self.right = [0] * len(parents)
        self.colour = [0] * len(parents)

    def _splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner and (left[z] == y) == (left[y] == x):
                turns = (y, x)
            else:
                turns = (x, x) if inner else (x,)
            for t in turns:
                p = up[t]
                g = up[p]
                if left[p] == t:
                    b = right[t]
                    left[p] = b
                    right[t] = p
                else:
                    b = left[t]
                    right[p] = b
                    left[t] = p
                if b:
                    up[b] = p
                up[p] = t
                up[t] = g
                if g and left[g] == p:
                    left[g] = t
                elif g and right[g] == p:
                    right[g] = t
                else:
                    colour[t] = colour[p]

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Make the path from ``node`` to the root one path of ``colour``; (deepest node, old colour) of each segment it had."""
        segments, below, x = [], 0, node
        while x:
            self._splay(x)
            old = self.colour[x]
            if old:
                segments.append((x, old))
            cut = self.right[x]
            if cut:
                self.colour[cut] = old
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return segments


def runs_of(words: list[int], min_length: int, min_power: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the words, by start and period."""
    link, length, prefixes = suffix_automaton(words)
    tree = LastEnds(link)
    n, reached, found = len(words), {}, []
    for i, node in enumerate(prefixes):
        for deepest, end in tree.access(node, i + 1):
            period = i + 1 - end
            if period > length[deepest] or reached.get(period, -1) >= i:
                continue
            first, last = i - 2 * period + 1, i
            while first and words[first - 1] == words[first - 1 + period]:
                first -= 1
            while last + 1 < n and words[last + 1] == words[last + 1 - period]:
                last += 1
            reached[period] = last
            size = last - first + 1
            if size >= min_length and size >= min_power * period:
                found.append((first, size, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repeated_stretches(codes: np.ndarray, starts: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(text, first, end) of the maximal stretches covered by grams of ``width`` words that occur twice in their text."""
    n = len(codes) - width + 1
    if n <= 0:
        return []
    spread = mixed(codes + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(width):
        grams = grams * np.uint64(0x9DDFEA08EB382D69) + spread[k:k + n]
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.flatnonzero(owner[:n] == owner[width - 1:])
    keys = mixed(grams[inside] + owner[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    near = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hits = inside[twice[near] == keys]
    fresh = np.r_[True, (hits[1:] > hits[:-1] + width) | (owner[hits[1:]] != owner[hits[:-1]])]
    first = hits[fresh]
    end = hits[np.r_[fresh[1:], True]] + width
    return list(zip(owner[first].tolist(), first.tolist(), end.tolist(), strict=True))


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length and period in words, by start and period), collapsed.

    Words stand between ASCII white space. ``collapsed`` holds, joined by one space, the words that no run holds after its first period. A null or
    empty text has no words and an empty ``collapsed``; rows are judged one by one, also those that repeat an id or have none. Other columns are
    not read. A text of any length is judged whole.
    """
    width = max(min_length - min_length // min_power, 1)

    def judge(batches):
        for batch in batches:
            raw = text_bytes(batch["text"])
            counts, runs, texts = [], [], []
            for begin, stop in chunks(raw):
                codes, starts, distinct = word_codes(raw[begin:stop])
                found = {}
                for text, first, end in repeated_stretches(codes, starts, width):
                    if end - first >= min_length:
                        shift = first - int(starts[text])
                        found.setdefault(text, []).extend((s + shift, size, q) for s, size, q in runs_of(codes[first:end].tolist(), min_length, min_power))
                for k in range(stop - begin):
                    words = raw[begin + k].split()
                    own = found.get(k, [])
                    counts.append(len(words))
                    runs.append([{"start": s, "length": size, "period": q} for s, size, q in own])
                    if own:
                        gone = np.zeros(len(words) + 1, np.int64)
                        for s, size, q in own:
                            gone[s + q] += 1
                            gone[s + size] -= 1
                        words = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
                    texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(counts, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(texts, pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_words", "runs", "collapsed"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return texts.mapInArrow(judge, SHAPE)


def run_digests(found: DataFrame) -> DataFrame:
    """Of the rows of ``find_runs``: doc_id, n_runs, the run of greatest length / period (ties: smallest start, then period;
    nulls without runs), and digests of the list of runs and of the collapsed text."""
    strongest = F.expr("""array_sort(runs, (a, b) -> CASE
        WHEN a.length * b.period <> b.length * a.period THEN IF(a.length * b.period > b.length * a.period, -1, 1)
        WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
        WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1) ELSE 0 END)""")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.get(strongest, F.lit(0))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"),
        F.col("top.period").alias("period"), F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

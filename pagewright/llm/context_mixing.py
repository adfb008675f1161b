"""Language-model scoring by online logistic context mixing.

A text is coded as its words in lower case, joined by one blank, and an end sign, byte by byte and bit by bit. For each
order, and for the beginning of the word, a bit predictor looks up the counts of zeros and ones under the hash of those bytes
and the bits so far. The predictions, as log odds, are added up with weights that a gate picks: how many orders have seen
their context, and how often the word's beginning was seen. The weights
are learned online over the training n-grams, with every occurrence left out of its own counts. A refinement stage maps the
mixed odds to what was seen at such odds. Three degrees of sharpness are mixed by Bayes' rule along each text, which
adapts to the text as it goes on.

Counts of n-grams and words cover all training texts and grow with them. A byte with a blank among the five bytes before it has its
word's beginning there as well, so its 6-gram tells all; every other byte is fixed by its word. So a chunk of texts needs one cost for each
distinct 6-gram of the first kind, and one for the rest of each distinct word. Words are counted over all chunks; their bytes and the 6-grams of the chunks
go to buckets by the last three bytes of the context, where all counts of orders 3 to 5 and of longer beginnings are complete. Shorter
contexts are bounded by the alphabet of bytes and travel to all tasks, as do the mixing weights. Costs go back in the order of what was asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, held_out, mixed, text_bytes, whole_text
from pagewright.operators.ordering import attach_group_facts
from pagewright.session import durable, workspace

ORDERS = (1, 2, 3, 4, 5)
INPUTS = len(ORDERS) + 1
#: How often a word's beginning was seen, in steps: never, once, up to 3, 15, 255 times, more often.
STEPS = (1, 2, 4, 16, 256)
GATES = INPUTS * (len(STEPS) + 1)
LEVELS = 33
LIMIT = 10.0
#: What is added to the counts of zeros and ones.
PRIOR = 0.05
SHARPNESS = (0.8, 1.0, 1.2)
END = b"\n"
LM_CHUNK = 1 << 20
#: Bytes of text that are scored together; a longer text is a chunk of its own.
SCORE_CHUNK = 24 << 20
#: Distinct words of a chunk that are kept together, bytes of words of a block, and grams of a bucket on average.
CHUNK_WORDS = 1_500_000
BLOCK_BYTES = 2 << 20
BUCKET_GRAMS = 500_000
#: Orders whose counts go to all tasks, as do those of word beginnings of at most so many bytes.
SHORT = 2
SOURCE = "source long, ids array<long>, held_out array<boolean>, texts binary, words array<binary>, n array<long>, grams binary, times binary, size long"
BLOCK = "source long, words array<binary>, n array<long>, c array<long>, first array<boolean>, asked binary, asking binary"
NEEDED = "source long, bucket int, costs binary, words binary, lengths binary, c binary"
WEIGHTS = "part long, n double, weights binary, seen binary"
PART = "bucket int, source long, grams binary, times binary, prefix binary"
#: Distinct grams a task keeps together before it hands them on.
HELD = 1_500_000
#: Per predictor: what was seen beside each of the eight bits of a byte, and how often the byte itself was.
PATH = 9
_CONTEXT = max(ORDERS)


def coded_text(text: bytes | None) -> bytes:
    return b" ".join((text or b"").lower().split()) + END


def byte_grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every coded byte with the bytes before it, as one number, text after text; a hash of the word's bytes before it; and
    where each text starts."""
    return coded_grams([coded_text(t) for t in texts])


def coded_grams(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``byte_grams`` of coded texts."""
    lead = END * _CONTEXT
    raw = np.frombuffer(b"".join(lead + b for b in bodies), np.uint8).astype(np.uint64)
    grams = np.zeros(max(len(raw) - _CONTEXT, 0), np.uint64)
    for k in range(_CONTEXT + 1):
        grams = (grams << np.uint64(8)) | raw[k:len(raw) - _CONTEXT + k]
    odd = 0x9DDFEA08EB382D69
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(raw), odd, np.uint64)], dtype=np.uint64)
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(raw), pow(odd, -1, 1 << 64), np.uint64)], dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum((raw + np.uint64(1)) * powers[:-1], dtype=np.uint64)]
    places = np.arange(len(raw))
    breaks = np.where((raw == 32) | (raw == END[0]), places + 1, 0)
    first = np.r_[0, np.maximum.accumulate(breaks)[:-1]] if len(raw) else places
    prefix = mixed((sums[:-1] - sums[first]) * back[first])[_CONTEXT:]
    lengths = np.array([len(b) for b in bodies], np.int64)
    starts = np.r_[0, np.cumsum(lengths)]
    keep = np.repeat(np.arange(len(bodies)) * _CONTEXT, lengths) + np.arange(starts[-1])
    return grams[keep], prefix[keep], starts


def gram_keys(grams: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    return mixed(grams ^ mixed(prefix))


def distinct_grams(grams: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each distinct (gram, prefix) stands first, which one every byte is, and how often each occurs."""
    _, at, inverse, numbers = np.unique(gram_keys(grams, prefix), return_index=True, return_inverse=True, return_counts=True)
    return at, inverse, numbers


def odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))), -LIMIT, LIMIT)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -16, 16)))


@dataclass
class Mixer:
    """Weights by gate (last one a constant) and the refinement table by gate and level."""

    weights: np.ndarray
    seen: np.ndarray

    def mix(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = self.weights[:, -1].astype(inputs.dtype)[gate]
        for k in range(INPUTS):
            total = total + inputs[..., k] * self.weights[:, k].astype(inputs.dtype)[gate]
        return np.clip(total, -LIMIT, LIMIT)

    def refined(self, mixed_odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        level = np.rint((mixed_odds + LIMIT) * ((LEVELS - 1) / (2 * LIMIT))).astype(np.int64)
        known = odds(self.seen[..., 0], self.seen[..., 1]).astype(mixed_odds.dtype)
        return (mixed_odds + known[gate, level]) / 2


def path_counts(context: np.ndarray, symbol: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For every byte after a context, rows in the order of both: how often the other value of each of its bits was seen after the
    same bits so far, and how often the byte itself."""
    counts = np.empty((len(context), PATH), np.float32)
    above = None
    for step in range(PATH):
        node = symbol >> (8 - step)
        new = np.r_[True, (context[1:] != context[:-1]) | (node[1:] != node[:-1])]
        starts = np.flatnonzero(new)
        here = np.repeat(np.add.reduceat(numbers, starts), np.diff(np.r_[starts, len(context)]))
        if step:
            counts[:, step - 1] = above - here
        above = here
    counts[:, -1] = above
    return counts


def bit_inputs(counts: np.ndarray, symbol: np.ndarray, left_out: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of a one and gate for each bit of each byte, and the bits; ``left_out`` occurrences of the byte itself are taken
    out of its counts, which has a row of ``PATH`` numbers per predictor."""
    step = np.arange(8)
    bits = ((symbol.astype(np.int64)[:, None] >> (7 - step)) & 1).astype(np.int8)
    other = counts[..., :8]
    later = np.cumsum(other[..., ::-1], axis=-1, dtype=np.float64)[..., ::-1] - other
    taken = np.maximum((later + counts[..., 8:]).astype(np.float32) - left_out, 0)
    total = taken + other
    gate = (total[:, :-1] > 0).sum(axis=1) + INPUTS * np.digitize(total[:, -1], STEPS)
    inputs = odds(other, taken) * np.where(bits == 1, np.float32(1), np.float32(-1))[:, None]
    return inputs.transpose(0, 2, 1), gate, bits


def train_mixer(
    counts: np.ndarray, grams: np.ndarray, prefix: np.ndarray, numbers: np.ndarray, rate: float = 0.08, batch: int = 1024
) -> Mixer:
    """Online steps over the grams in hash order, each gram weighing its number of occurrences; steps shrink with the
    gradients seen so far."""
    mixer = Mixer(np.full((GATES, INPUTS + 1), 0.12), np.full((GATES, LEVELS, 2), 0.0))
    mixer.weights[:, -2:] = 0.6, 0.0
    centre = squash((np.arange(LEVELS) / (LEVELS - 1) * 2 - 1) * LIMIT)
    mixer.seen += np.stack([1 - centre, centre], axis=-1)
    order = np.argsort(mixed(grams ^ prefix), kind="stable")
    squares = np.full((GATES, INPUTS + 1), 1e-6)
    for start in range(0, len(order), batch):
        at = order[start:start + batch]
        inputs, gate, bits = bit_inputs(counts[at], grams[at] & np.uint64(0xFF), 1)
        inputs, gate, bits = inputs.reshape(-1, INPUTS), gate.reshape(-1), bits.reshape(-1).astype(np.int64)
        dot = mixer.mix(inputs, gate)
        weight = np.repeat(numbers[at].astype(np.float64), 8)
        level = np.rint((dot + LIMIT) * ((LEVELS - 1) / (2 * LIMIT))).astype(np.int64)
        cells = np.bincount((gate * LEVELS + level) * 2 + bits, weight, GATES * LEVELS * 2)
        mixer.seen += cells.reshape(mixer.seen.shape)
        error = (bits - squash(dot)) * weight
        total = np.maximum(np.bincount(gate, weight, GATES), 1e-9)
        parts = [np.bincount(gate, error * inputs[:, k], GATES) for k in range(INPUTS)] + [np.bincount(gate, error, GATES)]
        step = np.stack(parts, axis=1) / total[:, None]
        squares += step * step
        mixer.weights += rate * step / np.sqrt(squares)
    return mixer


@dataclass
class Model:
    """The distinct grams of the training texts with their numbers, as a table, and the mixing weights."""

    grams: DataFrame
    mixer: Mixer

    def final_odds(self, grams: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Refined log odds of a one for every bit, and the bits; a look-up for few grams."""
        spark = self.grams.sparkSession
        asked = spark.createDataFrame(list(zip(grams.view(np.int64).tolist(), prefix.view(np.int64).tolist())), "gram long, prefix long")
        every = self.grams.unionByName(asked.withColumn("n", F.lit(0).cast("long"))).groupBy("gram", "prefix").agg(F.sum("n").alias("n"))
        rows = with_counts(every).join(asked.distinct(), ["gram", "prefix"], "left_semi").collect()  # at most what was asked for
        known = {(r["gram"], r["prefix"]): r["counts"] for r in rows}
        counts = _numbers([known[key] for key in zip(grams.view(np.int64).tolist(), prefix.view(np.int64).tolist())])
        return final_odds(self.mixer, counts, grams & np.uint64(0xFF))


def final_odds(mixer: Mixer, counts: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inputs, gate, bits = bit_inputs(counts, symbol)
    return mixer.refined(mixer.mix(inputs, gate), gate), bits


def bit_costs(mixer: Mixer, counts: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """log10 probability of each byte, per degree of sharpness."""
    costs = np.empty((len(symbol), len(SHARPNESS)), np.float32)
    for a in range(0, len(symbol), 16384):
        final, bits = final_odds(mixer, counts[a:a + 16384], symbol[a:a + 16384])
        final = np.where(bits == 1, -final, final)
        for s, sharp in enumerate(SHARPNESS):
            costs[a:a + 16384, s] = -np.log1p(np.exp(np.clip(sharp * final, -16, 16))).sum(axis=1) / np.log(10)
    return costs


def _merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    grams, prefix, numbers = (np.concatenate([p[k] for p in parts]) for k in range(3))
    at, inverse, _ = distinct_grams(grams, prefix)
    return grams[at], prefix[at], np.bincount(inverse, numbers, len(at)).astype(np.int64)


def _numbers(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float32).reshape(-1, INPUTS, PATH)


def _blobs(values: np.ndarray) -> pa.Array:
    """One binary value per row of a two-dimensional array."""
    data = np.ascontiguousarray(values)
    ends = np.arange(len(data) + 1, dtype=np.int32) * np.int32(data[0].nbytes if len(data) else 0)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _kept(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` as a compressed table in the shared folder."""
    folder = workspace(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def _chunk_grams(batches):
    """Distinct grams of each chunk, with their numbers in training texts; merged whenever ``HELD`` have come together."""
    held, total, current = [], 0, None

    def batch_of(grams, prefix, numbers):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(grams), current)), pa.array(grams.view(np.int64)), pa.array(prefix.view(np.int64)), pa.array(numbers)],
            ["chunk", "gram", "prefix", "n"],
        )

    for batch in batches:
        raw, owner = text_bytes(batch["text"]), batch["chunk"].to_numpy(zero_copy_only=False)
        learned = ~batch["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, np.int64)
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if held and owner[first] != current:
                yield batch_of(*_merged(held))
                held, total = [], 0
            current = int(owner[first])
            for start, end in chunks(raw[first:last], LM_CHUNK):
                grams, prefix, starts = byte_grams(raw[first + start:first + end])
                at, inverse, _ = distinct_grams(grams, prefix)
                weight = np.repeat(learned[first + start:first + end].astype(np.float64), np.diff(starts))
                held.append((grams[at], prefix[at], np.bincount(inverse, weight, len(at)).astype(np.int64)))
                total += len(at)
                if total > HELD:
                    held = [_merged(held)]
                    total = len(held[0][0])
                    if total > HELD // 2:
                        yield batch_of(*held[0])
                        held, total = [], 0
    if held:
        yield batch_of(*_merged(held))


def _paths(batches):
    """``path_counts`` of rows in the order of context and symbol; the last context of a batch waits for the next batch."""

    def batch_of(context, symbol, numbers):
        return pa.RecordBatch.from_arrays(
            [pa.array(context), pa.array(symbol), _blobs(path_counts(context, symbol, numbers))], ["context", "symbol", "path"]
        )

    held = None
    for batch in batches:
        part = [batch[c].to_numpy(zero_copy_only=False) for c in ("context", "symbol", "n")]
        if not len(part[0]):
            continue
        held = part if held is None else [np.concatenate(x) for x in zip(held, part)]
        cut = len(held[0]) - int(np.argmax(held[0][::-1] != held[0][-1])) if held[0][0] != held[0][-1] else 0
        if cut:
            yield batch_of(*[x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if held is not None:
        yield batch_of(*held)


def _with_paths(level: DataFrame) -> DataFrame:
    """context, symbol and path of a table context, symbol, n with one row per context and symbol."""
    dealt = level.repartition("context").sortWithinPartitions("context", "symbol")
    return dealt.mapInArrow(_paths, "context long, symbol long, path binary")


def with_counts(grams: DataFrame) -> DataFrame:
    """``grams`` (gram, prefix, n; one row per gram and prefix) with the counts of every predictor: ``PATH`` numbers each."""
    symbol = F.col("gram").bitwiseAND(255)
    summed = F.sum("n").alias("n")
    levels = [grams.groupBy(F.shiftright("gram", 8).alias("context"), symbol.alias("symbol")).agg(summed)]
    for order in ORDERS[-2::-1]:
        shorter = F.col("context").bitwiseAND((1 << (8 * order)) - 1)
        levels.append(levels[-1].groupBy(shorter.alias("context"), "symbol").agg(summed))
    known = None
    for order, level in zip(ORDERS, reversed(levels)):
        paths = _with_paths(level)
        if known is None:
            known = paths.withColumnRenamed("path", "counts")
            continue
        below = known.withColumnRenamed("context", "shorter")
        longer = paths.withColumn("shorter", F.col("context").bitwiseAND((1 << (8 * (order - 1))) - 1))
        known = longer.join(below, ["shorter", "symbol"]).select("context", "symbol", F.concat("counts", "path").alias("counts"))
    words = _with_paths(grams.groupBy(F.col("prefix").alias("context"), symbol.alias("symbol")).agg(summed))
    keyed = grams.withColumn("context", F.shiftright("gram", 8)).withColumn("symbol", symbol)
    both = attach_group_facts(keyed, words.withColumnRenamed("context", "prefix"), ["prefix", "symbol"], ["context"])
    return both.join(known, ["context", "symbol"]).select("gram", "prefix", "n", F.concat("counts", "path").alias("counts"))


def _weights(part: int, mixer: Mixer, numbers: np.ndarray) -> pa.RecordBatch:
    total = float(numbers.sum())
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int64()), pa.array([total]), pa.array([(total * mixer.weights).tobytes()], pa.binary()), pa.array([mixer.seen.tobytes()], pa.binary()),
    ], ["part", "n", "weights", "seen"])


def _summed(batches):
    rows = [r for b in batches for r in b.to_pylist()]
    if rows:
        weights, seen = (np.sum([np.frombuffer(r[c]) for r in rows], axis=0) for c in ("weights", "seen"))
        yield pa.RecordBatch.from_arrays([
            pa.array([rows[0]["part"]]), pa.array([sum(r["n"] for r in rows)]), pa.array([weights.tobytes()], pa.binary()), pa.array([seen.tobytes()], pa.binary()),
        ], ["part", "n", "weights", "seen"])


def _averaged(learned: DataFrame, parts: int) -> Mixer:
    """The weights of ``parts`` mixers by their numbers of bytes, first within the square root of as many groups, in a fixed order."""
    groups = max(1, int(parts**0.5))
    total, weights, seen = 0.0, np.zeros((GATES, INPUTS + 1)), np.zeros((GATES, LEVELS, 2))
    summed = learned.repartition(groups, "part").sortWithinPartitions("part").mapInArrow(_summed, WEIGHTS)
    for row in sorted(summed.collect(), key=lambda r: r["part"]):
        total += row["n"]
        weights += np.frombuffer(row["weights"]).reshape(weights.shape)
        seen += np.frombuffer(row["seen"]).reshape(seen.shape)
    return Mixer(weights / total if total else weights, seen)


def _learned(counted: DataFrame) -> Mixer:
    """Mixing weights over the grams of training texts: each task learns from its own, the weights are averaged."""

    def learn(batches):
        from pyspark import TaskContext

        parts = []
        for b in batches:
            grams, prefix, numbers = (b[c].to_numpy(zero_copy_only=False) for c in ("gram", "prefix", "n"))
            parts.append((grams, prefix, numbers, _numbers(b["counts"].to_pylist())))
        if parts and sum(len(x[0]) for x in parts):
            grams, prefix, numbers, counts = (np.concatenate([x[k] for x in parts]) for k in range(4))
            yield _weights(TaskContext.get().partitionId(), train_mixer(counts, grams.view(np.uint64), prefix.view(np.uint64), numbers), numbers)

    return _averaged(counted.filter("n > 0").mapInArrow(learn, WEIGHTS), 64)


def _gram_table(chunked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct grams of each chunk, and over all chunks with their numbers in training texts."""
    pieces = chunked.mapInArrow(_chunk_grams, "chunk long, gram long, prefix long, n long")
    return pieces, pieces.groupBy("gram", "prefix").agg(F.sum("n").alias("n"))


def train_model(training: DataFrame) -> Model:
    """Learn from all texts of ``training`` (a column text). Without texts every bit costs one bit."""
    rows = training.select(F.lit(False).alias("held_out"), whole_text("text").alias("text"), F.lit(0).cast("long").alias("chunk"))
    grams = _kept(_gram_table(rows)[1], "lm-grams")
    return Model(grams, _learned(_kept(with_counts(grams), "lm-counts")))


def squeezed(values: np.ndarray) -> bytes:
    """Numbers, byte after byte of their places, compressed."""
    flat = np.ascontiguousarray(values)
    return zstandard.compress(flat.view(np.uint8).reshape(-1, flat.dtype.itemsize).T.tobytes(), 3)


def unsqueezed(blob: bytes, kind=np.uint64) -> np.ndarray:
    places = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(places.T).reshape(-1).view(kind)


def raised(grams: np.ndarray) -> np.ndarray:
    """The steps between sorted grams."""
    return np.diff(grams, prepend=np.uint64(0))


def open_grams(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 6-grams of coded texts that hold a blank or a start before their last byte, and where each text starts; every text has some."""
    lead = END * _CONTEXT
    raw = np.frombuffer(lead.join([b"", *bodies]), np.uint8)
    ends = np.cumsum([len(b) + _CONTEXT for b in bodies])
    size = len(raw) - _CONTEXT
    breaks = (raw == 32) | (raw == END[0])
    wanted = breaks[:size].copy()
    for k in range(1, _CONTEXT):
        wanted |= breaks[k:size + k]
    wanted[(ends[:-1, None] - _CONTEXT + np.arange(_CONTEXT)).ravel()] = False
    wide = raw.astype(np.uint64)
    grams = wide[:size].copy()
    for k in range(1, _CONTEXT + 1):
        grams <<= np.uint64(8)
        grams |= wide[k:size + k]
    at = np.flatnonzero(wanted)
    return grams[at], np.searchsorted(at, np.r_[0, ends[:-1]])


def ended_words(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of texts, each with the sign after it, as codes into distinct ones, and where each text starts. A text without words is its
    end sign alone."""
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    coded = pa.array([w for x in lists for w in x], pa.large_binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2
    codes[starts[1:] - 1] += 1
    there = np.zeros(2 * len(coded.dictionary), bool)
    there[codes] = True
    both = np.flatnonzero(there)
    signs = pa.array([b" ", END], pa.large_binary()).take(pa.array(both & 1))
    distinct = pc.binary_join_element_wise(coded.dictionary.take(pa.array(both >> 1)), signs, pa.scalar(b"", pa.large_binary()))
    return (np.cumsum(there) - 1)[codes], starts[:-1], distinct


def slots(keys: np.ndarray) -> np.ndarray:
    """A table of the places of distinct keys by their hash; a key whose slot is taken goes to the next."""
    table = np.full(1 << (int(len(keys)).bit_length() + 2), -1, np.int32)
    left, spot = np.arange(len(keys), dtype=np.int32), mixed(keys) & np.uint64(len(table) - 1)
    while len(left):
        free = table[spot] < 0
        table[spot[free]] = left[free]
        missed = table[spot] != left
        left, spot = left[missed], (spot[missed] + np.uint64(1)) & np.uint64(len(table) - 1)
    return table


def places(table: np.ndarray, keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where the asked numbers, all among ``keys``, stand there."""
    spot = mixed(asked) & np.uint64(len(table) - 1)
    out = table[spot]
    left = np.flatnonzero(keys[out] != asked)
    while len(left):
        spot[left] = (spot[left] + np.uint64(1)) & np.uint64(len(table) - 1)
        out[left] = table[spot[left]]
        left = left[keys[out[left]] != asked[left]]
    return out


def inner_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of ended words behind five others of the word: 6-grams, 48 bits of hash of the word before each, never 0, and the word of each."""
    grams, prefix, starts = coded_grams(words)
    owner = np.repeat(np.arange(len(words)), np.diff(starts))
    inner = np.arange(len(grams)) - starts[:-1][owner] >= _CONTEXT
    return grams[inner], prefix[inner] & np.uint64((1 << 48) - 1) | np.uint64(1 << 48), owner[inner]


def buckets_of(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grams by bucket and number: their order, the buckets that have some and where each starts (one entry more)."""
    bucket = (mixed((grams >> np.uint64(8)) & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((grams, bucket))
    found, starts = np.unique(bucket[order], return_index=True)
    return order, found, np.r_[starts, len(order)]


def _chunk_sources(batches):
    """Chunks of coded texts with their distinct words and open grams and the numbers of these in training texts, 0 for those of held-out texts."""
    from pyspark import TaskContext

    source, held, ids, total, found = TaskContext.get().partitionId() << 32, [], [], 0, 0

    def row():
        words = pa.concat_tables([h[0] for h in held]).group_by("word").aggregate([("n", "sum")])
        word, n = words["word"].combine_chunks().cast(pa.binary()), words["n_sum"].combine_chunks()
        grams, inverse = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
        times = np.bincount(inverse, np.concatenate([h[2] for h in held]), len(grams)).astype(np.int64)
        own, out = (pa.concat_arrays([x[k] for x in ids]) for k in range(2))
        ends, lines = pa.array([0, len(word)], pa.int32()), pa.array([0, len(own)], pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array([source]), pa.ListArray.from_arrays(lines, own), pa.ListArray.from_arrays(lines, out),
            pa.array([zstandard.compress(b"".join(h[3] for h in held), 5)]), pa.ListArray.from_arrays(ends, word), pa.ListArray.from_arrays(ends, n),
            pa.array([squeezed(raised(grams))]), pa.array([squeezed(times)]), pa.array([len(grams)]),
        ], ["source", "ids", "held_out", "texts", "words", "n", "grams", "times", "size"])

    for batch in batches:
        raw = text_bytes(batch["text"])
        learned = ~batch["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        for start, end in chunks(raw, LM_CHUNK):
            size = sum(len(t) for t in raw[start:end])
            if held and (total + size > SCORE_CHUNK or found > CHUNK_WORDS):
                yield row()
                source, held, ids, total, found = source + 1, [], [], 0, 0
            lists = [t.lower().split() or [b""] for t in raw[start:end]]
            bodies = [b" ".join(x) + END for x in lists]
            codes, starts, distinct = ended_words(lists)
            n = np.bincount(codes, np.repeat(learned[start:end], np.diff(np.r_[starts, len(codes)])), len(distinct)).astype(np.int64)
            grams, starts = open_grams(bodies)
            both = np.sort((grams << np.uint64(1)) | np.repeat(learned[start:end], np.diff(np.r_[starts, len(grams)])))
            at = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
            times = np.diff(np.r_[at, len(both)]) * (both[at] & np.uint64(1)).astype(np.int64)
            held.append((pa.table({"word": distinct, "n": n}), both[at] >> np.uint64(1), times, b"".join(bodies)))
            ids.append((batch["doc_id"].slice(start, end - start), batch["held_out"].slice(start, end - start)))
            total, found = total + size, found + len(distinct)
    if held:
        yield row()


def _word_blocks(batches):
    """Blocks of words with their numbers over all chunks (``n`` with the sign after it, ``c`` with either), from rows in the order of word and sign;
    ``first`` marks one row a word, ``asked`` and ``asking`` tell which word which chunk asks for."""
    from pyspark import TaskContext

    source, held = -1 - (TaskContext.get().partitionId() << 32), None

    def row(rows):
        bare, last, asking, n = (rows[c].combine_chunks() for c in ("bare", "last", "source", "n"))
        last, n = last.to_numpy(zero_copy_only=False).astype(np.int64), n.to_numpy()
        fresh = np.r_[True, pc.not_equal(bare[1:], bare[:-1]).to_numpy(zero_copy_only=False)]
        ended = fresh | np.r_[True, last[1:] != last[:-1]]
        at = np.flatnonzero(ended)
        signs = pa.array([b" ", END], pa.binary()).take(pa.array(last[at]))
        words = pc.binary_join_element_wise(bare.take(pa.array(at)), signs, pa.scalar(b"", pa.binary()))
        c = np.add.reduceat(n, np.flatnonzero(fresh))[np.cumsum(fresh)[at] - 1]
        ends = pa.array([0, len(at)], pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array([source]), pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(np.add.reduceat(n, at))),
            pa.ListArray.from_arrays(ends, pa.array(c)), pa.ListArray.from_arrays(ends, pa.array(fresh[at])),
            pa.array([squeezed(np.cumsum(ended) - 1)]), pa.array([squeezed(asking.to_numpy())]),
        ], ["source", "words", "n", "c", "first", "asked", "asking"])

    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held["bare"].nbytes > BLOCK_BYTES:
            held = held.combine_chunks()
            other = pc.not_equal(held["bare"], held["bare"][-1]).to_numpy()
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if cut:
                yield row(held.slice(0, cut))
                source, held = source - 1, held.slice(cut).take(pa.array(np.arange(len(held) - cut)))
    if held is not None and len(held):
        yield row(held)


def _parts(source: pa.Scalar, grams: np.ndarray, times: np.ndarray, prefix: np.ndarray | None, buckets: int) -> pa.RecordBatch:
    order, found, starts = buckets_of(grams, buckets)
    spans = [order[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    return pa.RecordBatch.from_arrays([
        pa.array(found, pa.int32()), pa.repeat(source, len(found)), pa.array([squeezed(raised(grams[x])) for x in spans], pa.binary()),
        pa.array([squeezed(times[x]) for x in spans], pa.binary()),
        pa.array([None if prefix is None else squeezed(prefix[x]) for x in spans], pa.binary()),
    ], ["bucket", "source", "grams", "times", "prefix"])


def _by_bucket(batches):
    """The rows of each bucket of a task, which are in the order of buckets: source numbers, their sizes, grams, times, hashes of
    beginnings (0 for open grams)."""

    def whole(bucket, rows):
        parts = [(s, np.cumsum(unsqueezed(g), dtype=np.uint64), unsqueezed(t, np.int64), p) for s, g, t, p in rows]
        prefix = [np.zeros(len(g), np.uint64) if p is None else unsqueezed(p) for _, g, _, p in parts]
        return bucket, [x[0] for x in parts], [len(x[1]) for x in parts], np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]), np.concatenate(prefix)

    bucket, rows = None, []
    for batch in batches:
        for b, *row in zip(*(batch[c].to_pylist() for c in ("bucket", "source", "grams", "times", "prefix"))):
            if rows and b != bucket:
                yield whole(bucket, rows)
                rows = []
            bucket = b
            rows.append(row)
    if rows:
        yield whole(bucket, rows)


def beginnings(grams: np.ndarray) -> np.ndarray:
    """Bytes since the last blank or start before the last byte of open grams."""
    length = np.full(len(grams), _CONTEXT, np.int64)
    for k in range(_CONTEXT, 0, -1):
        byte = (grams >> np.uint64(8 * k)) & np.uint64(0xFF)
        length[(byte == 32) | (byte == END[0])] = k - 1
    return length


def low_keys(grams: np.ndarray, size: np.ndarray | int, kind: np.ndarray | int) -> np.ndarray:
    """Kind of a short context, its ``size`` bytes and the byte after it as one number."""
    mask = (np.uint64(1) << np.uint64(8) * (np.asarray(size).astype(np.uint64) + np.uint64(1))) - np.uint64(1)
    return (np.asarray(kind).astype(np.uint64) << np.uint64(32)) | (grams & mask)


def _low_counts(batches):
    for _, _, _, grams, times, prefix in _by_bucket(batches):
        length = np.where(prefix == 0, beginnings(grams), _CONTEXT)
        short = length <= SHORT
        keys = np.concatenate([low_keys(grams, SHORT, SHORT), low_keys(grams[short], length[short], SHORT + 1 + length[short])])
        keys, inverse = np.unique(keys, return_inverse=True)
        n = np.bincount(inverse, np.concatenate([times, times[short]]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])


def low_paths(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and ``path_counts`` of the short contexts; ``keys`` hold order ``SHORT`` and the short beginnings."""
    for order in range(SHORT - 1, 0, -1):
        own = (keys >> np.uint64(32)) == np.uint64(order + 1)
        keys, numbers = np.r_[keys, low_keys(keys[own], order, order)], np.r_[numbers, numbers[own]]
    keys, inverse = np.unique(keys, return_inverse=True)
    numbers = np.bincount(inverse, numbers, len(keys)).astype(np.int64)
    return keys, path_counts(keys >> np.uint64(8), (keys & np.uint64(0xFF)).astype(np.int64), numbers) if len(keys) else np.zeros((0, PATH), np.float32)


def bucket_counts(grams: np.ndarray, prefix: np.ndarray, numbers: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The counts of every predictor for the distinct grams of a bucket: ``PATH`` numbers each."""
    counts = np.zeros((len(grams), INPUTS, PATH), np.float32)
    symbol = (grams & np.uint64(0xFF)).astype(np.int64)
    for k, order in enumerate(ORDERS):
        if order <= SHORT:
            counts[:, k] = low[1][np.searchsorted(low[0], low_keys(grams, order, order))]
            continue
        key = grams & np.uint64((1 << (8 * (order + 1))) - 1)
        by = np.argsort(key, kind="stable")
        counts[by, k] = path_counts(key[by] >> np.uint64(8), symbol[by], numbers[by])
    length = np.where(prefix == 0, beginnings(grams), _CONTEXT)
    short = length <= SHORT
    counts[short, -1] = low[1][np.searchsorted(low[0], low_keys(grams[short], length[short], SHORT + 1 + length[short]))]
    rest = np.flatnonzero(~short)
    if len(rest):
        begun = np.where(prefix[rest] == 0, low_keys(grams[rest] >> np.uint64(8), length[rest] - 1, 0) | (length[rest].astype(np.uint64) << np.uint64(40)), prefix[rest])
        by = np.lexsort((symbol[rest], begun))
        counts[rest[by], -1] = path_counts(begun[by], symbol[rest][by], numbers[rest][by])
    return counts


def _scores(sources: DataFrame, blocks: DataFrame, tokens: int, distinct: int, ends: int) -> DataFrame:
    """The columns of ``score_texts`` for the texts of ``sources``."""
    spark = sources.sparkSession
    inner = blocks.select(F.explode("words").alias("word")).agg(F.sum(F.greatest(F.octet_length("word") - _CONTEXT, F.lit(0)))).first()[0] or 0
    asked = inner + (sources.agg(F.sum("size")).first()[0] or 0)
    buckets = int(max(1, -(-asked // BUCKET_GRAMS)))

    def chunk_parts(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                grams = np.cumsum(unsqueezed(batch["grams"][k].as_py()), dtype=np.uint64)
                yield _parts(batch["source"][k], grams, unsqueezed(batch["times"][k].as_py(), np.int64), None, buckets)

    def block_parts(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                grams, prefix, owner = inner_grams(batch["words"].slice(k, 1).flatten().to_pylist())
                yield _parts(batch["source"][k], grams, batch["n"].slice(k, 1).flatten().to_numpy(zero_copy_only=False)[owner], prefix, buckets)

    parts = sources.select("source", "grams", "times").mapInArrow(chunk_parts, PART).unionByName(blocks.select("source", "words", "n").mapInArrow(block_parts, PART))
    parts = durable(parts.repartition(buckets, "bucket").sortWithinPartitions("bucket"))
    low = parts.mapInArrow(_low_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # bounded by the alphabet of bytes
    low = low_paths(*(low[c].combine_chunks().to_numpy(zero_copy_only=False).view(kind) for c, kind in (("key", np.uint64), ("n", np.int64))))
    low = spark.sparkContext.broadcast(low)

    def learn(batches):
        for bucket, _, _, grams, times, prefix in _by_bucket(batches):
            grams, prefix, numbers = _merged([(grams, prefix, times)])
            if numbers.any():
                seen = numbers > 0
                counts = bucket_counts(grams, prefix, numbers, low.value)
                if not seen.all():
                    counts, grams, prefix, numbers = counts[seen], grams[seen], prefix[seen], numbers[seen]
                yield _weights(bucket, train_mixer(counts, grams, prefix, numbers), numbers)

    learned = _averaged(parts.mapInArrow(learn, WEIGHTS), buckets)
    shared = spark.sparkContext.broadcast((learned.weights, learned.seen))  # plain arrays: executors need no copy of the package

    def priced(of_words):
        """Costs of the grams that blocks of words ask for, or of those that chunks ask for."""

        def price(batches):
            mixer = Mixer(*shared.value)
            for bucket, own, sizes, grams, times, prefix in _by_bucket(batches):
                at, inverse, _ = distinct_grams(grams, prefix)
                grams, prefix = grams[at], prefix[at]
                numbers = np.bincount(inverse, times, len(at)).astype(np.int64)
                wanted = (prefix != 0) == of_words
                costs = np.zeros((len(grams), len(SHARPNESS)), np.float32)
                costs[wanted] = bit_costs(mixer, bucket_counts(grams, prefix, numbers, low.value)[wanted], grams[wanted] & np.uint64(0xFF))
                ends = np.r_[0, np.cumsum(sizes)].tolist()
                rows = [(x, squeezed(costs[inverse[a:b]].T)) for x, a, b in zip(own, ends[:-1], ends[1:]) if (x < 0) == of_words]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x for x, _ in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()), pa.array([c for _, c in rows], pa.binary()),
                ], ["source", "bucket", "costs"])

        return parts.mapInArrow(price, "source long, bucket int, costs binary")

    def returned(grams, bucket, costs):
        """Costs in the order of ``grams``, from those by bucket."""
        out = np.zeros((len(grams), len(SHARPNESS)), np.float32)
        blobs = [costs[k].as_py() for k in np.argsort(bucket, kind="stable").tolist()]
        if blobs:
            out[buckets_of(grams, buckets)[0]] = np.concatenate([unsqueezed(x, np.float32).reshape(len(SHARPNESS), -1).T for x in blobs])
        return out

    def answers(block: pa.Table, costs: pa.Table) -> pa.Table:
        """For every chunk the words of a block that it asks for, with the cost of their inner bytes and their numbers."""
        words = block["words"].combine_chunks().flatten()
        c = block["c"].combine_chunks().flatten().to_numpy()
        grams, _, owner = inner_grams(words.to_pylist())
        values = returned(grams, costs["bucket"].to_numpy(), costs["costs"])
        sums = np.stack([np.bincount(owner, values[:, s], len(words)) for s in range(len(SHARPNESS))]).astype(np.float32)
        word, asking = unsqueezed(block["asked"][0].as_py(), np.int64), unsqueezed(block["asking"][0].as_py(), np.int64)
        order = np.argsort(asking, kind="stable")
        found, starts = np.unique(asking[order], return_index=True)
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
        spans = [word[order[a:b]] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)])]
        return pa.table({
            "source": pa.array(found), "bucket": pa.nulls(len(found), pa.int32()), "costs": pa.array([squeezed(sums[:, x]) for x in spans], pa.binary()),
            "words": pa.array([zstandard.compress(b"".join(words.take(pa.array(x)).to_pylist()), 3) for x in spans], pa.binary()),
            "lengths": pa.array([squeezed(lengths[x]) for x in spans], pa.binary()), "c": pa.array([squeezed(c[x]) for x in spans], pa.binary()),
        })

    told = blocks.select("source", "words", "c", "asked", "asking").groupBy("source")
    told = told.cogroup(priced(True).groupBy("source")).applyInArrow(answers, NEEDED)
    none = F.lit(None).cast("binary")
    needed = told.unionByName(priced(False).select("source", "bucket", "costs", none.alias("words"), none.alias("lengths"), none.alias("c")))
    divisor = tokens + 0.5 * (distinct + 1)

    def score(texts: pa.Table, needed: pa.Table) -> pa.Table:
        of_words = needed.filter(pc.is_null(needed["bucket"]))
        lengths = np.concatenate([unsqueezed(x, np.int32) for x in of_words["lengths"].to_pylist()])
        data = b"".join(zstandard.decompress(x) for x in of_words["words"].to_pylist())
        offsets = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
        words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        c = np.concatenate([unsqueezed(x, np.int64) for x in of_words["c"].to_pylist()])
        costs = np.concatenate([unsqueezed(x, np.float32).reshape(len(SHARPNESS), -1).T for x in of_words["costs"].to_pylist()])
        gain = np.where(lengths > 1, np.log10(c + 0.5) - np.log10(divisor), 0.0)
        known = (lengths > 1) & (c > 0)
        of_grams = needed.filter(pc.is_valid(needed["bucket"]))
        keys = np.cumsum(unsqueezed(texts["grams"][0].as_py()), dtype=np.uint64)
        values, table = returned(keys, of_grams["bucket"].to_numpy(), of_grams["costs"]), slots(keys)
        bodies = [b + END for b in zstandard.decompress(texts["texts"][0].as_py()).split(END)[:-1]]
        pieces, parts = chunks(bodies, LM_CHUNK), []
        for start, end in pieces:
            codes, starts, own = ended_words([b[:-1].split(b" ") for b in bodies[start:end]])
            parts.append((codes.astype(np.int32), starts, own))
        place = pc.index_in(pa.concat_arrays([p[2] for p in parts]), words).to_numpy(zero_copy_only=False)
        columns, before = [], 0
        for (start, end), (codes, starts, own) in zip(pieces, parts):
            at, before = place[before:before + len(own)][codes], before + len(own)
            grams, firsts = open_grams(bodies[start:end])
            sums = np.add.reduceat(costs[at], starts, axis=0, dtype=np.float64)
            sums += np.add.reduceat(values[places(table, keys, grams)], firsts, axis=0, dtype=np.float64)
            top = sums.max(axis=1)
            columns.append((
                np.add.reduceat((lengths > 1)[at], starts, dtype=np.int64) + 1, np.add.reduceat(known[at], starts, dtype=np.int64) + (ends > 0),
                np.add.reduceat(gain[at], starts) + np.log10((ends + 0.5) / divisor), top + np.log10((10.0 ** (sums - top[:, None])).mean(axis=1)),
            ))
        n_tokens, n_known, base, scores = (np.concatenate(x) for x in zip(*columns))
        sizes = np.array([len(b) for b in bodies], np.float64)
        return pa.table({
            "doc_id": texts["ids"].combine_chunks().flatten(), "held_out": texts["held_out"].combine_chunks().flatten(), "n_tokens": n_tokens, "n_known": n_known,
            "train_tokens": np.full(len(sizes), tokens, np.int64), "base_score": base, "score": scores, "bits_per_byte": -scores / np.log10(2.0) / sizes,
        })

    texts = sources.select("source", "ids", "held_out", "texts", "grams").groupBy("source")
    return texts.cogroup(needed.groupBy("source")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )


def score_texts(
    docs: DataFrame, modulus: int = 5, rest: int = 1, head: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the rows whose crc32(id) mod ``modulus`` is not ``rest``. ``base_score`` is the smoothed word model, ``score`` the log10
    probability of the coded text under the mixing model. A null or empty text is its end sign alone; repeated rows
    are each learned from and scored; without training rows counts are 0 and every bit costs one bit. ``head`` has no effect any more: no words
    are broadcast.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), held_out(id_column, modulus, rest).alias("held_out"), whole_text(text_column).alias("text")
    )
    sources = _kept(rows.mapInArrow(_chunk_sources, SOURCE), "lm-sources")
    asked = sources.select("source", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("n").alias("n"))))
    last = F.expr("substring(word, octet_length(word), 1)") == F.lit(END)
    asked = asked.select(F.expr("substring(word, 1, octet_length(word) - 1)").alias("bare"), last.alias("last"), "source", "n")
    blocks = _kept(asked.repartition("bare").sortWithinPartitions("bare", "last").mapInArrow(_word_blocks, BLOCK), "lm-words")
    counted = blocks.select(F.inline(F.arrays_zip(*(F.col(x).alias(y) for x, y in (("words", "word"), ("n", "n"), ("c", "c"), ("first", "once"))))))
    full = F.octet_length("word") > 1
    size = counted.agg(
        F.count_if(full & F.col("once") & (F.col("c") > 0)).alias("v"), F.sum(F.when(full, F.col("n"))).alias("n"), F.sum(F.when(last, F.col("n"))).alias("ends"),
    ).first()
    ends = size["ends"] or 0
    return _scores(sources, blocks, (size["n"] or 0) + ends, size["v"] + (ends > 0), ends)

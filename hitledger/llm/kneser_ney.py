"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, stored as sorted hash arrays,
memory-mapped by the workers that score.

Counting. Each task turns its texts into 64-bit word hashes, counts the n-grams of some
100,000 words at a time with array sorts, and sends each shard one packed array of (context, word, count). A shard's
task merges what it gets, writes its sorted arrays and sends the next lower order down: that order's
counts are the numbers of distinct words seen to the left, as Kneser-Ney asks. One job thus runs
from the highest order to single words. An n-gram's shard follows from its context, so a context's
totals meet in one place, except for frequent contexts, whose n-grams are spread by the whole
n-gram and whose totals are added one level on. Which contexts those are is read off a sample of
texts (``SAMPLE_BYTES``); it decides only where counting happens, never what is counted.

Probabilities. Three discounts per order from the counts of counts; lower orders interpolated; the
last step is uniform over the words of the training texts and one unknown word, so that all
probabilities of a context add up to 1. Texts are read as ``order - 1`` start marks, the words with
A-Z lowered, and an end mark, which is predicted like a word.

The arrays lie in the folder ``spark.checkpoint.dir`` names and are mapped, not loaded: what a
worker touches is shared with its neighbours through the page cache. Where that folder is not a
mounted file system, a worker holds the shards that it used last in memory, up to a bound.

Nulls and odd input: a null or empty text is the end mark alone; a null id is a training document;
repeated rows count each time; without training texts every word has probability 1 / 1; only the id
and the text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.llm.shared import file_system, folder, frugal, prepare, read_file, write_file
from hitledger.llm.words import find_words, hash_spans, joined, text_slices

START, END = np.uint64(0x51A2F3C4D5E60718), np.uint64(0xE9D8C7B6A5948372)
_NONE = np.uint64(0)
# Bytes of training text for each shard; a merging task holds some ten times as much.
SHARD_BYTES = 5 << 20
# Words that a task counts at once.
COUNT_WORDS = 600_000
# Texts read to find the frequent contexts, and how often a word must occur there.
SAMPLE_BYTES, SAMPLE_LEAST = 32 << 20, 50
# Bytes of text counted or scored at once, some thirty times as much in working arrays.
TEXT_BYTES = 1 << 20
# Shards that a worker keeps mapped, and bytes of those it holds in memory where it can't map.
MAPPED, HELD_BYTES = 1024, 256 << 20

_BLOBS = "shard int, kind string, n long, blob binary"
_BLOB_SCHEMA = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("n", pa.int64()), ("blob", pa.binary())])


def _tokens(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts with start marks, positions of those predicted, and each text's first of these."""
    words = find_words(data, offsets)
    n, texts = len(words.starts), len(offsets) - 1
    count = np.diff(words.first)
    owner = np.repeat(np.arange(texts), count)
    out = np.full(n + order * texts, START, np.uint64)
    at = np.arange(n) + owner * order + order - 1
    out[at] = hash_spans(data, words.starts, words.ends, fold=True)
    last = words.first[1:] + np.arange(1, texts + 1) * order - 1
    out[last] = END
    return out, np.sort(np.concatenate((at, last))), words.first[:-1] + np.arange(texts)


def _contexts(tokens: np.ndarray, at: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 0, 1, ... ``longest`` tokens before each position."""
    out = [np.zeros(len(at), np.uint64)]
    for k in range(1, longest + 1):
        h = tokens[at - k]
        for i in range(k - 1, 0, -1):
            h = joined(h, tokens[at - i])
        out.append(h)
    return out


def _grams(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One hash per n-gram; a single word is its own."""
    return np.where(context == _NONE, word, joined(context, word))


def _shards(context: np.ndarray, word: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram: by its context, by itself for frequent contexts and single words."""
    spread_out = context == _NONE
    if len(hot):
        spread_out |= hot[np.minimum(np.searchsorted(hot, context), len(hot) - 1)] == context
    return _place(np.where(spread_out, _grams(context, word), context), shards)


def _place(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys' first rows, and sums of the counts for each."""
    rows = np.argsort(keys, kind="stable")
    ranked = keys[rows]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), ranked[1:] != ranked[:-1])))
    return (rows[first], *(np.add.reduceat(c[rows], first) if len(first) else c for c in counts))


def _pack(context: np.ndarray, low: np.ndarray, word: np.ndarray, count: np.ndarray, raw: np.ndarray, shards: np.ndarray, n: int) -> Iterator[dict]:
    """A row for each shard: runs of equal contexts, each stored once."""
    rows = np.argsort(shards.astype(np.uint64) << np.uint64(40) | context >> np.uint64(24), kind="stable")
    shards, context, low, word, count, raw = (x[rows] for x in (shards, context, low, word, count, raw))
    cut = np.flatnonzero(shards[1:] != shards[:-1]) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(shards)]):
        if hi > lo:
            c = context[lo:hi]
            run = np.concatenate(([0], np.flatnonzero(c[1:] != c[:-1]) + 1))
            parts = [c[run], low[lo:hi][run] if n > 2 else c[:0], np.diff(np.append(run, hi - lo)).astype(np.uint64), word[lo:hi], count[lo:hi], raw[lo:hi]]
            head = np.array([len(run), hi - lo], np.uint64)
            yield {"shard": int(shards[lo]), "kind": "grams", "n": n, "blob": b"".join(x.tobytes() for x in (head, *parts))}


def _unpack(blob: bytes, n: int) -> tuple[np.ndarray, ...]:
    x = np.frombuffer(blob, np.uint64)
    runs, size = int(x[0]), int(x[1])
    lows = runs if n > 2 else 0
    context, low, length = x[2 : 2 + runs], x[2 + runs : 2 + runs + lows], x[2 + runs + lows : 2 + 2 * runs + lows].astype(np.int64)
    word, count, raw = x[2 + 2 * runs + lows :].reshape(3, size)
    return np.repeat(context, length), np.repeat(low if n > 2 else np.zeros(runs, np.uint64), length), word, count, raw


def _small(values: np.ndarray) -> list[np.ndarray]:
    """Counts as bytes, with the places and values of those that don't fit, all padded to 8 bytes."""
    large = np.flatnonzero(values >= 255)
    small = np.minimum(values, 255).astype(np.uint8)
    return [np.concatenate((small, np.zeros(-len(small) % 8, np.uint8))), large.astype(np.int64), values[large].astype(np.uint64)]


def _array_file(path: str, keys: np.ndarray, values: list[np.ndarray]) -> None:
    """Sorted keys and columns of counts: a head of sizes, then the arrays."""
    columns = [_small(v) for v in values]
    head = np.array([len(keys), len(values), *(len(c[1]) for c in columns)], np.int64)
    write_file(path, [np.ascontiguousarray(x).data.cast("B") for x in (head, keys, *(x for c in columns for x in c)) if len(x)])


class Arrays:
    """Sorted keys and counts of a file's bytes, mapped or in memory."""

    def __init__(self, x: np.ndarray) -> None:
        self.nbytes = 0 if isinstance(x, np.memmap) else x.nbytes
        n, columns = (int(v) for v in x[:16].view(np.int64))
        large = x[16 : 16 + 8 * columns].view(np.int64)
        at = 16 + 8 * columns
        self.keys = x[at : at + 8 * n].view(np.uint64)
        at += 8 * n
        self.columns = []
        for m in large.tolist():
            small, padded = x[at : at + n], n + -n % 8
            places, values = x[at + padded : at + padded + 16 * m].view(np.int64)[:m], x[at + padded + 8 * m : at + padded + 16 * m].view(np.uint64)
            self.columns.append((small, places, values))
            at += padded + 16 * m

    def find(self, keys: np.ndarray) -> list[np.ndarray]:
        """The counts of each key, 0 where it isn't there."""
        if not len(self.keys):
            return [np.zeros(len(keys), np.int64) for _ in self.columns]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        out = []
        for small, places, values in self.columns:
            count = np.where(known, small[at], 0).astype(np.int64)
            big = np.flatnonzero(count == 255)
            count[big] = values[np.searchsorted(places, at[big])]
            out.append(count)
        return out


@dataclass
class Model:
    """Where the arrays are, and the figures that all probabilities share."""

    path: str
    order: int
    shards: int
    hot: np.ndarray
    train_tokens: int = 0
    vocabulary: int = 0
    # Of each order: counts of counts 1 to 4, and of all beyond; sum of the counts.
    counts: dict[int, list[int]] = field(default_factory=dict)
    totals: dict[int, int] = field(default_factory=dict)

    def discounts(self, n: int) -> np.ndarray:
        """What is taken off a count of 0, 1, 2, 3 or more."""
        n1, n2, n3, n4 = self.counts[n][:4]
        if not all((n1, n2, n3, n4)):
            return np.array([0, 0.5, 1.0, 1.5])
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return np.array([0, *(min(max(x, 0.05), k) for k, x in enumerate(d, 1))])


# Of a worker: mapped shards by path, the least used first.
_mapped: OrderedDict[str, Arrays] = OrderedDict()


def _arrays(path: str) -> Arrays:
    if path not in _mapped:
        fs, name = file_system(path)
        _mapped[path] = Arrays(np.memmap(name, np.uint8, mode="r") if fs.type_name == "local" else np.frombuffer(read_file(path), np.uint8))
        while len(_mapped) > MAPPED or len(_mapped) > 1 and sum(x.nbytes for x in _mapped.values()) > HELD_BYTES:
            _mapped.popitem(last=False)
    _mapped.move_to_end(path)
    return _mapped[path]


def _look_up(model: Model, kind: str, shard: np.ndarray, keys: np.ndarray, columns: int) -> list[np.ndarray]:
    """Counts of keys: each distinct one is searched once, in order, in its shard's arrays."""
    distinct, where = np.unique(keys, return_inverse=True)
    of = np.zeros(len(distinct), np.int64)
    of[where] = shard
    rows = np.argsort(of, kind="stable")
    bound = np.searchsorted(of[rows], np.arange(model.shards + 1))
    out = [np.zeros(len(distinct), np.int64) for _ in range(columns)]
    for s in np.flatnonzero(np.diff(bound)):
        part = rows[bound[s] : bound[s + 1]]
        for into, found in zip(out, _arrays(f"{model.path}/{kind}-{s:07d}").find(distinct[part])):
            into[part] = found
    return [x[where] for x in out]


def _count_texts(batches: Iterator[pa.RecordBatch], order: int, hot: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []

    def counted() -> pa.RecordBatch:
        context, low, word = (np.concatenate(x) for x in zip(*held))
        held.clear()
        rows, count = _summed(_grams(context, word), np.ones(len(word), np.uint64))
        context, low, word = context[rows], low[rows], word[rows]
        found = list(_pack(context, low, word, count, count, _shards(context, word, hot, shards), order))
        return pa.RecordBatch.from_pylist(found, _BLOB_SCHEMA)

    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text"), TEXT_BYTES):
            tokens, at, _ = _tokens(data, offsets, order)
            contexts = _contexts(tokens, at, order - 1)
            held.append((contexts[-1], contexts[-2] if order > 1 else contexts[-1], tokens[at]))
            if sum(len(x[0]) for x in held) >= COUNT_WORDS:
                yield counted()
                pa.default_memory_pool().release_unused()
    if held:
        yield counted()


def _stats_row(n: int, values: list[int]) -> dict:
    return {"shard": -1, "kind": "stats", "n": n, "blob": np.array(values, np.int64).tobytes()}


def _merge(shard: int, rows: pa.Table, n: int, model: Model) -> Iterator[dict]:
    """Write one shard's arrays of order ``n`` and of the contexts above it; give what goes further down."""
    kinds, blobs, levels = (rows.column(c).to_pylist() for c in ("kind", "blob", "n"))
    if shard < 0:
        for kind, blob, level in zip(kinds, blobs, levels):
            yield {"shard": -1, "kind": kind, "n": level, "blob": blob}
        return
    parts = [_unpack(b, n) for k, b in zip(kinds, blobs) if k == "grams"]
    if n < model.order:
        above = [np.frombuffer(b, np.uint64).reshape(6, -1) for k, b in zip(kinds, blobs) if k == "contexts"]
        context, *sums = np.concatenate(above, axis=1) if above else np.zeros((6, 0), np.uint64)
        first, *sums = _summed(context, *sums)
        _array_file(f"{model.path}/contexts{n + 1}-{shard:07d}", context[first], sums[:4])
    context, low, word, count, raw = (np.concatenate(x) for x in zip(*parts)) if parts else np.zeros((5, 0), np.uint64)
    keys = _grams(context, word)
    first, count, raw = _summed(keys, count, raw)
    context, low, word, keys = context[first], low[first], word[first], keys[first]
    _array_file(f"{model.path}/grams{n}-{shard:07d}", keys, [count] if n > 1 else [count, raw])
    spectrum = np.bincount(np.minimum(count, 5).astype(np.int64), minlength=6)[1:6].tolist()
    yield _stats_row(n, [*spectrum, int(count.sum()), len(keys), int(raw.sum())])
    if n == 1:
        return
    first, total, *some = _summed(context, count, *((count == k).astype(np.uint64) for k in (1, 2)), (count > 2).astype(np.uint64), np.ones(len(count), np.uint64))
    of = context[first]
    table = np.stack((of, total, *some))
    place = _place(of, model.shards)
    for s in np.unique(place):
        yield {"shard": int(s), "kind": "contexts", "n": n, "blob": np.ascontiguousarray(table[:, place == s]).tobytes()}
    # One order down, each n-gram here is one distinct word to the left.
    shorter = _grams(low, word)
    first, distinct, raw = _summed(shorter, np.ones(len(word), np.uint64), raw)
    context, word = low[first], word[first]
    yield from _pack(context, np.zeros(len(word), np.uint64), word, distinct, raw, _shards(context, word, model.hot, model.shards), n - 1)


def _merging(n: int, model: Model) -> Callable[[tuple, pa.Table], pa.Table]:
    return lambda key, rows: pa.Table.from_pylist(list(_merge(key[0].as_py(), rows, n, model)), _BLOB_SCHEMA)


def _hot_words(docs: DataFrame, size: int, shards: int) -> np.ndarray:
    """Hashes of the words that are frequent enough in a sample to overfill a shard, and the start mark."""
    share = min(1.0, SAMPLE_BYTES / max(size, 1))
    cut = int(share * (1 << 30))
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) <= cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                tokens, at, _ = _tokens(data, offsets, 1)
                word, count = np.unique(tokens[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "count"])

    counts = sample.mapInArrow(run, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))
    least = max(SAMPLE_LEAST, int(share * size / 7 / (4 * shards)))
    found = counts.where(F.col("count") >= least).select("word").toPandas().word.to_numpy(np.int64).view(np.uint64)
    return np.unique(np.append(found, START))


def train(docs: DataFrame, order: int = 2, text: str = "text") -> Model:
    """Count the n-grams of all texts; orders 1 to 3."""
    if order not in (1, 2, 3):
        raise ValueError("orders 1 to 3 are supported")
    spark = docs.sparkSession
    prepare(spark)
    frugal(spark)
    docs = docs.select(F.col(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    model = Model(folder(spark, "language-model"), order, shards, np.zeros(0, np.uint64))
    if order > 1:
        model.hot = _hot_words(docs, size, shards)
    hot = model.hot

    rows = docs.mapInArrow(lambda batches: _count_texts(batches, order, hot, shards), _BLOBS)
    # Every shard gets its files, also one that no n-gram falls to.
    every = spark.range(-1, shards, 1, min(shards, 200)).select(F.col("id").cast("int").alias("shard"), F.lit("none").alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("blob"))
    for n in range(order, 0, -1):
        rows = rows.unionByName(every).groupBy("shard").applyInArrow(_merging(n, model), _BLOBS)
    # What is left are the shards' figures, a few numbers each, summed before they reach the driver.
    stats = rows.where("kind = 'stats'").mapInArrow(_stats_table, "n long, f array<long>")
    for row in stats.groupBy("n").agg(F.array(*(F.sum(F.col("f")[i]) for i in range(8))).alias("f")).collect():
        model.counts[row.n], model.totals[row.n] = list(row.f[:5]), row.f[5]
        if row.n == 1:
            model.vocabulary, model.train_tokens = row.f[6], row.f[7]
    return model


def _stats_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f = [np.frombuffer(b, np.int64).tolist() for b in batch.column("blob").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(f, pa.list_(pa.int64()))], names=["n", "f"])


def _probabilities(model: Model, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each token after those before it, and the training count of its word."""
    words = tokens[at]
    seen, raw = _look_up(model, "grams1", _place(words, model.shards), words, 2)
    p = np.full(len(at), 1 / (model.vocabulary + 1))
    if model.totals[1]:
        d = model.discounts(1)
        n1, n2, n3, n4, more = model.counts[1]
        left = (d[1] * n1 + d[2] * n2 + d[3] * (n3 + n4 + more)) / model.totals[1]
        p = (seen - d[np.minimum(seen, 3)]) / model.totals[1] + left * p
    contexts = _contexts(tokens, at, model.order - 1)
    for n in range(2, model.order + 1):
        context = contexts[n - 1]
        total, *some = _look_up(model, f"contexts{n}", _place(context, model.shards), context, 4)
        known = total > 0
        count = np.zeros(len(at), np.int64)
        count[known] = _look_up(model, f"grams{n}", _shards(context[known], words[known], model.hot, model.shards), _grams(context[known], words[known]), 1)[0]
        d = model.discounts(n)
        whole = np.maximum(total, 1)
        left = sum(d[k] * some[k - 1] for k in (1, 2, 3)) / whole
        p = np.where(known, (count - d[np.minimum(count, 3)]) / whole + left * p, p)
    return p, raw


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "lm") -> DataFrame:
    """``docs`` without its text, with ``n_tokens, n_known, base_score, score`` in a struct column ``name``.

    ``score`` is the model's log10 probability of the whole text, ``base_score`` that of single
    words with one added to each count.
    """
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    kind = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(text), TEXT_BYTES):
                tokens, at, first = _tokens(data, offsets, model.order)
                p, raw = _probabilities(model, tokens, at)
                base = np.log10((raw + 1) / (model.train_tokens + model.vocabulary + 1))
                sums = [np.add.reduceat(x, first) for x in (np.ones(len(at), np.int64), (raw > 0).astype(np.int64), base, np.log10(p))]
                lm = pa.StructArray.from_arrays([pa.array(s, f.type) for s, f in zip(sums, kind)], fields=list(kind))
                rows = batch.slice(lo, hi - lo).select(kept)
                yield pa.RecordBatch.from_arrays([*rows.columns, lm], names=[*kept, name])

    scored = T.StructType([T.StructField(f.name, T.LongType() if f.type == pa.int64() else T.DoubleType()) for f in kind])
    return docs.mapInArrow(run, T.StructType([*docs.select(kept).schema.fields, T.StructField(name, scored)]))

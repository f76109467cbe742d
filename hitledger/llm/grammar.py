"""Token ids in files compressed by a Re-Pair grammar, with random access.

Documents are encoded in ascending order of id, a range of ids per task, and written in shards of
some million ids. In each shard frequent pairs of neighbouring ids are replaced by new symbols
(nonterminals), again and again: a round takes the most frequent pairs and replaces their
occurrences, an occurrence giving way to an overlapping one of a more frequent pair. Pairs are counted
once; after that only what replacements took away and made is. Rounds end when no pair is left that
can be replaced eight times, or when all symbols of two bytes are used, since with a third byte for
every symbol files would grow. No pair reaches over the end of a document, so each document is a run
of symbols of its own.

A file holds, in this order, little-endian: ``RPAIR001``; six int64: documents, rules, symbols,
vocabulary, bytes per symbol, ids; document ids (int64) and whether each is known (uint8, padded to
8); first symbol of each document and the end (int64); first id of each document in the shard and
the end (int64); the rules' left and right symbols (uint32 each); ids that each rule expands to
(uint32); the symbols. Symbols under ``vocabulary`` are ids; ``vocabulary + r`` is rule ``r``. With
the expansion lengths any document, or any stretch of its ids, is decoded without the rest.

Nulls and odd input: a null or empty text is the end id alone; a null document id comes first and
stays null; documents that share an id are ordered by a hash of the text and each is written; no
documents give no files and no rows. Only the id and the text are read, so other columns can't
clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.shared import folder, in_order, read_file, stored, write_file
from hitledger.llm.token_ids import encoder
from hitledger.llm.words import text_slices

MAGIC = b"RPAIR001"
# Ids in a shard, at least; a document is never divided.
SHARD_IDS = 1 << 20
TASK_BYTES = 32 << 20
# Rules added in each round, and the least number of times a pair must be replaced.
RULES_A_ROUND, LEAST = 4096, 8
# Symbols of a shard, rules included, so that they fit in two bytes where the vocabulary does.
SYMBOLS = 1 << 16

_HASH = np.uint64(0x9E3779B97F4A7C15)


def _index(keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The place of each key in the sorted ``pairs``, or -1: by a hash table, and by search where two pairs share a slot."""
    slots = np.full(1 << 20, -1, np.int32)
    slots[(pairs * _HASH >> np.uint64(44)).astype(np.int32)] = np.arange(len(pairs), dtype=np.int32)
    out = slots[(keys * _HASH >> np.uint64(44)).astype(np.int32)]
    other = np.flatnonzero(out >= 0)
    other = other[pairs[out[other]] != keys[other]]
    at = np.minimum(np.searchsorted(pairs, keys[other]), len(pairs) - 1)
    out[other] = np.where(pairs[at] == keys[other], at, -1)
    return out


def _without_overlap(rank: np.ndarray, none: int) -> np.ndarray:
    """Places of occurrences, none next to another: those of lower rank than both neighbours, then what they leave, thrice.

    Of a run of equal ranks, as a pair of equal symbols makes, every second place counts.
    """
    free = np.concatenate((np.full(1, none, np.int32), rank, np.full(1, none, np.int32)))
    at, out = np.flatnonzero(free < none), []
    for _ in range(3):
        own, left, right = free[at], free[at - 1], free[at + 1]
        index = np.arange(len(at))
        odd = (index - np.maximum.accumulate(np.where(left == own, 0, index))) % 2 == 1
        best = at[(own <= left) & (own <= right) & ~odd]
        out.append(best - 1)
        for step in (-1, 0, 1):
            free[best + step] = none
        at = at[free[at] < none]
    return np.sort(np.concatenate(out))


class Pairs:
    """The pair that begins at each place, by number, and how often each occurs; number 0 is of no interest.

    Pairs that occur fewer than ``LEAST`` times are of none, for good: a pair gets new occurrences only in
    the round that makes one of its symbols.
    """

    def __init__(self, symbols: np.ndarray, last: np.ndarray):
        self.keys, self.counts = np.zeros(1, np.uint64), np.zeros(1, np.int64)
        self.at = np.zeros(max(len(symbols) - 1, 0), np.int32)
        self.number(symbols, last, np.arange(len(self.at)))

    def number(self, symbols: np.ndarray, last: np.ndarray, places: np.ndarray) -> None:
        """Number the pairs at ``places``, all of them new."""
        self.at[places] = 0
        places = places[~last[places]]
        keys = symbols[places].astype(np.uint64) << np.uint64(32) | symbols[places + 1]
        ranked = np.sort(keys)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1])))
        count = np.diff(np.append(first, len(ranked)))
        often = count >= LEAST
        pairs = ranked[first[often]]
        if len(pairs):
            found = _index(keys, pairs)
            known = found >= 0
            self.at[places[known]] = found[known] + np.int32(len(self.keys))
            self.keys, self.counts = np.concatenate((self.keys, pairs)), np.concatenate((self.counts, count[often]))

    def most_frequent(self, most: int) -> np.ndarray:
        # Pairs as frequent as each other come in a mixed order, so that a chain of them isn't worked off one by one.
        often = np.flatnonzero(self.counts >= LEAST)
        return often[np.lexsort((self.keys[often] * _HASH, -self.counts[often]))][:most]


def compress(ids: np.ndarray, bounds: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, each document's first symbol and the end, and rules as rows (left, right).

    ``bounds``: each document's first id and the end. Goes on until no pair is left that can be replaced
    ``LEAST`` times, or the symbols fill ``SYMBOLS``. Pairs are counted once; from then on only what
    replacements take away and make is counted.
    """
    symbols, last = ids.astype(np.uint32), np.zeros(len(ids), bool)
    last[bounds[1:] - 1] = True
    rules: list[np.ndarray] = []
    made = 0
    room = max(0, SYMBOLS - vocabulary) if vocabulary < SYMBOLS else 1 << 30
    pairs = Pairs(symbols, last)
    while len(best := pairs.most_frequent(min(RULES_A_ROUND, room - made))):
        none = len(best)
        rank_of = np.full(len(pairs.keys), none, np.int32)
        rank_of[best] = np.arange(none)
        rank = rank_of[pairs.at]
        chosen = _without_overlap(rank, none)
        used = np.bincount(rank[chosen], minlength=none)
        worth = used >= LEAST
        # Those that others overlap too often are left; without them the rest can be counted on.
        pairs.counts[best[~worth]] = 0
        chosen = chosen[worth[rank[chosen]]]
        if not len(chosen):
            continue
        left, right = (part[best[worth]] for part in (pairs.keys >> np.uint64(32), pairs.keys & np.uint64(0xFFFFFFFF)))
        rules.append(np.stack((left, right), axis=1).astype(np.uint32))
        gone = np.zeros(len(symbols), bool)
        gone[chosen] = gone[chosen + 1] = True
        gone[np.maximum(chosen - 1, 0)] = True
        pairs.counts -= np.bincount(pairs.at[gone[:-1]], minlength=len(pairs.counts))
        name = vocabulary + made + np.cumsum(worth) - 1
        symbols[chosen] = name[rank[chosen]]
        last[chosen] = last[chosen + 1]
        stay = np.ones(len(symbols), bool)
        stay[chosen + 1] = False
        symbols, last = symbols[stay], last[stay]
        pairs.at = np.append(pairs.at, 0)[stay][:-1]
        place = chosen - np.arange(len(chosen))
        beside = np.zeros(len(symbols), bool)
        beside[place] = True
        beside[place[place > 0] - 1] = True
        pairs.number(symbols, last, np.flatnonzero(beside[:-1]))
        made += int(worth.sum())
    return symbols, np.concatenate(([0], np.flatnonzero(last) + 1)), np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansion_lengths(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """Ids that each rule stands for; a rule's symbols come before it."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - vocabulary] if a >= vocabulary else 1) + (out[b - vocabulary] if b >= vocabulary else 1))
    return np.array(out, np.uint32)


def _padded(x: np.ndarray) -> bytes:
    raw = x.tobytes()
    return raw + bytes(-len(raw) % 8)


def pack_shard(doc_ids: list[int | None], ids: np.ndarray, bounds: np.ndarray, vocabulary: int) -> list[bytes]:
    """A file's parts."""
    symbols, first, rules = compress(ids, bounds, vocabulary)
    width = 2 if vocabulary + len(rules) <= 1 << 16 else 4
    head = np.array([len(doc_ids), len(rules), len(symbols), vocabulary, width, len(ids)], np.int64)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], np.int64)
    lengths = expansion_lengths(rules, vocabulary)
    arrays = (head, names, known, first.astype(np.int64), bounds.astype(np.int64), np.ascontiguousarray(rules.T), lengths, symbols.astype(f"<u{width}"))
    return [MAGIC, *(_padded(x) for x in arrays)]


class Shard:
    """A file's documents, decoded when asked for."""

    def __init__(self, raw: pa.Buffer | bytes) -> None:
        view = memoryview(raw)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a shard of token ids")
        at = 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(view, kind, n, at)
            at += out.nbytes + -out.nbytes % 8
            return out

        docs, rules, symbols, self.vocabulary, width, _ = take("<i8", 6).tolist()
        names, known = take("<i8", docs), take("u1", docs)
        self.doc_ids = [d if k else None for d, k in zip(names.tolist(), known.tolist())]
        self.first, self.starts = take("<i8", docs + 1), take("<i8", docs + 1)
        self.rules = take("<u4", 2 * rules).reshape(2, rules).T
        self.lengths = take("<u4", rules).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols)
        self._expand()

    def _expand(self) -> None:
        """All rules' ids end to end, each from those before it."""
        v = self.vocabulary
        out: list[bytes] = []
        for a, b in self.rules.tolist():
            out.append(b"".join(out[s - v] if s >= v else s.to_bytes(4, "little") for s in (a, b)))
        self.flat = np.frombuffer(b"".join(out), "<u4")
        self.begin = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]

    def _size(self, symbols: np.ndarray) -> np.ndarray:
        size = np.ones(len(symbols), np.int64)
        rule = np.flatnonzero(symbols >= self.vocabulary)
        size[rule] = self.lengths[symbols[rule].astype(np.int64) - self.vocabulary]
        return size

    def decode(self, lo: int, hi: int) -> np.ndarray:
        """The ids of documents ``lo`` to ``hi``, end to end."""
        return self._ids(self.symbols[self.first[lo] : self.first[hi]])

    def _ids(self, symbols: np.ndarray) -> np.ndarray:
        size = self._size(symbols)
        ends = np.cumsum(size)
        out = np.repeat(symbols.astype(np.uint32), size)
        rule = np.repeat(symbols >= self.vocabulary, size)
        place = np.arange(len(out)) - np.repeat(ends - size, size)
        base = self.begin[out[rule].astype(np.int64) - self.vocabulary]
        out[rule] = self.flat[base + place[rule]]
        return out

    def stretch(self, doc: int, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of a document: only symbols that reach into the stretch are expanded."""
        symbols = self.symbols[self.first[doc] : self.first[doc + 1]]
        ends = np.cumsum(self._size(symbols))
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return self._ids(symbols[a:b])[max(0, start - before) : max(0, end - before)]


_FILES = "part int, place int, path string, docs long, ids long, bytes long"


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write all documents; a row per file: its task's range, place in it, path, documents, ids and bytes."""
    path = path or folder(docs.sparkSession, "token-ids")
    rows = in_order(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", TASK_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        library = encoder(tokenizer)
        vocabulary = max(library.tokenizer.get_vocab_size(), end_id + 1)
        names: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        ids_held = 0

        def shard() -> pa.RecordBatch:
            bounds = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            file = f"{path}/part-{part:06d}-{place:06d}.rpair"
            written = write_file(file, pack_shard(names, np.concatenate(held), bounds, vocabulary))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "place": pa.array([place], pa.int32()), "path": [file], "docs": [len(names)], "ids": [int(bounds[-1])], "bytes": [written]})

        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                ids, count = library.encode(data, offsets)
                names += batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                held.append(np.insert(ids, np.cumsum(count), end_id).astype(np.uint32))
                sizes.append(count + 1)
                ids_held += len(held[-1])
                if ids_held >= shard_ids:
                    yield shard()
                    place += 1
                    names, held, sizes, ids_held = [], [], [], 0
        if names:
            yield shard()

    return stored(rows.mapInArrow(run, _FILES), "token-files")


def read_shards(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, compressed_symbols`` of every document, from the files alone.

    A file's first id is counted from the files before it: ranges add up on the driver (one row per
    writing task, 10,000 at most), files within their range.
    """
    by_part = sorted(files.groupBy("part").agg(F.sum("ids").alias("ids")).collect())
    starts, total = [], 0
    for part, ids in by_part:
        starts.append((part, total))
        total += ids
    spark = files.sparkSession
    base = spark.createDataFrame(starts, "part int, base long")
    before = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.withColumn("before", before).join(base, "part").select("path", (F.col("base") + F.col("before")).alias("base"))
    placed = placed.repartition(max(1, min(10_000, files.count() // 4)), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                shard = Shard(read_file(path))
                n = len(shard.doc_ids)
                ids = shard.decode(0, n).astype("<u4")
                bounds = shard.starts.tolist()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "start": pa.array(shard.starts[:-1] + at, pa.int64()),
                        "n_tokens": pa.array(np.diff(shard.starts), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                        "compressed_symbols": pa.array(np.diff(shard.first), pa.int64()),
                    }
                )

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, compressed_symbols long")

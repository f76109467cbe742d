"""Audit of how far the sources of each language diverge in their words.

1. *Index in one pass* (:func:`index_runs`): a task counts the terms of its texts per (lang, source)
   in memory, occurrences and documents. When a block is full (``BLOCK_TERMS`` entries or
   ``BLOCK_BYTES`` of text) it is spilled as a run: per group, the terms in order and their counts,
   packed into some fifteen bytes a term. At the task's end, or when its runs reach ``RUN_BYTES``,
   they are merged by a heap, and each group's terms go out in order, once.
2. *Merge* (:func:`frequencies`): what tasks send is dealt by a hash of group and term and summed in
   each hash shard, so that a common term's groups go to different shards and what meets is one row
   per merge.
3. Terms in at least ``least`` documents of their language are kept. A group, or a language, gives
   each kept term ``p = 1 + floor(10^9 (count + 1) / (N + V))``.
4. Divergence of group p from q over all kept terms is the sum of ``floor((p - q)^2 / q)``. Terms that
   neither group has all add the same, and a term that one has adds what its own p and the other's
   smallest p say. So a pair starts from V times the first, gets the second from the distinct p of
   each group, and only terms that *both* have need the pair: their corrections are streamed term by
   term from sorted postings (:func:`corrections`) into one sum per pair, emitted and started anew
   beyond ``PAIRS`` sums. No row is ever made for a pair and a term.

All arithmetic is on whole numbers; totals that may pass 64 bits on the way are decimals. The result
has a row for each ordered pair of sources of a language, which is what it is asked for.

Nulls and odd input: a null text, language or source counts as empty. A group without terms is still
a group. Repeated rows are documents of their own. Terms of one very long text are counted in pieces
cut between terms, and its distinct terms are held until its end, so that it counts as one document.
No rows give no rows. Only the three columns are read, so others can't clash.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator, Set
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.shared import prepare, stored

BLOCK_TERMS, BLOCK_BYTES = 400_000, 64 << 20
# Packed runs that a task holds, and rows that it sends at once.
RUN_BYTES, BATCH = 64 << 20, 50_000
# Bytes of text whose words are listed at once.
PIECE = 1 << 20
# Sums of pairs that a task holds.
PAIRS = 500_000

LEAST_DOCS, TOP_TERMS = 3, 200

# Letters as they are counted, everything else as a blank: A-Z fold to a-z, bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_RUN = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())])

Group = tuple[str, str]

# One document beside the occurrences, of which a block has fewer.
_DOCUMENT = 1 << 40


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    raw = raw.translate(_FOLD)
    at = 0
    while at < len(raw):
        to = len(raw) if len(raw) - at <= PIECE else raw.find(b" ", at + PIECE)
        to = len(raw) if to < 0 else to
        yield raw[at:to].split()
        at = to


class Block:
    """Postings of a part of the texts: per group and term, documents and occurrences in one number."""

    def __init__(self):
        self.groups: dict[Group, dict[bytes, int]] = {}
        self.entries = self.bytes = 0

    def full(self) -> bool:
        return self.entries >= BLOCK_TERMS or self.bytes >= BLOCK_BYTES

    def add(self, group: Group, terms: Counter, seen: Set[bytes] = frozenset()) -> None:
        """Terms of a text, of which it has shown ``seen`` before."""
        held = self.groups.setdefault(group, {})
        before, get = len(held), held.get
        if seen:
            for term, n in terms.items():
                held[term] = get(term, 0) + n + (0 if term in seen else _DOCUMENT)
        else:
            for term, n in terms.items():
                held[term] = get(term, 0) + n + _DOCUMENT
        self.entries += len(held) - before
        self.bytes += sum(map(len, terms))


class Runs:
    """Term-sorted runs of a task's blocks, packed."""

    def __init__(self):
        self.packed: dict[Group, list[tuple[bytes, bytes]]] = {}
        self.bytes = 0

    def spill(self, block: Block) -> None:
        for group, held in block.groups.items():
            terms = sorted(held)
            both = np.fromiter(map(held.__getitem__, terms), np.int64, len(terms))
            run = b" ".join(terms), np.stack([both % _DOCUMENT, both // _DOCUMENT]).tobytes()
            self.packed.setdefault(group, []).append(run)
            self.bytes += sum(map(len, run))

    def merged(self) -> Iterator[pa.RecordBatch]:
        """All runs as one row per group and term, each group's in order."""
        for (lang, source), runs in self.packed.items():
            entries = _summed(heapq.merge(*(_entries(*run) for run in runs))) if len(runs) > 1 else _entries(*runs[0])
            while rows := list(islice(entries, BATCH)):
                terms, counts, docs = zip(*rows)
                names = [pa.repeat(pa.scalar(name, pa.string()), len(rows)) for name in (lang, source)]
                yield pa.RecordBatch.from_arrays([*names, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts), pa.array(docs)], schema=_RUN)


def _entries(terms: bytes, counts: bytes) -> Iterator[tuple[bytes, int, int]]:
    numbers = np.frombuffer(counts, np.int64).reshape(2, -1).tolist()
    return zip(terms.split(b" "), *numbers)


def _summed(entries: Iterator[tuple[bytes, int, int]]) -> Iterator[tuple[bytes, int, int]]:
    term, count, docs = next(entries)
    for other, n, d in entries:
        if other == term:
            count += n
            docs += d
        else:
            yield term, count, docs
            term, count, docs = other, n, d
    yield term, count, docs


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, runs = Block(), Runs()
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in range(3))):
            group = lang.as_py(), source.as_py()
            # The empty term stands for the group itself.
            block.add(group, Counter({b"": 0}))
            seen: set[bytes] = set()
            raw = text.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            for terms in map(Counter, _pieces(raw)):
                block.add(group, terms, seen)
                if len(raw) > PIECE:
                    seen.update(terms)
                if block.full():
                    runs.spill(block)
                    block = Block()
                    if runs.bytes >= RUN_BYTES:
                        yield from runs.merged()
                        runs = Runs()
    runs.spill(block)
    yield from runs.merged()


def index_runs(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Merged runs of the texts' terms: ``lang, source, term, count, docs``, a task's terms of a group in order."""
    prepare(docs.sparkSession)
    texts = docs.select(*(F.coalesce(c, F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))
    return texts.mapInArrow(_index, "lang string, source string, term string, count long, docs long")


def frequencies(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, count, docs``: a row per group and term, and one with the empty term per group."""
    # Dealt before they are summed: a task has each group and term once, so summing there first would be in vain.
    runs = index_runs(docs, lang, source, text).repartition("lang", "source", "term")
    return runs.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """``1 + floor(10^9 (count + 1) / (total + terms))``, null over nothing."""
    return F.expr(
        f"1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(19,0))) div CAST(nullif({total} + {terms}, 0) AS DECIMAL(19,0))"
    )


def distance(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings (lang, source, term, p, p0) in order of lang and term, what shared terms change in each pair."""
    sums: dict[tuple[str, str, str], int] = {}

    def emitted() -> pa.RecordBatch:
        lang, source, item = zip(*sums) if sums else ((), (), ())
        out = pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(sums.values(), pa.int64())], names=["lang", "source", "item", "value"])
        sums.clear()
        return out

    def whole_terms(rows: pa.Table) -> None:
        def codes(*names: str) -> tuple[np.ndarray, list]:
            code, values = np.zeros(len(rows), np.int64), []
            for name in names:
                one = rows.column(name).combine_chunks().dictionary_encode()
                code = code * len(one.dictionary) + one.indices.to_numpy()
                values.append(one.dictionary.to_pylist())
            return code, values

        term, _ = codes("lang", "term")
        group, (langs, sources) = codes("lang", "source")
        p, p0 = (rows.column(c).to_numpy() for c in ("p", "p0"))
        at, apart = np.arange(len(rows)), 0
        while True:
            # Pairs of postings so many rows apart, as long as some term has them.
            apart += 1
            at = at[at + apart < len(rows)]
            at = at[term[at] == term[at + apart]]
            if not len(at):
                break
            for i, j in ((at, at + apart), (at + apart, at)):
                change = _distance(p[i], p[j]) - _distance(p[i], p0[j]) - _distance(p0[i], p[j]) + _distance(p0[i], p0[j])
                pair, inverse = np.unique(group[i] * (len(langs) * len(sources)) + group[j], return_inverse=True)
                total = np.zeros(len(pair), np.int64)
                np.add.at(total, inverse, change)
                for code, value in zip(pair.tolist(), total.tolist()):
                    a, b = divmod(code, len(langs) * len(sources))
                    key = langs[a // len(sources)], sources[a % len(sources)], sources[b % len(sources)]
                    sums[key] = sums.get(key, 0) + value

    held = None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        last = rows.slice(len(rows) - 1).to_pylist()[0]
        # The last term may go on in the next batch.
        cut = len(rows) - 1
        term, lang = rows.column("term"), rows.column("lang")
        while cut and term[cut - 1].as_py() == last["term"] and lang[cut - 1].as_py() == last["lang"]:
            cut -= 1
        if cut:
            whole_terms(rows.slice(0, cut))
        held = rows.slice(cut).combine_chunks()
        if len(sums) > PAIRS:
            yield emitted()
    if held is not None:
        whole_terms(held)
    yield emitted()


def _exact(column: Column | str) -> Column:
    return F.sum((F.col(column) if isinstance(column, str) else column).cast("decimal(38,0)"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: each source's divergence from the others (``pair``) and
    the terms, ``top`` at most, in which it stands out from its language (``term``)."""
    found = stored(frequencies(docs, lang, source, text), "frequencies")
    kept = found.where("term <> ''").groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("lang_docs"))
    kept = stored(kept.where(F.col("lang_docs") >= least).drop("lang_docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_n"))
    postings = stored(found.join(kept, ["lang", "term"]).drop("docs"), "postings")
    own = postings.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = found.where("term = ''").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(groups.fillna(0, ["n", "v", "lang_n"]).withColumn("p0", share("0", "n", "v")), "groups")

    rows = postings.join(groups, ["lang", "source"])
    rows = rows.select("lang", "source", "term", share("count", "n", "v").alias("p"), share("lang_count", "lang_n", "v").alias("q"), "p0")
    rows = stored(rows, "shares")
    terms = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(distance("p", "q")).alias("value"))
    terms = _ranked(terms, "term").where(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = groups.join(other, "lang").where("source <> item")
    start = pairs.select("lang", "source", "item", (F.col("v").cast("decimal(20,0)") * F.coalesce(F.expr(distance("p0", "q0")), F.lit(0)).cast("decimal(18,0)")).cast("decimal(38,0)").alias("value"))
    # How many terms of a group have each p: what those terms add as if the other group had none of them.
    levels = rows.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m")).join(other, "lang").where("source <> item")
    forth = f"m * ({distance('p', 'q0')} - {distance('p0', 'q0')})"
    back = f"m * ({distance('q0', 'p')} - {distance('q0', 'p0')})"
    both_ways = f"struct(source, item, CAST({forth} AS DECIMAL(38,0)) AS value), struct(item AS source, source AS item, CAST({back} AS DECIMAL(38,0)) AS value)"
    alone = levels.selectExpr("lang", f"inline(array({both_ways}))")
    sorted_rows = rows.select("lang", "source", "term", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    shared = sorted_rows.mapInArrow(corrections, "lang string, source string, item string, value long")
    shared = shared.withColumn("value", F.col("value").cast("decimal(38,0)"))
    total = start.unionAll(alone).unionAll(shared).groupBy("lang", "source", "item").agg(_exact("value").alias("value"))
    return _ranked(total, "pair").unionAll(terms)

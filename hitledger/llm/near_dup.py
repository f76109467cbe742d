"""Near-duplicates by banded MinHash with odd sketches.

A text's set is its distinct five-word shingles (its whole sequence, if shorter), as 64-bit hashes.

1. One pass over the texts keeps, per document, the size of its set, a 128-bit hash of the set, 32
   band keys of 5 MinHash values each, and an odd sketch: 256 MinHash values folded into 1,024 parity
   bits. The XOR of two sketches has as many bits set as their samples differ in, which estimates a
   high similarity closely.
2. Documents with equal sets are one class. Only classes take part from here on, so copies cost
   nothing, however many.
3. Classes that share a band key are candidates. First each is compared with the smallest of its
   bucket; candidates whose sketches allow the threshold are confirmed on full sets, and the links
   give components. Then only buckets that still hold more than one component matter; in them all
   classes of different components are compared by sketch, in blocks. Here an odd sketch of the whole
   set joins in: it never differs in more bits than the sets do in shingles, so it rules pairs out for
   certain. Of the pairs left, those that would connect what earlier pairs connect already wait; if
   any of the others isn't confirmed, a second round compares all that are still apart.

Links at 0.85 share one of 32 bands with probability 1 - 7e-9, and the sketch is asked for 0.73 only,
five standard deviations below. All-pairs work is thus confined to buckets of unlike classes; a
large one is cut into blocks of bounded size, each pair of blocks a group of its own.

Nulls and odd input: a null or empty text, or one without words, has an empty set, no link, and is
its own class and component; a document with a null id gets its class's component, null if no copy
has an id; repeated rows are copies and each gets its row; rows that share an id but not a text
count as one document with several texts, linked by any of them; no rows give no rows. Only the id
and the text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.shared import fresh, prepare, stored
from hitledger.llm.words import find_words, hash_spans, joined, spread, text_slices, windows

SHINGLE = 5
BANDS, ROWS = 32, 5
SAMPLES, BITS = 256, 1024
# Bits of the odd sketch of a whole set.
PARITY = 4096
# A sketch's estimate may fall this far short of the threshold before a pair is given up.
SLACK = 0.12
# Classes in one block of a bucket.
BLOCK = 2048

_rng = np.random.default_rng(41)
_FACTOR = _rng.integers(1, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    words = find_words(data, offsets)
    hashes = hash_spans(data, words.starts, words.ends, fold=True)
    keys, at = windows(hashes, words.first, SHINGLE)
    bound = np.searchsorted(at, words.first)
    out = []
    for d in range(len(offsets) - 1):
        first, last = words.first[d], words.first[d + 1]
        if last - first >= SHINGLE:
            out.append(np.unique(keys[bound[d] : bound[d + 1]]))
        elif last > first:
            whole = np.full(1, 1 + last - first, np.uint64)
            for h in hashes[first:last]:
                whole = joined(whole, np.full(1, h, np.uint64))
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_hashes(sets: list[np.ndarray]) -> list[bytes]:
    """128 bits for each set."""
    return [np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(spread(s))], np.uint64).tobytes() for s in sets]


def _minima(shingles: np.ndarray) -> np.ndarray:
    """The least of each of the sample's hash functions over a set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    work = np.empty((min(len(x), 512), SAMPLES), np.uint32)
    for at in range(0, len(x), 512):
        part = np.multiply(x[at : at + 512, None], _FACTOR, out=work[: len(x) - at])
        part += _SHIFT
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _signatures(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches of rows of MinHash values."""
    wide = minima.astype(np.uint64)
    banded = wide[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), banded.shape[:2]).copy()
    for i in range(ROWS):
        keys = joined(keys, banded[:, :, i])
    bits = spread(wide * np.uint64(SAMPLES) + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(BITS)
    cells = (np.arange(len(wide))[:, None] * BITS + bits.astype(np.int64)).ravel()
    odd = (np.bincount(cells, minlength=len(wide) * BITS) & 1).astype(np.uint8).reshape(-1, BITS)
    return keys.view(np.int64), np.packbits(odd, axis=1)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """An odd sketch of a whole set: two such differ in no more bits than the sets do in shingles."""
    return np.packbits((np.bincount((shingles % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1).astype(np.uint8))


def similarity(differing: np.ndarray) -> np.ndarray:
    """The similarity estimated from the number of differing bits of two odd sketches."""
    part = np.minimum(differing, BITS // 2 - 1) / BITS
    return 1 + BITS / (4 * SAMPLES) * np.log1p(-2 * part)


def _most_differing(threshold: float) -> int:
    """The most differing bits with which a pair is still confirmed on full sets."""
    return int(np.flatnonzero(similarity(np.arange(BITS // 2)) >= threshold - SLACK).max(initial=0))


def sign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, set_hash (binary), bands (array), sketch (binary)`` of every document."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                sets = shingle_sets(data, offsets)
                keys, sketches = _signatures(np.stack([_minima(s) for s in sets]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(_set_hashes(sets), pa.binary()),
                        pa.ListArray.from_arrays(np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                        pa.array([x.tobytes() for x in sketches], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_hash", "bands", "sketch"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, set_hash binary, bands array<long>, sketch binary"
    )


def _full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``rep, set_hash, shingles, parity`` of the wanted ids only, from their whole texts, equal rows once."""
    rows = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text")).join(wanted, "rep", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                sets = shingle_sets(data, offsets)
                bound = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").slice(lo, hi - lo), pa.array(_set_hashes(sets), pa.binary()), pa.ListArray.from_arrays(bound.astype(np.int32), pa.array(flat)), pa.array([_parity(s).tobytes() for s in sets], pa.binary())],
                    names=["rep", "set_hash", "shingles", "parity"],
                )

    found = rows.mapInArrow(run, "rep long, set_hash binary, shingles array<long>, parity binary")
    return found.repartition("rep").dropDuplicates(["rep", "set_hash"])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of at least ``threshold`` hundredths.

    Adaptive execution splits the rows of an id that is in many pairs.
    """
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a")
    return rows.where(100 * both >= threshold * (F.size("of_a") + F.size("of_b") - both)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable over edges (a, b), of every node with an edge.

    Alternating large-star and small-star steps; each round's edges are a table in the shared folder,
    and rounds end when all edges tie a node to its label (about the logarithm of the longest path).
    """
    now = stored(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), "edges")
    while not _are_stars(now):
        # Large star: every larger neighbour of a node is tied to the node's smallest neighbour or itself.
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        # Small star: a node's smaller neighbours, and itself, are tied to the smallest of them.
        large = large.where("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        now = stored(small.where("u < v").distinct(), "edges")
    return now.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node ``v`` has one edge and is no other node's ``u``."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.unionByName(edges.select(F.col("u").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    ends = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return ends.where("below > 1 OR below = 1 AND above = 1").isEmpty()


def _blocks(members: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Members of each bucket dealt to pairs of blocks: ``bucket, i, j, side``, every pair of members in one group at least."""
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = members.join(sizes, "bucket").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return rows.withColumn("other", other).select("*", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))


def _unlike(group: dict[str, np.ndarray], most: int, threshold: int, forest: bool) -> Iterator[np.ndarray]:
    """Pairs of a group (two blocks of a bucket at most) that have different labels and may be linked.

    ``forest``: a pair is left out if pairs before it connect its ends already.
    """
    reps, part, comp = group["rep"], group["part"], group["label"].copy()
    if len(reps) < 2 or comp.min() == comp.max():
        return
    split = part.min() != part.max()
    for k in range(len(reps) - 1):
        near = comp[k + 1 :] != comp[k]
        if split:
            near &= part[k + 1 :] != part[k]
        at = np.flatnonzero(near) + k + 1
        at = at[np.bitwise_count(group["sketch"][at] ^ group["sketch"][k]).sum(axis=1, dtype=np.int64) <= most]
        differ = np.bitwise_count(group["parity"][at] ^ group["parity"][k]).sum(axis=1, dtype=np.int64)
        both = group["n_shingles"][at] + group["n_shingles"][k]
        at = at[((100 + threshold) * differ <= (100 - threshold) * both) & (reps[at] != reps[k])]
        if forest and len(at):
            at = at[np.unique(comp[at], return_index=True)[1]]
            comp[np.isin(comp, comp[at])] = comp[k]
        yield np.stack((np.minimum(reps[at], reps[k]), np.maximum(reps[at], reps[k])))


_KEYS = ["bucket", "i", "j"]
_MEMBER = ["part", "rep", "label", "n_shingles", "sketch", "parity"]


def _unlike_pairs(members: DataFrame, most: int, threshold: int, forest: bool) -> DataFrame:
    """The pairs of all groups. Groups are read from sorted partitions, one after the other: most are tiny."""
    keys = _KEYS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            n = {c: rows.column(c).to_numpy() for c in (*keys, *_MEMBER[:4])}
            n |= {c: np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint64).reshape(rows.num_rows, -1) for c in _MEMBER[4:]}
            cut = np.flatnonzero(np.any([n[c][1:] != n[c][:-1] for c in keys], axis=0)) + 1
            bound = [0, *cut.tolist(), rows.num_rows]
            found = [p for lo, hi in zip(bound, bound[1:]) for p in _unlike({c: n[c][lo:hi] for c in _MEMBER}, most, threshold, forest)]
            a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.any([batch.column(c).to_numpy()[1:] != batch.column(c).to_numpy()[:-1] for c in keys], axis=0)
            last = int(np.flatnonzero(ends)[-1]) + 1 if ends.any() else 0
            fits = bool(held) and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in keys)
            if held and not fits:
                yield from groups(pa.Table.from_batches(held))
                held = []
            if last:
                yield from groups(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from groups(pa.Table.from_batches(held))

    rows = members.select(*keys, *_MEMBER).repartition(*keys).sortWithinPartitions(*keys, "rep")
    return rows.mapInArrow(run, "a long, b long").distinct()


def _mixed(members: DataFrame, labels: DataFrame, detail: DataFrame) -> DataFrame:
    """Members, in blocks, of the buckets that hold more than one component."""
    rows = members.select("bucket", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    same = F.sum(F.xxhash64("rep").cast("decimal(38,0)"))
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), same.alias("same")).where("low < high")
    # Buckets with the same members are one; in a bucket of two, the pair has been compared.
    mixed = mixed.where("n > 2").groupBy("n", "same").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    return _blocks(rows, mixed, BLOCK).join(detail, "rep")


def link_components(docs: DataFrame, threshold: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    ``threshold``: hundredths of similarity from which documents are linked, 80 or more.
    """
    signed = stored(sign(docs, doc_id, text), "signatures")
    most = _most_differing(threshold / 100)
    # A class is named by its smallest id; copies disappear in each task before the shuffle.
    classes = stored(
        signed.where("n_shingles > 0").groupBy("n_shingles", "set_hash").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "classes",
    )
    named = classes.where("rep IS NOT NULL")
    banded = named.select("rep", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("least")).where("n > 1")
    members = stored(banded.join(buckets, "bucket"), "buckets")

    sketches = named.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "sketch", "n_shingles")
    sketches = stored(sketches, "sketches")
    stars = members.where("least < rep").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    near = _near(stars, sketches, most, threshold)
    sets = stored(_full_sets(docs, members.select("rep").distinct(), doc_id, text), "sets")
    links = stored(_confirmed(near, sets, threshold), "links")
    labels = components(links)

    detail = sets.select("rep", "parity", F.size("shingles").cast("long").alias("n_shingles")).join(sketches.select("rep", "sketch"), "rep")
    for forest in (True, False):
        pairs = stored(_unlike_pairs(_mixed(members, labels, detail), most, threshold, forest), "unlike")
        more = stored(_confirmed(pairs, sets, threshold), "links")
        confirmed = more.count()
        if confirmed:
            links = links.unionByName(more)
            labels = components(links)
        if confirmed == pairs.count():
            break  # every tree stands, so no pair was left out in vain

    named = classes.select("n_shingles", "set_hash", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("n_shingles", "set_hash", F.coalesce("label", "rep").alias("component"))
    rows = signed.select("doc_id", "n_shingles", "set_hash").join(named, ["n_shingles", "set_hash"], "left")
    rows = rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _near(pairs: DataFrame, sketches: DataFrame, most: int, threshold: int) -> DataFrame:
    """The pairs whose sizes and sketches allow the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            keep = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= most
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
    right = sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
    rows = pairs.join(right, "b").join(left, "a").where(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    return rows.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def one_of_each(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """One document of each component, whole: that with the smallest id.

    Rows that share an id are one document and give one row. Documents without an id can't be named
    as copies but by an equal text, so one of each text stays, unless a document with an id has it.
    """
    named = docs.where("doc_id IS NOT NULL")
    kept = link_components(docs, threshold).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    out = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    nameless = docs.where("doc_id IS NULL")
    if nameless.isEmpty():
        return out
    key = fresh(docs, "text_hash")
    other = named.select(F.xxhash64("text").alias(key)).distinct()
    nameless = nameless.withColumn(key, F.xxhash64("text")).join(other, key, "left_anti").dropDuplicates([key]).select(docs.columns)
    return out.unionByName(nameless)

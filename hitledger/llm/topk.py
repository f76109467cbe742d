"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are dealt to blocks of some thousand by a hash of their id. A block is stored once as a
matrix with one list per dimension, its rows in descending order of that component. A query reads a
block's lists, each from the end at which its own component makes the product largest; every row met
is scored in full, once. The products at the lists' fronts add up to a bound on all rows not met yet;
the walk ends as soon as that bound is less than the kth score known, which rises as rows are met, or
when no row is left. All lists are read to the same depth, from a few rows on to twice as many in each
step; queries that are in the same step read a list and score the rows met together.

Queries come in packs; a pack meets every block, pair by pair, so that a task holds one block and one
pack. First each query walks one block, chosen by a hash of its id, which gives a score that k rows
reach already; with that floor the walks in all other blocks end early where their bound falls under
it. The best k of all blocks are the result.

Components are whole numbers, so scores and bounds are exact.

Nulls and odd input: vectors that are null or hold null, NaN or infinite components take no part, nor
do null ids; a shorter vector counts as filled up with zeros; rows that share an id count once, with
their least vector; ties go to the smaller id; fewer than k candidates give all; no rows give no
rows. Only the id and the vector are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.shared import prepare, stored

BLOCK_ROWS, PACK_ROWS = 8192, 512
FIRST_STEP = 4
# Rows times queries that walk in step.
WALK_CELLS = 1 << 20
NO_FLOOR = np.iinfo(np.int64).min

_FOUND = "query_id long, vec_id long, score long"


class Block:
    """A block's rows and, per dimension, the list of its rows in descending order of that component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lists: np.ndarray) -> None:
        self.ids, self.rows, self.lists = ids, rows.astype(np.int64), lists
        n = len(ids)
        # Depths to which a list is read step by step, and the components at its fronts there, from either end.
        self.depths = np.unique(np.minimum(FIRST_STEP << np.arange(40), max(n, 1)))
        across = np.arange(rows.shape[1])
        self.top = np.stack([self.rows[lists[:, min(t, n) - 1], across] for t in self.depths]) if n else None
        self.bottom = np.stack([self.rows[lists[:, n - min(t, n)], across] for t in self.depths]) if n else None
        # Rows scored in full, walks, and walks that the bound ended with rows not met, over all queries.
        self.scored, self.walks, self.bounded = 0, 0, 0

    def _numbers(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and queries as floating numbers, which have the fast routines, if all sums stay exact in them."""
        most = [float(np.abs(x).max(initial=0)) for x in (self.rows, queries)]
        largest = queries.shape[1] * most[0] * most[1]
        kind = np.float32 if largest < 2.0**23 else np.float64 if largest < 2.0**52 else np.int64
        return self.rows.astype(kind), queries.astype(kind)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the best ``k`` rows but its own.

        ``floors``: scores that ``k`` rows elsewhere reach, ``NO_FLOOR`` if not known; rows under them
        may be left out.
        """
        rows, wide = self._numbers(queries)
        some = max(1, WALK_CELLS // max(len(self.ids), 1))
        for lo in range(0, len(queries), some):
            yield from self._walk(rows, query_ids[lo : lo + some], wide[lo : lo + some], floors[lo : lo + some], k)

    def _walk(self, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``search`` for some queries, which read the lists in step until each one's bound ends its walk."""
        n, width = len(self.ids), queries.shape[1]
        of, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, rows.dtype)
        if n:
            self.walks += len(queries)
            floor, active, last = floors.astype(rows.dtype), np.arange(len(queries)), 0
            # What a row that isn't met by each depth can score at most.
            bounds = np.maximum(queries, 0) @ self.top.T.astype(rows.dtype) + np.minimum(queries, 0) @ self.bottom.T.astype(rows.dtype)
            # Readers of each list from either end. A query of zeros finds all rows equal; any list leads to them.
            down, up = (queries > 0).T, (queries < 0).T
            down[0] |= ~queries.any(axis=1)
            met = self.ids[:, None] == query_ids  # a query's own row is no candidate
            for step, depth in enumerate(self.depths.tolist()):
                known = met.copy()
                for i in range(width):
                    met[self.lists[i, last:depth]] |= down[i]
                    met[self.lists[i, n - depth : n - last]] |= up[i]
                new = met ^ known
                at = np.flatnonzero(new.any(axis=1))
                self.scored += np.count_nonzero(new)
                here = rows[at] @ queries[active].T
                row, who = np.nonzero(new[at] & (here >= floor[active]))
                of, ids, score = np.concatenate((of, active[who])), np.concatenate((ids, self.ids[at[row]])), np.concatenate((score, here[row, who]))
                # The kth score of each query is its new floor.
                order = np.lexsort((-score, of))
                of, ids, score = of[order], ids[order], score[order]
                kth = np.arange(len(of)) - np.searchsorted(of, of) == k - 1
                floor[of[kth]] = np.maximum(floor[of[kth]], score[kth])
                best = score >= floor[of]
                of, ids, score = of[best], ids[best], score[best]
                # A row not met that equals the kth may win the tie by its id, so the bound must be less.
                left = ~met.all(axis=0)
                on = left & (bounds[active, step] >= floor[active])
                self.bounded += np.count_nonzero(left & ~on)
                if not on.any():
                    break
                active, last = active[on], depth
                met, down, up = (np.compress(on, x, axis=1) for x in (met, down, up))
        order = np.lexsort((ids, -score, of))
        first = np.searchsorted(of[order], np.arange(len(queries) + 1))
        for i, own in enumerate(query_ids.tolist()):
            best = order[first[i] : min(first[i] + k, first[i + 1])]
            yield own, ids[best], score[best].astype(np.int64)


def _whole(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """``vec_id, v``: the ids with the floors of ``scale`` times their components, where all are finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = rows.where(F.col(vec_id).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    return good.select(F.col(vec_id).cast("long").alias("vec_id"), _whole(x, scale).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), width), np.int64)
    at = np.repeat(np.arange(len(rows)), size)
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)] = rows.flatten().to_numpy()
    return out


def _least(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    kinds = (np.int8, np.int16, np.int32)
    most = [int(x.min(initial=0)), int(x.max(initial=0))]
    return x.astype(next((k for k in kinds if np.iinfo(k).min <= most[0] and most[1] <= np.iinfo(k).max), np.int64))


def _array(raw: bytes, *shape: int) -> np.ndarray:
    """An array back from its bytes; its type follows from their number."""
    size = max(1, int(np.prod(shape)))
    return np.frombuffer(raw, f"i{max(1, len(raw) // size)}").reshape(shape)


def _packed(rows: DataFrame, key: str, width: int, lists: bool) -> DataFrame:
    """A row per group of at most some thousand vectors: ids, matrix and, for blocks, the lists."""

    def run(key_: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        ids, matrix = group.column("vec_id").to_numpy(), _matrix(group.column("v"), width)
        out = {key: [key_[0].as_py()], "ids": [ids.tobytes()], "matrix": [_least(matrix).tobytes()]}
        if lists:
            out["lists"] = [_least(np.ascontiguousarray(np.argsort(-matrix, axis=0, kind="stable").T)).tobytes()]
        else:
            out["floors"] = [group.column("floor").fill_null(int(NO_FLOOR)).to_numpy().tobytes()]
        return pa.table(out, schema=pa.schema([(key, pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary()), ("lists" if lists else "floors", pa.binary())]))

    return rows.groupBy(key).applyInArrow(run, f"{key} int, ids binary, matrix binary, {'lists' if lists else 'floors'} binary")


def _walk(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """Rows found for each pair of a pack and a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                ids, query_ids = (np.frombuffer(pair[c], np.int64) for c in ("ids", "query_ids"))
                block = Block(ids, _array(pair["matrix"], len(ids), width), _array(pair["lists"], width, len(ids)))
                queries = _array(pair["queries"], len(query_ids), width).astype(np.int64)
                found = list(block.search(query_ids, queries, np.frombuffer(pair["floors"], np.int64), k))
                rows = [np.concatenate(x) for x in zip(*((np.full(len(f), q), f, score) for q, f, score in found))] or [np.zeros(0, np.int64)] * 3
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["query_id", "vec_id", "score"])

    return pairs.select("ids", "matrix", "lists", "query_ids", "queries", "floors").mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` vectors with the largest inner product with each query."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(whole_vectors(vectors, vec_id, vector, scale), "vectors")
    asked = stored(whole_vectors(queries, vec_id, vector, scale), "queries")
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    asked_count, asked_width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width, blocks, packs = max(width, asked_width, 1), max(1, -(-count // BLOCK_ROWS)), max(1, -(-asked_count // PACK_ROWS))
    place = F.xxhash64("vec_id")
    block = stored(_packed(rows.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int")), "block", width, lists=True), "blocks")

    def pairs(asked: DataFrame, key: str) -> DataFrame:
        pack = _packed(asked, key, width, lists=False)
        return pack.select(key, F.col("ids").alias("query_ids"), F.col("matrix").alias("queries"), "floors")

    # One block for each query gives a floor: k rows that score so much are known.
    home = asked.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int")).withColumn("floor", F.lit(None).cast("long"))
    first = stored(_walk(block.join(pairs(home, "block"), "block"), width, k), "first-found")
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k)
    rest = asked.join(floors.select(F.col("query_id").alias("vec_id"), "floor"), "vec_id", "left")
    rest = rest.withColumn("pack", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(packs)).cast("int"))
    everywhere = pairs(rest, "pack").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    paired = everywhere.repartition(max(1, min(blocks * packs, 100_000)), "pack", "block").join(block, "block")
    return _best(_walk(paired, width, k), k).select("query_id", "rank", "vec_id", "score")

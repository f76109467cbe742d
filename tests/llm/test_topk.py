"""The search against all products."""

import math
import random

import numpy as np
import pytest

from hitledger.llm import topk


def plain(rows, queries, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(64 * x) for x in v]
            good[i] = min(good.get(i, w), w)
    out = []
    for q in sorted(i for i in good if i in queries):
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def rows_of(seed, n, width, spread):
    draw = random.Random(seed)
    rows = [(i, [draw.choice((draw.gauss(0, spread), 0.0)) for _ in range(width)]) for i in range(n)]
    rows += [(n + 1, None), (n + 2, [None] * width), (n + 3, [float("nan")] * width), (n + 4, [math.inf] * width), (None, [1.0] * width), (n + 5, []), (n + 6, [0.5]), (0, rows[0][1]), (3, [9.0] * width)]
    rows += [(n + 10 + i, rows[7][1]) for i in range(40)]  # ties
    return rows


@pytest.mark.parametrize("n, width, spread, block", [(300, 6, 0.1, 50), (300, 6, 3.0, 8192), (15, 4, 0.02, 8192)])
def test_best_rows(spark, monkeypatch, n, width, spread, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "PACK_ROWS", 7)
    rows = rows_of(n + block, n, width, spread)
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, block string").repartition(3)
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20).collect()
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = plain(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 20)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, none).count() == 0


def test_walks_end_early():
    """Where few rows stand out, most of a block is never met."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-3, 4, (4000, 8))
    rows[:30] = 40
    block = topk.Block(np.arange(4000), rows, np.argsort(-rows, axis=0, kind="stable").T)
    ((_, ids, score),) = block.search(np.array([-1]), np.full((1, 8), 2), np.array([topk.NO_FLOOR]), 20)
    assert ids.tolist() == list(range(20)) and set(score.tolist()) == {640}
    assert block.scored < 500
    # With a floor that nothing here reaches, the first step shows it.
    ((_, ids, _),) = block.search(np.array([-1]), np.full((1, 8), -2), np.array([49]), 20)
    assert len(ids) == 0 and block.scored < 1000


def test_large_components_stay_exact():
    rows = np.array([[1 << 28, 3], [1 << 28, 4], [5, 1 << 28]])
    block = topk.Block(np.arange(3), rows, np.argsort(-rows, axis=0, kind="stable").T)
    ((_, ids, score),) = block.search(np.array([9]), np.array([[1 << 20, 1]]), np.array([topk.NO_FLOOR]), 2)
    assert ids.tolist() == [1, 0] and score.tolist() == [(1 << 48) + 4, (1 << 48) + 3]
    large = np.array([[3037000500, 1], [3037000499, 2]])
    block = topk.Block(np.arange(2), large, np.argsort(-large, axis=0, kind="stable").T)
    ((_, ids, score),) = block.search(np.array([9]), np.array([[3037000499, 0]]), np.array([topk.NO_FLOOR]), 2)
    assert score.tolist() == [3037000499 * 3037000500, 3037000499**2]


@pytest.mark.parametrize("n, width, kind", [(700, 5, "steep"), (700, 16, "even"), (40, 3, "few"), (500, 1, "ties")])
def test_walks_score_rows_once(n, width, kind):
    """Each walk finds the best rows, ties included, and scores no row twice, whatever the bound can show."""
    rng = np.random.default_rng(n + width)
    rows = {
        "steep": (rng.pareto(0.7, (n, width)) * 9).astype(np.int64).clip(0, 10**6),
        "even": rng.integers(-60, 60, (n, width)),
        "few": rng.integers(-1, 2, (n, width)),
        "ties": np.full((n, width), 5),
    }[kind]
    block = topk.Block(np.arange(n) * 3, rows, np.argsort(-rows, axis=0, kind="stable").T)
    queries = np.concatenate((rows[:30], -rows[:5], np.zeros((1, width), np.int64)))
    own = np.concatenate((np.arange(30) * 3, np.full(6, -1)))
    for floors in (np.full(36, topk.NO_FLOOR), np.array([sorted(rows @ q)[-25:][0] for q in queries])):
        before, walks = block.scored, block.walks
        for (q, ids, score), query, floor in zip(block.search(own, queries, floors, 20), queries, floors):
            want = sorted((-s, i) for s, i in zip((rows @ query).tolist(), (np.arange(n) * 3).tolist()) if i != q and s >= floor)[:20]
            assert list(zip((-score).tolist(), ids.tolist())) == want
        assert block.walks == walks + 36 and block.scored - before <= 36 * n
    if kind == "steep":
        assert block.bounded > 20 and block.scored < 72 * n / 2

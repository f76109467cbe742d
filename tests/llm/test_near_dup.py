"""Components against all pairs compared on full sets."""

import random

import numpy as np
import pytest

from hitledger.llm import near_dup


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(rows, threshold):
    """Smallest id reachable of each row; rows with one id are one document."""
    sets = [(d, shingles(t)) for d, t in rows]
    distinct = sorted({(d, s) for d, s in sets if d is not None and s}, key=lambda x: x[0])
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(distinct):
        for b, y in distinct[i + 1 :]:
            both = len(x & y)
            if 100 * both >= threshold * (len(x) + len(y) - both):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    by_set = {}
    for d, s in distinct:
        by_set.setdefault(s, d)
    return [(d, len(s), find(d) if d is not None else (find(by_set[s]) if s in by_set else None)) for d, s in sets]


def key(x):
    return [(v is not None, v or 0) for v in x]


@pytest.mark.parametrize("threshold", [80, 85])
def test_odd_rows(odd_docs, odd_rows, threshold):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.link_components(odd_docs, threshold).collect()]
    assert sorted(got, key=key) == sorted(plain([r[:2] for r in odd_rows], threshold), key=key)


def test_no_rows(no_docs):
    assert near_dup.link_components(no_docs).count() == 0
    assert near_dup.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("block", [2048, 16])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Copies with few and with many changes: chains of links, pairs on either side of the threshold, blocks of buckets."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    draw = random.Random(block)
    rows = []
    for group in range(4):
        base = [f"w{draw.randrange(3000)}" for _ in range(150 + 60 * group)]
        for i in range(60):
            words = list(base)
            for _ in range(draw.randrange(0, 5)):
                words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
            rows.append((1000 * group + i, " ".join(words)))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.link_components(docs, 85).collect()]
    assert sorted(got) == sorted(plain(rows, 85))


def test_one_of_each(odd_docs, odd_rows):
    out = near_dup.one_of_each(odd_docs, 80)
    assert out.columns == odd_docs.columns
    got = [r.doc_id for r in out.collect()]
    want = {c for d, _, c in plain([r[:2] for r in odd_rows], 80) if d is not None}
    assert sorted(d for d in got if d is not None) == sorted(want)
    # Without an id: one of the two texts; the null text is that of document 1.
    assert got.count(None) == 1


def test_estimates_and_bounds():
    rng = np.random.default_rng(3)
    for share in (0.95, 0.85, 0.75):
        both = rng.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
        sets = [np.unique(np.concatenate((both, rng.integers(0, 1 << 63, (1000 - len(both)) // 2, dtype=np.uint64)))) for _ in range(2)]
        union = len(np.union1d(*sets))
        true = (len(sets[0]) + len(sets[1]) - union) / union
        _, sketch = near_dup._signatures(np.stack([near_dup._minima(s) for s in sets]))
        differing = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
        assert abs(float(near_dup.similarity(np.array(differing))) - true) < 0.1
        parity = [near_dup._parity(s) for s in sets]
        assert np.bitwise_count(parity[0] ^ parity[1]).sum() <= len(np.setxor1d(*sets))


def test_long_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in near_dup.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert near_dup.components(edges.limit(0)).count() == 0

"""Targets against plain water-filling, draws against quotas, the mix against what is said to be taken."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitledger.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, most=3):
    """Each source's share of all words by weight, none above ``most`` times its size."""
    out = [Fraction(0)] * len(sizes)
    left, free = Fraction(sum(sizes)), set(range(len(sizes)))
    while free:
        whole = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / whole > most * sizes[i]}
        for i in over or free:
            out[i] = Fraction(most * sizes[i]) if over else left * weights[i] / whole
        if not over:
            break
        free -= over
        left -= sum(out[i] for i in over)
    return out


def sources_of(spark, sizes):
    rows = [(f"{i:06d}", n, hash((i, "x"))) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "source string, size long, hash long").withColumn("doc_id", F.col("hash"))


MANY = [random.Random(i).randrange(1, 10 ** random.Random(i).randrange(1, 8)) for i in range(500)]


@pytest.mark.parametrize("sizes, steps", [([0, 0, 7], 1024), ([1, 10**12, 3, 10**9, 0, 2], 1024), (MANY, 1024), ([3**i for i in range(9)], 2)])
def test_targets(spark, monkeypatch, sizes, steps):
    monkeypatch.setattr(mixing, "STEPS", steps)
    got = mixing.plan(sources_of(spark, sizes), shard_words=10**11).sources.orderBy("place").collect()
    want = targets(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert [r.source_size for r in got] == sizes and [r.place for r in got] == list(range(len(sizes)))
    assert [r.target for r in got] == pytest.approx([float(t) for t in want], rel=1e-12)
    assert [r.want for r in got] == [math.floor(t + Fraction(1, 2)) for t in want]


def test_many_sources(spark):
    """Sources pass neither through the driver nor through one task, and each meets its target."""
    n = 100_000
    sized = spark.range(n, numPartitions=4).select(F.col("id").alias("doc_id"), F.format_string("%06d", "id").alias("source"), (1 + F.col("id") % 50).alias("size"), F.xxhash64("id").alias("hash"))
    sized = sized.unionByName(sized.where("doc_id % 1000 = 0").withColumn("hash", F.xxhash64("hash")).withColumn("size", F.lit(40_000)))
    made = mixing.plan(sized, shard_words=50_000)
    dealt = mixing.sharded(made)
    words = sized.join(made.sources, "source").groupBy("place", F.pmod("hash", "blocks").alias("block")).agg(F.sum("size").alias("block_words"))
    taken = dealt.join(words, ["place", "block"]).groupBy("place").agg(F.sum(F.coalesce("words", "block_words")).alias("taken"))
    assert made.sources.join(taken, "place", "left").where("coalesce(taken, 0) <> want").count() == 0 and made.sources.count() == n
    sizes = [1 + i % 50 + (40_000 if i % 1000 == 0 else 0) for i in range(n)]
    some = {r.place: r.target for r in made.sources.where("place < 3000").collect()}
    want = targets(sizes, [1 + i % 3 for i in range(n)])
    assert [some[i] for i in range(3000)] == pytest.approx([float(t) for t in want[:3000]], rel=1e-12)
    # No draw is lost or doubled, and shards hold equal shares.
    assert dealt.count() == made.draws.count() == dealt.select("place", "block", "pass").distinct().count()
    shares = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert len(shares) == made.shards and max(shares) - min(shares) <= 2 * math.log2(made.shards) + 2


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
@pytest.mark.parametrize("width", [1, 3])
def test_splits_add_up(shards, width):
    quotas = np.array([0, 1, 50, 1000])
    nodes = list(mixing.split_quotas(np.arange(4), quotas, 0, shards, np.random.default_rng(1), width))
    assert [x for lo, hi, _, _ in nodes for x in range(lo, hi)] == list(range(shards)) and all(hi - lo <= width for lo, hi, _, _ in nodes)
    parts = np.zeros((len(nodes), 4), np.int64)
    for row, (_, _, which, taken) in zip(parts, nodes):
        row[which] = taken
    assert parts.sum(axis=0).tolist() == quotas.tolist()
    each = [row.sum() / (hi - lo) for row, (lo, hi, _, _) in zip(parts, nodes)]
    assert max(each) - min(each) <= shards


def plain_targets(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    goal = targets([sizes[n] for n in names], [1 + i % 3 for i in range(len(names))])
    return sizes, dict(zip(names, goal))


@pytest.mark.parametrize("blocks, stack", [(50_000, 5), (20, 4096)])
def test_taken(odd_docs, odd_rows, blocks, stack, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", blocks)
    monkeypatch.setattr(mixing, "STACK", stack)
    rows = mixing.taken_words(odd_docs).collect()
    sizes, goal = plain_targets(odd_rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size) for r in rows) == sorted((x[0] is not None, x[0] or 0, len(WORD.findall(x[1] or ""))) for x in odd_rows)
    source = {x[0]: x[3] for x in odd_rows if x[0] is not None}
    taken = defaultdict(int)
    for r in rows:
        s = source.get(r.doc_id)
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(goal[s]))
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, t in goal.items():
        assert abs(taken[s] - t) <= 0.5
    assert sorted(map(str, rows)) == sorted(map(str, mixing.taken_words(odd_docs).collect()))


def test_mix(odd_docs, odd_rows):
    out = mixing.mix(odd_docs, shard_words=2000)
    assert out.columns == odd_docs.columns
    got = out.collect()
    words = Counter()
    for r in got:
        words[r.doc_id] += len(WORD.findall(r.text))
    want = Counter()
    for r in mixing.taken_words(odd_docs).collect():
        want[r.doc_id] += r.taken
    assert words == Counter({d: n for d, n in want.items() if n})
    whole = defaultdict(set)
    for x in odd_rows:
        whole[x[0]].add(x[1] or "")
    for r in got:
        assert any(r.text == t or " ".join(WORD.findall(t)).startswith(r.text) for t in whole[r.doc_id])


def test_taken_is_what_the_shards_hold(odd_docs, monkeypatch):
    """Words are counted in the shards that the tree dealt, so what one shard holds is missing without it."""
    whole = {str(r): r.taken for r in mixing.taken_words(odd_docs, shard_words=2000).collect()}
    dealt, held = mixing.sharded, []

    def without_one(made):
        rows = dealt(made)
        held.append(rows.groupBy("shard").count().count())
        return rows.where("shard <> 1")

    monkeypatch.setattr(mixing, "sharded", without_one)
    left = sum(r.taken for r in mixing.taken_words(odd_docs, shard_words=2000).collect())
    assert held and held[0] > 2 and 0 < left < sum(whole.values())


def test_no_rows(no_docs):
    assert mixing.taken_words(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0

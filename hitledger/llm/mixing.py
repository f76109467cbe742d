"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Sizes are counted in words; each source gets a target share of all words by its weight, cut to
   ``MOST_COPIES`` times its size, and what is cut goes to the others by weight, until none is above.
   The level that all uncut sources share is found by narrowing a range of whole numbers to one of
   ``STEPS`` parts at a time, from sums over the sources in each part.
2. A source's documents are dealt to blocks of about equal size by a hash. Its quota is as many whole
   passes over its blocks as fit its target, and for the rest blocks in a random order, the last of
   them cut within, at a word, to meet the target. Large sources order stacks of blocks first.
3. A tree splits the sources' quotas among the output shards: at each node the draws that go left are
   a multivariate-hypergeometric sample of what the node holds, so each shard is a fair sample without
   replacement and the leaves add up to the quotas exactly. Groups of sources go down the top of the
   tree together; then a task splits each group's part among its sources, and one each node's among
   its shards.
4. Each shard takes the next draws of each source's permuted blocks: disjoint intervals. Its documents
   are then shuffled locally by a hash.

Sources, blocks, draws and shards are rows of tables; through the driver pass sums, at most ``STEPS``
at a time, and the quotas of ``GROUPS`` groups at ``GROUPS`` nodes. All random choices follow from the
seed and the ids.

Nulls and odd input: a null text has size 0, a null source comes last in the order of weights; a
document of size 0 is never taken; a null id is dealt by its text; repeated rows are taken each for
itself; no rows or no words give targets of 0. Columns of the input are carried whole, and working
columns get names that don't clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.shared import prepare, stored
from hitledger.operators.ranking import rank_within

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
# Words in an output shard.
SHARD_WORDS = 4_000_000
# Blocks of a small corpus; in a large one a block has an eighth of a shard's words.
BLOCKS, BLOCK_WORDS = 50_000, SHARD_WORDS // 8
# Blocks that are put in order together.
STACK = 4096
# Parts of a range of levels, and groups of sources and nodes of the tree where tasks take over.
STEPS, GROUPS = 1024, 256
# Draws or sources, of some 30 bytes each, that may be broadcast.
SMALL = 500_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weighed(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source, place, source_size, weight, level`` of each source; it is cut if the common level is above its own."""
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = rank_within(found, [], [F.col("source").asc_nulls_last()], "place").withColumn("place", F.col("place") - 1)
    whole = math.lcm(*weights)
    kind = F.pmod("place", F.lit(len(weights))).cast("int") + 1
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), kind)
    level = F.col("source_size") * F.element_at(F.array(*(F.lit(most * whole // w).cast("long") for w in weights)), kind)
    return ranked.select("source", "place", "source_size", weight.alias("weight"), level.alias("level"))


def _common_level(sources: DataFrame, total: int, most: int, whole: int) -> tuple[int, int, int]:
    """Sources up to the first figure are cut; the others share the second by weight, of which the third is the sum."""
    low, cut = 0, 0
    high, weight = sources.where("level > 0").agg(F.coalesce(F.max("level"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    while high - low > 1:
        step = -(-(high - low) // STEPS)
        part = F.expr(f"(level - {low + 1}L) div {step}L").alias("part")
        parts = sources.where(F.col("level").between(low + 1, high)).groupBy(part).agg(F.sum(F.lit(most) * F.col("source_size")).alias("cut"), F.sum("weight").alias("weight")).collect()
        start = low
        for row in sorted(parts, key=lambda r: r.part):
            begin, end = start + row.part * step, min(start + (row.part + 1) * step, high)
            if whole * cut + begin * weight >= whole * total:  # the level lies before this part
                return low, total - cut, weight
            if whole * (cut + row.cut) + end * (weight - row.weight) >= whole * total:
                low, high = begin, end
                break
            low, cut, weight = end, cut + row.cut, weight - row.weight
    return low, total - cut, weight


def split_quotas(which: np.ndarray, quotas: np.ndarray, lo: int, hi: int, rng: np.random.Generator, width: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """From left to right the nodes of at most ``width`` shards from ``lo`` up to ``hi``, with what they hold of which sources."""
    which, quotas = which[quotas > 0], quotas[quotas > 0]
    if hi - lo <= width:
        yield lo, hi, which, quotas
        return
    half = (lo + hi) // 2
    left = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * (half - lo) // (hi - lo), method="marginals") if len(quotas) else quotas
    yield from split_quotas(which, left, lo, half, rng, width)
    yield from split_quotas(which, quotas - left, half, hi, rng, width)


@dataclass
class Plan:
    """``sources``: source, place, source_size, target, want, blocks. ``draws``: place, block, pass and
    the words taken of the block, null for all."""

    sources: DataFrame
    draws: DataFrame
    shards: int
    seed: int


def _few(some: DataFrame) -> DataFrame:
    """Rows of a stored table, sent to all tasks where they are known to be few: texts then needn't move to meet them."""
    return F.broadcast(some) if some.count() <= SMALL else some


def _blocked(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Sized documents with their source's figures and their block."""
    here = sources.withColumnRenamed("source", "_source")
    rows = sized.join(here, sized["source"].eqNullSafe(here["_source"])).drop("_source")
    return rows.withColumn("block", F.pmod("hash", "blocks"))


def _before(*order: str, seed: int) -> Column:
    """Words ahead of a row of ``order[-1]`` among those that share the other columns, in an order by hash."""
    window = Window.partitionBy(*order[:-1]).orderBy(F.xxhash64(*order, F.lit(seed)), order[-1])
    return F.coalesce(F.sum("words").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 17, shard_words: int = SHARD_WORDS) -> Plan:
    """``sized``: a stored table with source, size and hash."""
    prepare(sized.sparkSession)
    sources = stored(_weighed(sized, weights, MOST_COPIES), "mix-weights")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    low, shared, weight = _common_level(sources, total, MOST_COPIES, math.lcm(*weights))
    is_cut, most = F.col("level") <= low, F.lit(MOST_COPIES) * F.col("source_size")
    target = F.when(is_cut, most.cast("double")).otherwise((F.col("weight") * F.lit(shared)).cast("double") / F.lit(float(max(weight, 1))))
    want = F.when(is_cut, most).otherwise(F.expr(f"(2 * weight * {shared}L + {weight}L) div {2 * max(weight, 1)}L"))
    words = max(1, min(-(-total // BLOCKS), BLOCK_WORDS))
    blocks = F.greatest(F.lit(1), F.expr(f"(source_size + {words - 1}L) div {words}L"))
    sources = stored(sources.select("source", "place", "source_size", target.alias("target"), want.cast("long").alias("want"), blocks.cast("long").alias("blocks")), "mix-sources")

    figures = ["place", F.expr(f"block div {STACK}").alias("stack"), "block", F.expr("want div source_size").alias("passes"), F.expr("want % source_size").alias("rest")]
    sums = _blocked(sized.where("size > 0"), _few(sources)).groupBy(*figures).agg(F.sum("size").alias("words"))
    sums = stored(sums, "mix-blocks")
    stacks = sums.groupBy("place", "stack", "rest").agg(F.sum("words").alias("words"))
    stacks = stacks.select("place", "stack", (F.col("rest") - _before("place", "stack", seed=seed)).alias("room"))
    room = sums.join(stacks, ["place", "stack"]).withColumn("room", F.col("room") - _before("place", "stack", "block", seed=seed))
    times = F.col("passes") + F.when(F.col("room") > 0, 1).otherwise(0)
    draws = room.withColumn("times", times).where("times > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    part = F.when((F.col("pass") == F.col("passes")) & (F.col("room") < F.col("words")), F.col("room"))
    return Plan(sources, stored(draws.select("place", "block", "pass", part.alias("words")), "mix-draws"), max(1, -(-total // shard_words)), seed)


_TAKEN = "node int, place long, start long, quota long"
_LEAVES = "place long, start long, quota long, shard int"


def _by_source(nodes: np.ndarray, seed: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Splits what a group of sources has at each node among its sources."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        group, rows = key[0].as_py(), rows.sort_by("place")
        place, left = (rows.column(c).to_numpy().copy() for c in ("place", "quota"))
        rng, start, out = np.random.default_rng((seed, 1, group)), np.zeros(len(place), np.int64), []
        for node, count in enumerate(nodes[:, group].tolist()):
            at = np.flatnonzero(left)
            if count:
                taken = rng.multivariate_hypergeometric(left[at], count, method="marginals")
                at, taken = at[taken > 0], taken[taken > 0]
                out.append((np.full(len(at), node, np.int32), place[at], start[at], taken))
                start[at] += taken
                left[at] -= taken
        return pa.table(dict(zip(("node", "place", "start", "quota"), map(np.concatenate, zip(*out)))))

    return run


def _by_shard(spans: list[tuple[int, int]], seed: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Splits what the sources have at a node among its shards."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        node, rows = key[0].as_py(), rows.sort_by("place")
        place, start, quota = (rows.column(c).to_numpy().copy() for c in ("place", "start", "quota"))
        out = []
        for shard, _, at, taken in split_quotas(np.arange(len(place)), quota, *spans[node], np.random.default_rng((seed, 2, node))):
            out.append((place[at], start[at], taken, np.full(len(at), shard, np.int32)))
            start[at] += taken
        return pa.table(dict(zip(("place", "start", "quota", "shard"), map(np.concatenate, zip(*out)))))

    return run


def sharded(made: Plan) -> DataFrame:
    """The plan's draws, stored, with the shard of each."""
    group = F.pmod(F.xxhash64("place", F.lit(made.seed)), F.lit(GROUPS)).cast("int")
    quotas = stored(made.draws.groupBy("place").agg(F.count("*").alias("quota")).withColumn("group", group), "mix-quotas")
    whole = np.zeros(GROUPS, np.int64)
    for row in quotas.groupBy("group").agg(F.sum("quota").alias("quota")).collect():
        whole[row.group] = row.quota
    spans, nodes = [], []
    for lo, hi, which, taken in split_quotas(np.arange(GROUPS), whole, 0, made.shards, np.random.default_rng((made.seed, 0)), -(-made.shards // GROUPS)):
        spans.append((lo, hi))
        nodes.append(np.zeros(GROUPS, np.int64))
        nodes[-1][which] = taken
    taken = quotas.groupBy("group").applyInArrow(_by_source(np.array(nodes), made.seed), _TAKEN)
    leaves = taken.groupBy("node").applyInArrow(_by_shard(spans, made.seed), _LEAVES)
    # Draws come in the order of passes, permuted in each; a leaf has an interval of each source's.
    at = F.explode(F.sequence(F.col("start") + 1, F.col("start") + F.col("quota")))
    ranked = rank_within(made.draws, ["place"], [F.col("pass"), F.xxhash64("place", "block", "pass", F.lit(made.seed)), F.col("block")], "at")
    return stored(ranked.join(leaves.select("place", "shard", at.alias("at")), ["place", "at"]).drop("at"), "mix-shards")


def _cut(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Documents of blocks that are taken in part, with the words taken of each: in order of a hash, up to the block's share."""
    order = Window.partitionBy("place", "block").orderBy("hash", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(cuts, ["place", "block"])
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    return rows.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("words") - before)).cast("long")).drop("words")


def size_documents(docs: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, hash`` of every document."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count("text").alias("size"), F.xxhash64("doc_id", "text", F.lit(23)).alias("hash"), *more)


def _mixed(rows: DataFrame, made: Plan) -> DataFrame:
    """A row per copy of a document in the mix, with its ``shard`` and the words taken of it, ``part``: shard after shard, shuffled in each.

    ``rows``: sized documents with their source's figures and their block.
    """
    draws = _few(sharded(made))
    whole = rows.join(draws.where("words IS NULL").drop("words"), ["place", "block"]).withColumn("part", F.col("size"))
    copies = whole.unionByName(_cut(rows, draws.where("words IS NOT NULL")).select(whole.columns)).where("part > 0")
    return copies.repartition(made.shards, "shard").sortWithinPartitions("shard", F.xxhash64("hash", "pass", F.lit(made.seed)))


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; ``taken`` is counted in the shards' rows."""
    sized = stored(size_documents(docs, (F.monotonically_increasing_id().alias("row"),)), "sizes")
    made = plan(sized, weights, seed, shard_words)
    rows = _blocked(sized, _few(made.sources))
    mixed = stored(_mixed(rows, made).select("row", "shard", "part"), "mix-rows")
    taken = mixed.groupBy("row").agg(F.sum("part").alias("taken"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: shard after shard, shuffled in each.

    A document that is cut keeps its first words, joined by single spaces.
    """
    row = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    made = plan(stored(size_documents(docs), "sizes"), weights, seed, shard_words)
    mixed = _mixed(_blocked(size_documents(docs, (row,)), _few(made.sources)), made)
    words = F.regexp_extract_all(F.col("row.text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    short = F.when(F.col("part") < F.col("size"), F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")).otherwise(F.col("row.text"))
    return mixed.select(F.col("row").withField("text", short).alias("row")).select("row.*")

"""Sharding by sampled splitters, in DataFrame operations only.

Records are ordered by a 53-bit hash of their text, so that equal texts are neighbours, and cut into
shards of near equal bytes:

1. A sample in which a record stands with a chance in proportion to its size (chosen by a hash, so
   reruns agree) gives weighted quantiles: the splitters of some 64 fine ranges per shard. A key that
   fills several quantiles gets a range of its own.
2. Every record finds its range by binary search, and the ranges' bytes are counted exactly.
3. Overfull ranges are subdivided into cells: one with several keys by key, so that equal texts stay
   together, a single hot key by a hash of the record's place in the table of keys, so that equal
   records are parted as well.
4. A hot key of up to a shard's share stays whole: such keys are dealt to the shards from the largest
   down, there and back, and all their cells go along. The other cells, in order, fill what room the
   shards then have up to a common level. A key beyond a shard's share is parted like any other cells.
   A record's slot is its cell's offset in the shard plus its rank in the cell, so that no task sorts
   a whole shard.

Equal texts therefore meet in one shard unless they alone outgrow it, and that comes first: where many
groups of more than half a shard leave no equal shares, shards differ by up to such a group.

The splitters (at most 65,536 numbers) are all that passes through the driver. Sizes come within
about a cell, 1.5 % of a shard, of each other, unless single records are larger.

Nulls and odd input: a null text counts as empty, a null id is allowed; equal records have adjacent
slots; a shard may be empty if there are fewer cells; no records give no rows. Only the id and the
text are read, so other columns can't clash.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.shared import fresh, stored

# Bytes that a record takes beside its text.
OVERHEAD = 16
RANGES_A_SHARD, SAMPLES_A_RANGE = 64, 40
ROWS_A_RANGE, MOST_RANGES = 1_000_000, 1 << 16


def record_size(text: str | Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def text_key(text: str | Column) -> Column:
    """53 bits of a hash: exact as a double, which quantiles are."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), 11)


def _splitters(keys: DataFrame, ranges: int, total: int) -> list[int]:
    """Sorted lower bounds of all ranges but the first, by weighted quantiles of a sample."""
    if ranges < 2:
        return []
    unit = max(1.0, total / (ranges * SAMPLES_A_RANGE))
    chance = F.pmod(F.xxhash64("doc_id", "key", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = keys.where(chance < F.col("size") / unit).select("key", F.greatest(F.lit(1), F.round(F.col("size") / unit)).cast("long").alias("weight"))
    found = sample.agg(F.percentile("key", [i / ranges for i in range(1, ranges)], F.col("weight"))).first()[0] or []
    bounds = [math.ceil(x) for x in found]
    hot = {a for a, b in zip(bounds, bounds[1:]) if a == b}
    return sorted({*bounds, *(k + 1 for k in hot)})


def _range_of(key: Column, splitters: list[int]) -> Column:
    """The number of splitters that are at most the key, by binary search."""
    if not splitters:
        return F.lit(0)
    steps = range(len(splitters).bit_length() - 1, -1, -1)
    bounds = F.array(*(F.lit(s) for s in splitters))
    at = F.aggregate(
        F.array(*(F.lit(1 << s) for s in steps)),
        F.lit(0),
        lambda low, step: F.when((low + step <= len(splitters)) & (F.get(bounds, low + step - 1) <= key), low + step).otherwise(low),
    )
    return at


def _with_cell(rows: DataFrame, ranges: DataFrame, share: float) -> DataFrame:
    """``rows`` (with place, key, range) and the part of an overfull range that each is in."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("range_bytes") / F.lit(share))).cast("int")
    over = ranges.where(F.col("range_bytes") > 2 * share).select("range", parts.alias("parts"), "low", "high")
    rows = rows.join(over, "range", "left")
    by_key = F.least(F.floor((F.col("key") - F.col("low")) / (F.col("high") - F.col("low") + 1) * F.col("parts")), F.col("parts") - 1)
    by_place = F.pmod(F.xxhash64("place", F.lit(11)), F.col("parts"))
    part = F.when(F.col("parts").isNull(), 0).when(F.col("low") == F.col("high"), by_place).otherwise(by_key)
    return rows.withColumn("part", part.cast("int")).drop("parts", "low", "high")


def assign(keys: DataFrame, shards: int) -> DataFrame:
    """``keys`` (doc_id, size, key, place and more) with ``shard`` and ``slot``.

    ``keys`` is read several times; give a stored table, its places all different.
    """
    count, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(max(RANGES_A_SHARD * shards, -(-count // ROWS_A_RANGE)), MOST_RANGES)
    share = max(1.0, total / ranges)
    rows = keys.withColumn("range", _range_of(F.col("key"), _splitters(keys, ranges, total)))
    sums = rows.groupBy("range").agg(F.sum("size").alias("range_bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
    # The ranges' sums are read several times, and a few thousand rows.
    sums = stored(sums, "ranges")
    rows = _with_cell(rows, sums, share)
    cells = rows.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))

    whole = sums.where((F.col("low") == F.col("high")) & (F.col("range_bytes") > 2 * share) & (F.col("range_bytes") <= total / shards))
    turn = (F.row_number().over(Window.orderBy(F.desc("range_bytes"), "range")) - 1) % (2 * shards)
    whole = stored(whole.select("range", "range_bytes", F.least(turn, F.lit(2 * shards - 1) - turn).cast("int").alias("own")), "whole-keys")
    held = [0] * shards
    for row in whole.groupBy("own").agg(F.sum("range_bytes").alias("bytes")).collect():
        held[row.own] = row.bytes
    bounds = _filled(held, total - sum(held))
    cells = cells.join(whole.select("range", "own"), "range", "left")
    other = F.when(F.col("own").isNull(), F.col("bytes")).otherwise(0)
    running = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.sum(other).over(running) - F.floor(F.col("bytes") / 2)
    cells = cells.withColumn("middle", middle)
    cells = cells.withColumn("shard", F.coalesce("own", F.least(_range_of(F.col("middle"), bounds), F.lit(shards - 1))).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("range", "part", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))

    rank = F.row_number().over(Window.partitionBy("range", "part").orderBy("key", "doc_id", "place"))
    placed = rows.withColumn("rank", rank).join(stored(cells, "cells"), ["range", "part"])
    return placed.withColumn("slot", F.col("first") + F.col("rank") - 1).drop("range", "part", "rank", "first", "place")


def _filled(held: list[int], rest: int) -> list[int]:
    """Where, along ``rest`` bytes, each shard but the last is full, if all are filled from ``held`` to one level."""
    lowest, level = sorted(held), 0.0
    for n in range(1, len(lowest) + 1):
        level = (rest + sum(lowest[:n])) / n
        if n == len(lowest) or level <= lowest[n]:
            break
    ends = list(accumulate(max(0.0, level - h) for h in held))
    return [math.ceil(x) for x in ends[:-1]]


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every record."""
    text_column = F.coalesce(F.col(text), F.lit(""))
    keys = docs.select(F.col(doc_id).cast("long").alias("doc_id"), record_size(text).alias("size"), F.crc32(text_column).alias("text_crc32"), text_key(text).alias("key"), F.monotonically_increasing_id().alias("place"))
    return assign(stored(keys, "shard-keys"), shards).select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write all columns of ``docs`` under ``path``, a folder ``shard=N`` each, rows sorted by slot within files.

    Ids name the records here; records that share an id and a text get each slot once.
    """
    placed = assign(stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), record_size(text).alias("size"), text_key(text).alias("key"), F.monotonically_increasing_id().alias("place")), "shard-keys"), shards)
    same = Window.partitionBy("doc_id", "key").orderBy("slot")
    placed = placed.select("doc_id", "key", "shard", "slot", F.row_number().over(same).alias("copy"))
    names = {c: fresh(docs, c) for c in ("shard", "slot", "key", "copy")}
    rows = docs.withColumn(names["key"], text_key(text))
    rows = rows.withColumn(names["copy"], F.row_number().over(Window.partitionBy(doc_id, names["key"]).orderBy(F.lit(0))))
    here = placed.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("copy").alias("_copy"), F.col("shard").alias(names["shard"]), F.col("slot").alias(names["slot"]))
    same_record = rows[doc_id].cast("long").eqNullSafe(here["_id"]) & (rows[names["key"]] == here["_key"]) & (rows[names["copy"]] == here["_copy"])
    out = rows.join(here, same_record).drop("_id", "_key", "_copy", names["key"], names["copy"])
    spread = F.floor(F.col(names["slot"]) / F.lit(ROWS_A_RANGE))
    out.repartition(names["shard"], spread).sortWithinPartitions(names["shard"], names["slot"]).write.partitionBy(names["shard"]).parquet(path)

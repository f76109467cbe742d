"""Shards against their law: sizes near equal, slots without gaps, equal texts together."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from hitledger.llm import sharding


def size(text):
    return len((text or "").encode()) + 16


def check(rows, texts, shards):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((size(t), zlib.crc32((t or "").encode())) for t in texts)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_odd_rows(odd_docs, odd_rows):
    rows = sharding.shard_documents(odd_docs, 4).collect()
    check(rows, [r[1] for r in odd_rows], 4)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows)


def test_no_rows(no_docs):
    assert sharding.shard_documents(no_docs, 4).count() == 0


def test_sizes_are_near_equal_and_equal_texts_together(spark):
    rows = [(i, f"text {i} " * (1 + i * i % 90)) for i in range(20_000)] + [(100_000 + i, f"copy {i % 500}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).persist()
    got = sharding.shard_documents(docs, 8).collect()
    check(got, [t for _, t in rows], 8)
    total = defaultdict(int)
    shard_of = defaultdict(set)
    for r in got:
        total[r.shard] += r.size
        shard_of[r.text_crc32].add(r.shard)
    mean = sum(total.values()) / 8
    assert all(abs(t - mean) < 0.05 * mean for t in total.values())
    assert all(len(s) == 1 for s in shard_of.values())
    assert sorted(map(str, got)) == sorted(map(str, sharding.shard_documents(docs, 8).collect()))


def test_a_hot_text_is_subdivided(spark):
    rows = [(i, "the same text") for i in range(9000)] + [(10_000 + i, f"other {i}") for i in range(9000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 8).collect()
    check(got, [t for _, t in rows], 8)
    total = defaultdict(int)
    for r in got:
        total[r.shard] += r.size
    assert max(total.values()) < 1.1 * sum(total.values()) / 8
    assert len(total) == 8


def test_binary_search(spark):
    bounds = [3, 7, 8, 20, 21]
    rows = spark.range(0, 25).select("id", sharding._range_of(F.col("id"), bounds).alias("at")).collect()
    assert all(r["at"] == sum(b <= r["id"] for b in bounds) for r in rows)
    assert spark.range(3).select(sharding._range_of(F.col("id"), []).alias("at")).distinct().count() == 1


def test_written_shards(odd_docs, odd_rows, spark, tmp_path):
    docs = odd_docs.drop("shard")
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(odd_rows)
    assert sorted(str(r.text) for r in back.collect()) == sorted(str(r[1]) for r in odd_rows)
    check([r for r in back.select("size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "shard", "slot", sharding.record_size("text").alias("s")).withColumn("size", F.col("s")).collect()], [r[1] for r in odd_rows], 4)


def spread(rows, shards):
    total, where = defaultdict(int), defaultdict(set)
    for r in rows:
        total[r.shard] += r.size
        where[r.text_crc32].add(r.shard)
    return [total[s] for s in range(shards)], where


def test_groups_are_whole_up_to_a_shards_share(spark):
    """Copies that make up from a thirtieth to nearly all of a shard, beside many small texts."""
    rows = [(i, f"small text {i} " * 20) for i in range(6000)]
    for g in range(40):
        rows += [(10_000 + 100 * g + i, f"group {g} " * 300) for i in range(1 + 2 * (g % 20))]
    rows += [(90_000 + i, "a pair " * 6000) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard_documents(docs, 8).collect()
    check(got, [t for _, t in rows], 8)
    total, where = spread(got, 8)
    assert all(len(s) == 1 for s in where.values())
    assert max(total) < 1.05 * sum(total) / 8 and min(total) > 0.95 * sum(total) / 8


def test_equal_texts_without_ids_and_repeated_rows_are_parted(spark):
    for doc_id in (None, 7):
        rows = [(doc_id, "the same text") for _ in range(4000)] + [(i, f"other {i}") for i in range(4000)]
        got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 8).collect()
        check(got, [t for _, t in rows], 8)
        total, where = spread(got, 8)
        assert max(total) < 1.1 * sum(total) / 8 and min(total) > 0.9 * sum(total) / 8
        assert sum(len(s) > 1 for s in where.values()) == 1


def test_room_is_filled_to_one_level():
    assert sharding._filled([0, 0, 0, 0], 40) == [10, 20, 30]
    assert sharding._filled([12, 0, 0, 0], 28) == [0, 10, 19]
    assert sharding._filled([0, 100, 0], 20) == [10, 10]
    assert sharding._filled([5], 3) == [] and sharding._filled([0, 0], 0) == [0]

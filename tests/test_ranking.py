"""Ranks and top rows, with one group that holds most of the rows."""

from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hitledger.operators.ranking import rank_within, top_k
from hitledger.session import shared_folder


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 has two thirds of the rows, groups 1 to 49 share the rest, and one is null."""
    df = spark.range(30_000).select(
        F.expr("CASE WHEN id % 3 < 2 THEN 0 WHEN id % 50 = 7 THEN NULL ELSE id % 50 END").alias("g"),
        F.expr("id * 7919 % 101").alias("n"),
        F.expr("'p' || id").alias("p"),
    )
    return df


def order():
    return [F.desc("n"), F.asc("p")]


def windowed(df):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order())).cast("bigint"))


def rows(df):
    return sorted(df.collect(), key=repr)


def test_ranks_equal_the_window(skewed):
    assert rows(rank_within(skewed, ["g"], order())) == rows(windowed(skewed))


def test_no_task_gathers_the_large_group(spark, skewed):
    """The large group lies in several range partitions."""
    shared = Path(shared_folder(spark))
    before = set(shared.glob("ranked-*"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_within(skewed, ["g"], order())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    (written,) = set(shared.glob("ranked-*")) - before
    placed = spark.read.parquet(str(written / "rows")).filter("g = 0")
    assert placed.select(F.input_file_name()).distinct().count() > 1
    assert rows(ranked) == rows(windowed(skewed))


@pytest.mark.parametrize("k", [1, 20, 1500])
def test_top_k(skewed, k):
    assert rows(top_k(skewed, ["g"], order(), k)) == rows(windowed(skewed).filter(F.col("rn") <= k).drop("rn"))


def test_top_k_cuts_before_the_shuffle(skewed, plan_of):
    plan = plan_of(top_k(skewed, ["g"], order(), 20))
    assert plan.count("WindowGroupLimit") >= 2


def test_large_k_needs_no_window_over_the_group(skewed, plan_of):
    assert "row_number" not in plan_of(top_k(skewed, ["g"], order(), 1500))


def test_ranked_rows_are_not_shuffled_again(skewed, plan_of):
    plan = plan_of(rank_within(skewed, ["g"], order()))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_many_groups_are_joined_without_a_broadcast(spark, skewed, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        ranked = rank_within(skewed, ["g"], order())
        assert "SortMergeJoin" in plan_of(ranked)
        assert rows(ranked) == rows(windowed(skewed))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""Order within groups that may be larger than any one task should hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.session import scratch_path

# Up to this k Spark cuts each task's share of a group to k rows before the shuffle.
_CUT_EARLY = ("spark.sql.optimizer.windowGroupLimitThreshold", "1000")

# monotonically_increasing_id(): the partition's number above this bit, the row's place below.
_PLACE_BITS = 33


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 20) -> DataFrame:
    """The first ``k`` rows of each group.

    For a usual ``k`` the shuffle carries at most k rows per group and task. A ``k`` beyond Spark's
    limit for that (1,000) gives the same rows by :func:`rank_within`, since a window would gather a
    whole group in one task; its tables are then written when this is called.
    """
    if k > int(df.sparkSession.conf.get(*_CUT_EARLY)):
        return rank_within(df, group, order, "_rn").filter(F.col("_rn") <= k).drop("_rn")
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rn", place).filter(F.col("_rn") <= k).drop("_rn")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rn", path: str | None = None
) -> DataFrame:
    """Number the rows of each group from 1 in ``order``, which must have no ties.

    Equal to ``row_number()`` over a window, but a group is spread over as many tasks as its rows
    need: range partitions sorted by group and order are numbered in place, and each adds the rows
    its group has in earlier partitions. The placed rows are written, so both passes over them see
    the same partitions even if an executor is lost.

    The two tables are written when this is called, before any action on the result. They go under
    ``path``, which the caller removes when done with the result, or under a fresh path of the
    shared folder if none is named.
    """
    path = path or scratch_path(df.sparkSession, "ranked")
    keys = [*map(F.col, group), *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = _written(placed.withColumn("_at", F.monotonically_increasing_id()), f"{path}/rows")
    placed = placed.withColumn("_part", F.shiftright("_at", _PLACE_BITS))

    # At most one row per range partition and one more per group that starts inside a partition.
    parts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(name).alias(f"_{name}") for name in group],
        F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    # Written out, their real size is known when the join is planned: few enough, and Spark
    # broadcasts them and leaves the placed rows where they are; else it shuffles both.
    parts = _written(parts, f"{path}/parts")
    same = F.col("_part") == F.col("_of")
    for name in group:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    ranked = placed.join(parts, same)
    return ranked.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(rank))

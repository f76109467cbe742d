"""Records about a run and its batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.operators.counters import per_batch_counts, totals
from hitledger.operators.ranking import rank_within

QUERY_NAMES = {1: "Q1", 2: "Q2", 3: "Q3"}


def run_metadata(
    records: DataFrame,
    run_id: int,
    pipeline_name: str,
    batch_size: int,
    query_runtimes: Mapping[int, int],
    runtime_ms: int,
) -> DataFrame:
    """One row for a run, its counts taken from the records in one pass."""
    counts = totals(per_batch_counts(records))
    return describe_run(counts, run_id, pipeline_name, batch_size, query_runtimes, runtime_ms)


def describe_run(
    counts: DataFrame,
    run_id: int,
    pipeline_name: str,
    batch_size: int,
    query_runtimes: Mapping[int, int],
    runtime_ms: int,
) -> DataFrame:
    """Complete a row of ``total_batches``, ``total_records`` and ``malformed_count``."""
    average = F.coalesce(F.try_divide("total_records", "total_batches"), F.lit(0.0))
    return counts.select(
        F.lit(run_id).cast("int").alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(batch_size).cast("int").alias("batch_size"),
        F.col("total_batches").cast("int").alias("total_batches"),
        average.alias("avg_batch_size"),
        F.col("total_records").cast("bigint").alias("total_records"),
        F.col("malformed_count").cast("bigint").alias("malformed_count"),
        *[
            F.lit(query_runtimes.get(number, 0)).cast("bigint").alias(f"q{number}_runtime_ms")
            for number in QUERY_NAMES
        ],
        F.lit(runtime_ms).cast("bigint").alias("runtime_ms"),
    )


def runtime_slices(counts: DataFrame, runtimes: Mapping[str, int], path: str | None = None) -> DataFrame:
    """Share each query's run time among the batches by their record counts, to the millisecond.

    Shares are rounded down and what is left goes, one millisecond each, to the batches that lost
    the largest fractions (the earlier batch first among equals), so they add up to the run time.
    With no batches at all, batch 1 takes the whole time.

    Faulty dates can make any number of batches, so nothing gathers them: the totals, a number a
    query, are worked out first and enter as literals, and the largest fractions are found by
    :func:`hitledger.operators.ranking.rank_within`. This runs jobs when called; tables that the
    ranking needs are written under ``path``, or to the shared folder if none is named.
    """
    spark = counts.sparkSession
    whole = counts.agg(F.count("*").alias("batches"), F.sum("record_count").alias("records")).first()
    timed = [
        F.struct(F.lit(name).alias("query_name"), F.lit(ms).cast("bigint").alias("_runtime"))
        for name, ms in runtimes.items()
    ]
    if not whole["batches"] or not timed:
        nothing = [(name, 1, 0, ms) for name, ms in runtimes.items()]
        return spark.createDataFrame(nothing, "query_name string, batch_id int, record_count bigint, batch_runtime_ms bigint")
    rows = counts.select("batch_id", "record_count", F.inline(F.array(*timed)))
    runtime = F.col("_runtime").cast("double")
    exact = F.coalesce(F.try_divide(runtime * F.col("record_count"), F.lit(whole["records"])), F.lit(0.0))
    rows = rows.withColumn("_exact", exact).withColumn("_share", F.floor("_exact"))
    shared = {row["query_name"]: row["shared"] for row in rows.groupBy("query_name").agg(F.sum("_share").alias("shared")).collect()}
    left_over = F.lit(0)
    for name, ms in runtimes.items():
        left_over = F.when(F.col("query_name") == name, ms - shared[name]).otherwise(left_over)
    order = [F.desc("_loss"), F.asc("batch_id")]
    rows = rank_within(rows.withColumn("_loss", F.col("_exact") - F.col("_share")), ["query_name"], order, "_place", path)
    extra = F.when(F.col("_place") <= left_over, 1).otherwise(0)
    return rows.select("query_name", "batch_id", "record_count", (F.col("_share") + extra).alias("batch_runtime_ms"))


# In the order in which they can happen to a run.
EVENTS = ("started", "failed", "finished")


def run_history(events: DataFrame) -> DataFrame:
    """One row per run: the last that is known of it. A run that was killed stays ``started``.

    Events are only ever added. Of a run's events the one that comes last in :data:`EVENTS` counts, and
    of equal ones, as from a repeated write, the latest.
    """
    stage = F.array_position(F.array(*map(F.lit, EVENTS)), F.col("event"))
    rest = [c for c in events.columns if c != "run_id"]
    last = F.max_by(F.struct(*rest), F.struct(stage, F.col("executed_at")))
    return events.groupBy("run_id").agg(last.alias("_last")).select("run_id", *(F.col("_last")[c].alias(c) for c in rest))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("run_id")).limit(1)

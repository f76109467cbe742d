"""The three queries of the engine, over records from a parser, a stage or an audit table.

Byte counts are summed with ``try_sum``: lines may claim counts near the largest 64-bit number, and
a group whose sum does not fit gets a null total instead of ending the whole query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.operators.ranking import rank_within, top_k
from hitledger.operators.records import is_error, path_or_empty, valid

TOP = 20


def _most_requested_first():
    """Most requests first; equal counts in the order of their paths."""
    return [F.desc("request_count"), F.asc("resource_path")]


def daily_traffic(records: DataFrame) -> DataFrame:
    """Q1: requests and bytes per batch, day and status code."""
    return (
        valid(records)
        .groupBy("batch_id", "log_date", "status_code")
        .agg(F.count("*").alias("request_count"), F.try_sum("bytes_transferred").alias("total_bytes"))
    )


def resource_stats(records: DataFrame, by: tuple[str, ...] = ("batch_id", "resource_path")) -> DataFrame:
    """Requests, bytes and distinct hosts per path.

    Spark plans the exact distinct count in two shuffles, the first by path *and* host. A path with
    a third of all requests is therefore spread by its hosts, and what meets at the path is one
    partial row per task.
    """
    return (
        valid(records)
        .select("batch_id", path_or_empty(), "host", "bytes_transferred")
        .groupBy(*by)
        .agg(
            F.count("*").alias("request_count"),
            F.try_sum("bytes_transferred").alias("total_bytes"),
            F.count_distinct("host").alias("distinct_host_count"),
        )
    )


def host_sets(records: DataFrame) -> DataFrame:
    """Sizes of the host sets per path, taken as sets of (path, host) rows and never held whole."""
    pairs = valid(records).select(
        "batch_id", path_or_empty(), "host"
    )
    return pairs.distinct().groupBy("batch_id", "resource_path").agg(F.count("host").alias("distinct_host_count"))


def resource_ranks(records: DataFrame, path: str | None = None) -> DataFrame:
    """All paths of each batch, numbered from the most requested down.

    Writes the ranking's tables under ``path`` when called, see :func:`rank_within`.
    """
    return rank_within(resource_stats(records), ["batch_id"], _most_requested_first(), path=path)


def top_resources(records: DataFrame, k: int = TOP, scope: str = "batch") -> DataFrame:
    """Q2: the ``k`` most requested paths of each batch, or of all batches together."""
    if scope == "global":
        return resource_stats(records, by=("resource_path",)).orderBy(*_most_requested_first()).limit(k)
    if scope != "batch":
        raise ValueError(f"scope must be 'batch' or 'global', got {scope!r}")
    return top_k(resource_stats(records), ["batch_id"], _most_requested_first(), k)


def top_resources_array(records: DataFrame, k: int = TOP) -> DataFrame:
    """Q2 by way of one array per batch, sorted, cut to ``k`` and unnested.

    The rows that can enter an array are cut to ``k`` per batch first, so no array grows with the
    data.
    """
    fields = ["request_count", "resource_path", "total_bytes", "distinct_host_count"]
    # sort_array sorts upwards by the first field, so the count enters with its sign turned.
    row = F.struct((-F.col("request_count")).alias("order"), *fields[1:], "request_count")
    arrays = (
        top_resources(records, k)
        .groupBy("batch_id")
        .agg(F.slice(F.sort_array(F.collect_list(row)), 1, k).alias("rows"))
    )
    rows = arrays.select("batch_id", F.explode("rows").alias("row")).select("batch_id", "row.*")
    return rows.select("batch_id", "resource_path", "request_count", "total_bytes", "distinct_host_count")


def hourly_errors(records: DataFrame) -> DataFrame:
    """Q3: errors, their share and the distinct hosts that met one, per batch, day and hour."""
    failed = is_error(F.col("status_code"))
    counts = (
        valid(records)
        .select("batch_id", "log_date", "log_hour", failed.alias("failed"), F.when(failed, F.col("host")).alias("host"))
        .groupBy("batch_id", "log_date", "log_hour")
        .agg(
            F.count_if("failed").alias("error_request_count"),
            F.count("*").alias("total_request_count"),
            F.count_distinct("host").alias("distinct_error_hosts"),
        )
    )
    rate = F.coalesce(F.try_divide("error_request_count", "total_request_count"), F.lit(0.0))
    return counts.select(
        "batch_id",
        "log_date",
        "log_hour",
        "error_request_count",
        "total_request_count",
        F.round(rate, 6).alias("error_rate"),
        "distinct_error_hosts",
    )

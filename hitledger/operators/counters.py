"""Counts over whole loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.operators.records import valid


def counter_columns() -> list[Column]:
    bad = F.col("malformed")
    return [
        F.count("*").alias("total_lines"),
        F.count_if(~bad).alias("valid_records"),
        F.count_if(bad).alias("malformed_records"),
    ]


def etl_counters(records: DataFrame) -> DataFrame:
    """One row: lines read, valid and malformed."""
    return records.agg(*counter_columns())


def batch_catalog(records: DataFrame) -> DataFrame:
    """The batches that have valid records, in order."""
    return valid(records).select("batch_id").distinct().orderBy("batch_id")


def batch_record_counts(daily_traffic: DataFrame) -> DataFrame:
    """Valid records per batch, from the far fewer rows of the daily traffic."""
    counts = daily_traffic.groupBy("batch_id").agg(F.sum("request_count").alias("record_count"))
    return counts.orderBy("batch_id")


def valid_per_batch(records: DataFrame) -> DataFrame:
    """The same counts, from the records."""
    return valid(records).groupBy("batch_id").agg(F.count("*").alias("record_count")).orderBy("batch_id")


def per_batch_counts(records: DataFrame) -> DataFrame:
    """Valid and malformed lines of each batch; over a stage, of one narrow column."""
    bad = F.col("malformed")
    return records.groupBy("batch_id").agg(
        F.count_if(~bad).alias("record_count"), F.count_if(bad).alias("malformed_count")
    )


def totals(per_batch: DataFrame) -> DataFrame:
    """One row for the whole load: batches with valid records, valid and malformed lines."""
    return per_batch.agg(
        F.count_if(F.col("record_count") > 0).alias("total_batches"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("malformed_count"), F.lit(0)).alias("malformed_count"),
    )

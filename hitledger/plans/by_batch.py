"""Result tables by batch, kept up to date as loads come.

Each query's table has a folder per batch. :func:`refresh` asks the query only of the batches whose
loads changed since the table was last brought up to date, which the stage's log tells, and replaces
just their folders; batches that have no valid records any more lose theirs. How far a table has come
is a file beside it, written last, so that a refresh that was cut short is done again in full.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.operators.records import valid
from hitledger.plans.runs import QUERIES, select_queries
from hitledger.session import create_file, list_folder, remove
from hitledger.sources import loads
from hitledger.sources.stage import read_audit

_DONE = "_refreshed"


def _version(spark: SparkSession, root: str, table: str) -> int:
    return max((int(name) for name, _ in list_folder(spark, f"{root}/{_DONE}/{table}") or []), default=0)


def refresh(
    spark: SparkSession, stage: str, root: str, query: int | Collection[int] = 0, fmt: str = "parquet"
) -> dict[int, set[int] | None]:
    """Bring the tables of the queries at ``root`` up to date with the audit table at ``stage``.

    Returns the batches worked out anew for each query; None means all, as for a new table or where
    loads have no counts. A table is refreshed by one job at a time.
    """
    done = {}
    for number in select_queries(query):
        table, ask, *_ = QUERIES[number]
        before = _version(spark, root, table)
        now = loads.state(spark, stage, since=before)
        if now is None:
            raise ValueError(f"{stage} has no log of loads")
        touched = now.touched if before else None
        done[number] = touched
        if now.version == before:
            done[number] = set()
            continue
        if touched is None or touched:
            records = read_audit(spark, stage, fmt, batches=None if touched is None else sorted(touched))
            # A batch's result is small, its records are not: one file per batch, whatever tasks it was made by.
            rows = ask(records).repartition("batch_id")
            writer = rows.write.mode("overwrite").partitionBy("batch_id")
            writer.option("partitionOverwriteMode", "static" if touched is None else "dynamic").parquet(f"{root}/{table}")
        if touched:
            counts = now.counts()
            if counts is None:
                left = {row[0] for row in valid(records).select("batch_id").distinct().collect()}
            else:
                left = {batch for batch, (good, _) in counts.items() if good}
            for batch in sorted(touched - left):
                remove(spark, f"{root}/{table}/batch_id={batch}")
        create_file(spark, f"{root}/{_DONE}/{table}/{now.version:012}")
    return done


def table_schema(number: int) -> T.StructType:
    """As the table's files and folders have it: the batch last."""
    columns = QUERIES[number][3]
    return T.StructType([*(f for f in columns if f.name != "batch_id"), columns["batch_id"]])


def read_results(spark: SparkSession, root: str, number: int, batches: Collection[int] | None = None) -> DataFrame:
    """The table of a query; ``batches``, like any filter on ``batch_id``, limits the folders read."""
    table, _, _, columns = QUERIES[number]
    rows = spark.read.schema(table_schema(number)).parquet(f"{root}/{table}").select(*columns.fieldNames())
    return rows if batches is None else rows.filter(F.col("batch_id").isin(list(batches)))

"""The report on a run: its records, batches and query results, as tables to print or keep."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.text import shorten
from hitledger.operators.metadata import latest_run
from hitledger.sources.store import Store


def sink_date(log_date: str) -> Column:
    """A result's date text as a DATE.

    A day up to 31 that its month lacks runs on into the next month: 31 February 2024 is stored
    as 2 March. Days outside 1 to 31, which no calendar can place, become null, and so do years
    of other than four digits.
    """
    usual = rf"{log_date} RLIKE r'^[0-9]{{4}}-[0-9]{{2}}-(0[1-9]|[12][0-9]|3[01])\z'"
    first = f"make_date(int(substr({log_date}, 1, 4)), int(substr({log_date}, 6, 2)), 1)"
    return F.expr(f"CASE WHEN {usual} THEN date_add({first}, int(substr({log_date}, 9, 2)) - 1) END")


def to_store(result: DataFrame, run_id: int) -> DataFrame:
    """A query result as the store keeps it: run id first, real dates, load time last."""
    if "log_date" in result.columns:
        result = result.withColumn("log_date", sink_date("log_date"))
    return result.select(F.lit(run_id).cast("int").alias("run_id"), "*", F.current_timestamp().alias("loaded_at"))


def of_run(table: DataFrame, run_id: int) -> DataFrame:
    return table.filter(F.col("run_id") == run_id)


def run_summary(runs: DataFrame, run_id: int) -> DataFrame:
    return of_run(runs, run_id).withColumn("avg_batch_size", F.format_string("%.1f", "avg_batch_size"))


def batch_listing(batches: DataFrame, run_id: int) -> DataFrame:
    return of_run(batches, run_id).orderBy("query_name", "batch_id")


def traffic_listing(table: DataFrame, run_id: int) -> DataFrame:
    listed = of_run(table, run_id).orderBy("batch_id", "log_date", "status_code")
    return listed.withColumn("log_date", F.col("log_date").cast("string"))


def resource_listing(table: DataFrame, run_id: int) -> DataFrame:
    """Paths too long for the report's column end in three dots."""
    listed = of_run(table, run_id).orderBy("batch_id", F.desc("request_count"), "resource_path")
    return listed.withColumn("resource_path", F.expr(shorten("resource_path")))


def error_listing(table: DataFrame, run_id: int) -> DataFrame:
    """Rates have four decimals."""
    listed = of_run(table, run_id).orderBy("batch_id", "log_date", "log_hour")
    return listed.withColumn("log_date", F.col("log_date").cast("string")).withColumn(
        "error_rate", F.format_string("%.4f", "error_rate")
    )


def with_run(table: DataFrame, runs: DataFrame, run_id: int) -> DataFrame:
    """A run's result rows with the run's name and total records.

    The run's record is one row; it is read when this is called, and its values enter as literals:
    a join on a run's id would meet all rows on one key. A run without a record has no rows.
    """
    run = of_run(runs, run_id).select("pipeline_name", "total_records").first()
    rows = of_run(table, run_id) if run else table.limit(0)
    name, records = (run["pipeline_name"], run["total_records"]) if run else (None, None)
    return rows.withColumns(
        {"pipeline_name": F.lit(name).cast("string"), "total_records": F.lit(records).cast("bigint")}
    )


def row_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each result that the report counts below its listing."""
    counted = [
        tables[name].agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("listing"), "total_rows")
        for name in TOTALLED
    ]
    return reduce(DataFrame.unionByName, counted)


def printed(listing: DataFrame) -> Iterator[str]:
    """A listing as lines of text, the names first; every row, and one partition at a time on the driver."""
    yield " | ".join(listing.columns)
    for row in listing.toLocalIterator():
        yield " | ".join("" if value is None else str(value) for value in row)


def report(spark: SparkSession, store: Store, run_id: int | None = None) -> dict[str, DataFrame]:
    """All parts of the report on a run, the latest if none is named, in the order to show them."""
    runs = store.read(spark, "run_metadata")
    if run_id is None:
        latest = latest_run(runs).select("run_id").first()
        if latest is None:
            raise LookupError("the store holds no runs")
        run_id = latest["run_id"]
    tables = {name: store.read(spark, name, run_id) for name in LISTINGS}
    return {name: listing(tables[name], run_id) for name, listing in LISTINGS.items()}


TOTALLED = ("q1_daily_traffic", "q3_hourly_error")

LISTINGS = {
    "run_metadata": run_summary,
    "batch_metadata": batch_listing,
    "q1_daily_traffic": traffic_listing,
    "q2_top_resources": resource_listing,
    "q3_hourly_error": error_listing,
}

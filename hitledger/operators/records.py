"""Row-wise operators on lines and records. All keep to one stage: none of them shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions.text import empty_to_null
from hitledger.sources.stage import STAGE_COLUMNS

# The name under which requests without a path are counted, and the error codes.
NO_PATH = "(empty)"
FIRST_ERROR, LAST_ERROR = 400, 599

_TEXTS = ("host", "log_date", "http_method", "resource_path", "protocol_version")


def non_blank(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are more than spaces. A line of tabs passes: only spaces are trimmed here."""
    return lines.filter(F.trim(F.col(line)) != "")


def valid(records: DataFrame) -> DataFrame:
    return records.filter(~F.col("malformed"))


def malformed(records: DataFrame) -> DataFrame:
    return records.filter("malformed")


def path_or_empty(path: str = "resource_path") -> Column:
    return F.expr(f"coalesce({empty_to_null(path)}, '{NO_PATH}')").alias(path)


def normalize_path(records: DataFrame) -> DataFrame:
    return records.withColumn("resource_path", path_or_empty())


def is_error(status: Column) -> Column:
    return status.between(FIRST_ERROR, LAST_ERROR)


def flag_errors(records: DataFrame) -> DataFrame:
    return records.withColumn("is_error", is_error(F.col("status_code")))


def fill_missing(records: DataFrame) -> DataFrame:
    """Missing texts become empty and a malformed row goes to batch 0; what was read is kept."""
    bad = F.col("malformed")
    return records.withColumns(
        {name: F.coalesce(name, F.lit("")) for name in _TEXTS}
        | {"batch_id": F.when(bad, 0).otherwise(F.col("batch_id")), "malformed": bad.cast("int")}
    )


def blank_malformed(records: DataFrame) -> DataFrame:
    """Missing texts become empty and a malformed row keeps nothing but its flag."""
    bad = F.col("malformed")
    numbers = {"log_hour": "int", "status_code": "int", "bytes_transferred": "bigint", "batch_id": "int"}
    return records.withColumns(
        {name: F.when(bad, "").otherwise(F.coalesce(name, F.lit(""))) for name in _TEXTS}
        | {name: F.when(bad, F.lit(0).cast(kind)).otherwise(F.col(name)) for name, kind in numbers.items()}
        | {"malformed": bad.cast("int")}
    )


def staged(records: DataFrame) -> DataFrame:
    """What the stage holds: valid records with a date, missing texts empty."""
    rows = valid(records).filter(F.col("log_date").isNotNull() & (F.col("log_date") != ""))
    return rows.withColumns({name: F.coalesce(name, F.lit("")) for name in _TEXTS}).select(*STAGE_COLUMNS)

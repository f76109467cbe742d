"""Declared schemas. Nothing in this package infers a type from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RECORD = _struct(
    ("host", T.StringType()),
    ("timestamp", T.StringType()),
    ("log_date", T.StringType()),
    ("log_hour", T.IntegerType()),
    ("http_method", T.StringType()),
    ("resource_path", T.StringType()),
    ("protocol_version", T.StringType()),
    ("status_code", T.IntegerType()),
    ("bytes_transferred", T.LongType()),
    ("batch_id", T.IntegerType()),
    ("malformed", T.BooleanType()),
)

# What the three queries return. Dates stay text here: a line dated 31 February is valid.
DAILY_TRAFFIC = _struct(
    ("batch_id", T.IntegerType()),
    ("log_date", T.StringType()),
    ("status_code", T.IntegerType()),
    ("request_count", T.LongType()),
    ("total_bytes", T.LongType()),
)

TOP_RESOURCES = _struct(
    ("batch_id", T.IntegerType()),
    ("resource_path", T.StringType()),
    ("request_count", T.LongType()),
    ("total_bytes", T.LongType()),
    ("distinct_host_count", T.LongType()),
)

HOURLY_ERRORS = _struct(
    ("batch_id", T.IntegerType()),
    ("log_date", T.StringType()),
    ("log_hour", T.IntegerType()),
    ("error_request_count", T.LongType()),
    ("total_request_count", T.LongType()),
    ("error_rate", T.DoubleType()),
    ("distinct_error_hosts", T.LongType()),
)

# Lines of one batch, valid and malformed.
PER_BATCH = _struct(("batch_id", T.IntegerType()), ("record_count", T.LongType()), ("malformed_count", T.LongType()))

RUN_METADATA = _struct(
    ("run_id", T.IntegerType()),
    ("pipeline_name", T.StringType()),
    ("batch_size", T.IntegerType()),
    ("total_batches", T.IntegerType()),
    ("avg_batch_size", T.DoubleType()),
    ("total_records", T.LongType()),
    ("malformed_count", T.LongType()),
    ("q1_runtime_ms", T.LongType()),
    ("q2_runtime_ms", T.LongType()),
    ("q3_runtime_ms", T.LongType()),
    ("runtime_ms", T.LongType()),
    ("executed_at", T.TimestampType()),
)

# What happens to a run, each as a row of its own: started, then finished or failed.
RUN_EVENTS = T.StructType([*RUN_METADATA.fields, T.StructField("event", T.StringType(), True)])

BATCH_METADATA = _struct(
    ("run_id", T.IntegerType()),
    ("batch_id", T.IntegerType()),
    ("query_name", T.StringType()),
    ("record_count", T.LongType()),
    ("batch_runtime_ms", T.LongType()),
    ("loaded_at", T.TimestampType()),
)


def stored(result: T.StructType) -> T.StructType:
    """The store's form of a query result: run id first, real dates, load time last."""
    fields = [
        (f.name, T.DateType() if f.name == "log_date" else f.dataType) for f in result.fields
    ]
    return _struct(("run_id", T.IntegerType()), *fields, ("loaded_at", T.TimestampType()))


# Store tables, by name.
STORE = {
    "run_metadata": RUN_METADATA,
    "batch_metadata": BATCH_METADATA,
    "q1_daily_traffic": stored(DAILY_TRAFFIC),
    "q2_top_resources": stored(TOP_RESOURCES),
    "q3_hourly_error": stored(HOURLY_ERRORS),
}

# Column types a JDBC store creates where Spark's default would differ.
JDBC_TYPES = {
    "run_metadata": "pipeline_name VARCHAR(64)",
    "run_events": "pipeline_name VARCHAR(64), event VARCHAR(8)",
    "batch_metadata": "query_name VARCHAR(8)",
}

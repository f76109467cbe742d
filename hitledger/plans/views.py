"""The engine's inputs as SQL views and functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.batching import register_week_batch_id
from hitledger.functions.parser import parse
from hitledger.schemas import RECORD
from hitledger.operators.counters import batch_catalog
from hitledger.operators.records import fill_missing, valid
from hitledger.sources.lines import lines_view
from hitledger.sources.stage import STAGE_COLUMNS, read_audit


def register_views(
    spark: SparkSession,
    path: str | list[str],
    lines: str = "raw_logs",
    records: str = "parsed_logs",
    encoding: str = "UTF-8",
) -> DataFrame:
    """For SQL users: the view ``raw_logs(line)``, the view ``parsed_logs`` with its record columns,
    and the function ``week_batch_id(text)``. Returns the records."""
    raw = lines_view(spark, path, lines, encoding)
    register_week_batch_id(spark)
    parsed = parse(raw, line="line").withColumn("malformed", F.col("malformed").cast("int"))
    parsed.createOrReplaceTempView(records)
    return parsed


def register_stage(
    spark: SparkSession,
    path: str,
    records: str = "parsed_logs_stage",
    batches: str = "batch_ids",
    fmt: str = "parquet",
) -> DataFrame:
    """For SQL users: a loaded table's valid records, texts never null, and the list of its batches."""
    loaded = valid(read_audit(spark, path, fmt))
    batch_catalog(loaded).createOrReplaceTempView(batches)
    staged = fill_missing(loaded).select(*STAGE_COLUMNS)
    staged.createOrReplaceTempView(records)
    return staged


class _Nested:
    """Takes the parser's projections and nests them as SQL."""

    def __init__(self, text: str):
        self.text = text

    def selectExpr(self, *columns: str) -> _Nested:
        return _Nested(f"SELECT {', '.join(columns)} FROM ({self.text})")


def register_parse_log_line(spark: SparkSession, name: str = "parse_log_line") -> None:
    """For SQL users: the table function ``parse_log_line(line)``, one record for a line.

    Used as ``FROM lines, LATERAL parse_log_line(line) AS r``. It takes exactly one argument, as text;
    a null or blank line gives a malformed record. Spark plans it as a join of the lines with the
    records of the *different* lines, each parsed once. Whole tables are better asked through the view
    ``parsed_logs`` of :func:`register_views`, which needs no join.
    """
    body = parse(_Nested("SELECT line"), line="line").text
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RECORD)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(line STRING) RETURNS TABLE({columns}) RETURN {body}")

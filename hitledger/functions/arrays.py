"""Top rows of arrays, as a SQL function; native expressions only."""

from __future__ import annotations

from pyspark.sql import SparkSession

# How many rows are kept, how many fields a row has at least, and which is the count.
TOP, FIELDS, COUNT = 20, 4, 1

NAME = "top_rows"


def _count(row: str) -> str:
    """A row's count: whole numbers in ASCII digits; anything else, or one past 64 bits, counts 0."""
    field = f"get({row}, {COUNT})"
    return f"coalesce(CASE WHEN {field} RLIKE '^[+-]?[0-9]+$' THEN try_cast({field} AS BIGINT) END, 0)"


def top_rows(rows: str, k: int | str = TOP) -> str:
    """SQL of the ``k`` rows of an array of text arrays that have the largest counts.

    Rows that are null or have fewer than four fields are left out; rows with equal counts keep their
    order; a null array gives an empty one.
    """
    whole = f"filter({rows}, r -> r IS NOT NULL AND size(r) >= {FIELDS})"
    a, b = _count("a"), _count("b")
    ordered = f"array_sort({whole}, (a, b) -> CASE WHEN {a} > {b} THEN -1 WHEN {a} < {b} THEN 1 ELSE 0 END)"
    return f"coalesce(slice({ordered}, 1, {k}), array())"


def register_top_rows(spark: SparkSession, name: str = NAME) -> None:
    """For SQL users: the function ``top_rows(rows)`` or ``top_rows(rows, k)``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(rows ARRAY<ARRAY<STRING>>, k INT DEFAULT {TOP}) "
        f"RETURNS ARRAY<ARRAY<STRING>> RETURN {top_rows('rows', 'k')}"
    )

"""Query results as folders of tab-separated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions.text import BLANKS, whole_number


# How a null is written. A text of backslashes and an N gets one backslash more, so none looks like a null.
NULL = r"\N"


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Replace ``path`` by the rows of ``df``; doubles have six decimals, nulls are ``\\N``.

    A name in ``order`` that starts with ``-`` sorts downwards.
    """
    if order:
        df = df.orderBy(*[F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order])
    cells = [
        F.when(F.col(f.name).isNotNull(), F.format_string("%.6f", f.name)) if isinstance(f.dataType, T.DoubleType)
        else F.regexp_replace(f.name, r"^(\\+N)$", r"\\$1") if isinstance(f.dataType, T.StringType)
        else F.col(f.name).cast("string")
        for f in df.schema.fields
    ]
    line = F.concat_ws("\t", *[F.coalesce(cell, F.lit(NULL)) for cell in cells])
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def _value(cell: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        value = rf"regexp_replace({cell}, r'^\\(\\+N)$', '$1')"
    else:
        name = kind.simpleString()
        text = f"btrim({cell}, '{BLANKS}')"
        whole = isinstance(kind, (T.IntegerType, T.LongType))
        number = whole_number(text, name) if whole else f"try_cast({text} AS {name})"
        value = f"coalesce({number}, CAST(raise_error('not a {name}: ' || {text}) AS {name}))"
    return F.expr(f"CASE WHEN {cell} <> r'{NULL}' THEN {value} END")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read such a folder back. Blank and short lines are skipped; a faulty number fails the read."""
    # Trailing empty cells do not count, as in files of other writers.
    lines = spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t+\z", ""), "\t").alias("cells"))
    lines = lines.filter(F.size("cells") >= len(schema))
    return lines.select(
        *[_value(f"get(cells, {i})", f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )

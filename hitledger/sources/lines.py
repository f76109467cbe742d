"""Raw access-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.text import empty_to_null


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """One row ``value`` per line of a file, a flat folder or a list of these.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``. Compressed files are read as they are, but only
    uncompressed ones are split among tasks. The text source hands the bytes of a line over
    untouched, so another encoding is a matter of decoding them; faulty UTF-8 becomes U+FFFD.
    """
    raw = spark.read.text(path).select("value")
    if encoding.upper() in ("UTF-8", "UTF8"):
        return raw.select(F.make_valid_utf8("value").alias("value"))
    return raw.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))


def lines_view(spark: SparkSession, path: str | list[str], name: str, encoding: str = "UTF-8") -> DataFrame:
    """The same lines as a view ``name`` with one column ``line``; an empty line reads as null."""
    lines = read_lines(spark, path, encoding).selectExpr(f"{empty_to_null('value')} AS line")
    lines.createOrReplaceTempView(name)
    return lines

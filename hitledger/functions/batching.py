"""ISO-week batch ids, as SQL text like :mod:`hitledger.functions.text`."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A strict ISO date: four-digit years, longer ones only with a sign. Spark's own cast also takes
# '1995-7-1', which must not count. Year -0000 does not exist.
ISO_DATE = r"^(?!-0+-)([0-9]{4}|-[0-9]{4,10}|\+[0-9]{5,10})-[0-9]{2}-[0-9]{2}\z"

# The calendar repeats after 400 years, which are 20,871 whole weeks: a date of any year is looked up
# in the years 2000 to 2399, which Spark's DATE can hold, and the year put back.
_CYCLE, _FIRST = 400, 2000
_FARTHEST = 999_999_999


def _year_of(text: str) -> str:
    return f"try_cast(regexp_extract({text}, r'^[+-]?[0-9]+', 0) AS BIGINT)"


def _folded(year: str) -> str:
    return f"({_FIRST} + pmod({year}, {_CYCLE}))"


def strict_date(text: str) -> str:
    """The date of an ISO text, its year folded into the cycle."""
    strict = f"{text} RLIKE r'{ISO_DATE}' AND {_year_of(text)} BETWEEN -{_FARTHEST} AND {_FARTHEST}"
    return f"CASE WHEN {strict} THEN try_cast(concat({_folded(_year_of(text))}, substr({text}, -6)) AS DATE) END"


def iso_week(day: str, year: str) -> str:
    """``YYYYWW`` of the ISO week of a date folded into the cycle; 0 for null. Wraps as 32 bits do."""
    week = f"(extract(YEAROFWEEK FROM {day}) - {_folded(year)} + {year}) * 100L + weekofyear({day})"
    return f"int(coalesce(pmod({week} + 2147483648L, 4294967296L) - 2147483648L, 0L))"


def calendar_day(year: str, month: str, day: str) -> str:
    """The date of three numbers, its year folded into the cycle, or null where the calendar or the ISO text form has none.

    Agrees with ``strict_date`` on the text ``%04d-%02d-%02d`` without going through the text:
    a year over 9999 lacks the sign its text would need, and one from -999 to -1 lacks a digit.
    """
    written = f"{year} BETWEEN 0 AND 9999 OR {year} BETWEEN -{_FARTHEST} AND -1000"
    first = f"make_date(CASE WHEN {written} THEN {_folded(year)} END, {month}, 1)"
    return f"CASE WHEN {day} BETWEEN 1 AND day(last_day({first})) THEN date_add({first}, {day} - 1) END"


def week_batch_id(log_date: str) -> Column:
    """``YYYYWW`` of an ISO date text, e.g. 1995-07-01 is in batch 199526; 0 if it is no real date."""
    return F.expr(iso_week(f"({strict_date(log_date)})", _year_of(log_date)))


def register_week_batch_id(spark: SparkSession) -> None:
    """Make ``week_batch_id(text)`` callable from SQL, as an expression Catalyst can see into."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION week_batch_id(log_date STRING) RETURNS INT
        RETURN SELECT {iso_week("day", "year")} FROM (SELECT {strict_date("log_date")} AS day, {_year_of("log_date")} AS year)
        """
    )

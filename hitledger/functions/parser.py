"""Common Log Format lines to records, in native expressions only.

Shape of a line: ``host - - [dd/Mon/yyyy:HH:mm:ss -ZZZZ] "METHOD /path PROTOCOL" status bytes``.

1. Cut the line into host, timestamp, request and the rest.
2. Read the numbers, the parts of the date and the words of the request.
3. Derive the record. This projection is open to column pruning, so a query that needs three
   columns does not pay for the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from hitledger.functions.batching import calendar_day, iso_week
from hitledger.functions.text import is_blank, strip_blanks, whole_number, words
from hitledger.schemas import RECORD

# English month names, compared without regard to case.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# The status is the first word after the request, the byte count the second; both signed digits.
# Blanks at either end do not belong to a word.
_STATUS = r"^[\x00-\x20]*+([+-]?[0-9]++)(?:\s|[\x00-\x20]*+\z)"
_BYTES = r"^[\x00-\x20]*+\S++\s++([+-]?[0-9]++)(?:\s|[\x00-\x20]*+\z)"


def _select(df: DataFrame, keep: Iterable[str], columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*keep, *[f"{expression} AS {name}" for name, expression in columns.items()])


def barrier(df: DataFrame, keep: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """Pass ``columns`` on so that nothing above is worked into how they are computed.

    ``inline(array(struct(...)))`` is a generator. Catalyst neither merges projections through one
    nor pushes a filter on its output below it. Without it a ``filter`` on ``malformed`` would be
    rewritten in terms of the raw line, running every split and pattern many times over.
    """
    return df.selectExpr(*keep, f"inline(array(struct({', '.join(columns)})))")


def _cut(df: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """Host up to the first space, then the first bracket pair, then the first quote pair.

    Each split stops at the mark it looks for, and a missing mark leaves nulls behind it.
    """
    df = _select(df, keep, {"_line": line, "_by_space": f"split({line}, ' ', 2)"})
    # A blank line has no fields at all; one with a bracket cannot be blank.
    filled = f"(contains(_line, '[') OR NOT {is_blank('_line')})"
    host = f"CASE WHEN size(_by_space) = 2 AND {filled} THEN get(_by_space, 0) END"
    df = _select(df, keep, {"host": host, "_by_bracket": r"split(get(_by_space, 1), r'\[', 2)"})
    keep = [*keep, "host"]
    df = _select(df, keep, {"_by_bracket": "split(get(_by_bracket, 1), ']', 2)"})
    timestamp = "CASE WHEN size(_by_bracket) = 2 THEN get(_by_bracket, 0) END"
    df = _select(df, keep, {"timestamp": timestamp, "_by_quote": "split(get(_by_bracket, 1), '\"', 3)"})
    keep = [*keep, "timestamp"]
    request = "CASE WHEN size(_by_quote) = 3 THEN get(_by_quote, 1) END"
    df = _select(df, keep, {"_request": request, "_rest": "get(_by_quote, 2)", "_clock": "split(timestamp, ':', 3)"})
    return _select(
        df,
        [*keep, "_rest", "_clock"],
        {"_request": strip_blanks("_request"), "_date": "split(get(_clock, 0), '/', 4)"},
    )


def _read(df: DataFrame, keep: list[str]) -> DataFrame:
    months = ", ".join(f"'{month}'" for month in MONTHS)
    columns = {
        "_day": whole_number("get(_date, 0)"),
        "_month": f"int(nullif(array_position(array({months}), upper(get(_date, 1))), 0))",
        "_year": whole_number("get(_date, 2)"),
        "_hour": whole_number("get(_clock, 1)"),
        "_words": words("_request"),
        "_status": f"try_cast(regexp_extract(_rest, r'{_STATUS}', 1) AS INT)",
        "_bytes": f"try_cast(regexp_extract(_rest, r'{_BYTES}', 1) AS BIGINT)",
    }
    keep = [*keep, "host", "timestamp"]
    return barrier(_select(df, keep, columns), keep, columns)


def _record() -> dict[str, str]:
    dated = "(_year IS NOT NULL AND _month IS NOT NULL AND _day IS NOT NULL)"
    # No check of the day: the 45th of July keeps its place in the text.
    usual = "_year BETWEEN 0 AND 9999 AND _day BETWEEN 0 AND 99"
    plain = "concat(lpad(_year, 4, '0'), '-', lpad(_month, 2, '0'), '-', lpad(_day, 2, '0'))"
    odd = "format_string('%04d-%02d-%02d', _year, _month, _day)"
    # The number of words tells method, path and protocol apart, or else how a word starts.
    count, first, second = "size(_words)", "get(_words, 0)", "get(_words, 1)"
    first_is_protocol, second_is_protocol = f"startswith({first}, 'HTTP/')", f"startswith({second}, 'HTTP/')"
    lone_path = f"(NOT {first_is_protocol} AND startswith({first}, '/'))"
    return {
        "host": "host",
        "timestamp": "timestamp",
        "log_date": f"CASE WHEN {dated} THEN CASE WHEN {usual} THEN {plain} ELSE {odd} END END",
        "log_hour": f"CASE WHEN {dated} THEN coalesce(_hour, 0) ELSE 0 END",
        "http_method": f"""CASE
            WHEN {count} = 3 THEN {first}
            WHEN {count} = 2 AND ({second_is_protocol} OR NOT {first_is_protocol}) THEN {first}
            WHEN {count} = 1 AND NOT {first_is_protocol} AND NOT {lone_path} THEN {first} END""",
        "resource_path": f"""CASE
            WHEN {count} = 3 OR {count} = 2 AND NOT {second_is_protocol} THEN {second}
            WHEN {count} = 1 AND {lone_path} THEN {first} END""",
        "protocol_version": f"""CASE
            WHEN {count} = 3 THEN get(_words, 2)
            WHEN {count} = 2 AND {second_is_protocol} THEN {second}
            WHEN {count} IN (1, 2) AND {first_is_protocol} THEN {first} END""",
        "status_code": "coalesce(_status, 0)",
        "bytes_transferred": "CASE WHEN _status IS NOT NULL THEN coalesce(_bytes, 0L) ELSE 0L END",
        "batch_id": iso_week(f"({calendar_day('_year', '_month', '_day')})", "_year"),
        "malformed": f"""NOT coalesce(
            host IS NOT NULL AND {dated} AND _hour IS NOT NULL AND {count} BETWEEN 1 AND 3 AND _status IS NOT NULL,
            FALSE)""",
    }


def parse(df: DataFrame, line: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Replace the column ``line`` by the record columns of :data:`hitledger.schemas.RECORD`.

    Every input row gives one output row. Rows that do not parse have ``malformed`` set and hold
    what could be read before the fault. ``keep`` names further input columns to carry along.
    """
    keep = [f"`{name}`" for name in keep]
    read = _read(_cut(df, f"`{line}`", keep), keep)
    record = _record()
    return _select(read, keep, {f"`{name}`": record[name] for name in RECORD.fieldNames()})

"""Access-log lines rendered from the ``events`` table, good and faulty ones by a fixed scheme.

One line per event; the event id's remainder by 40 picks the form of the line. Nothing here goes
through a session time zone: ``ts`` has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitledger.functions.parser import barrier

_PARTS = {
    "form": "event_id % 40",
    # Form 18 moves through thirteen months, past the turn of the year.
    "moment": """CASE WHEN event_id % 40 = 18
                 THEN ts + make_dt_interval(CAST(30 * (event_id DIV 40 % 13) AS INT)) ELSE ts END""",
    "host": "'host' || user_id % 97 || '.example.com'",
    "path": "'/' || event_type || '/' || event_id * 31 % 37 || '.html'",
    "code": """string(get(array(200, 200, 200, 304, 302, 404, 403, 500, 501, 200),
               CAST(event_id * 7 % 10 AS INT)))""",
    "size": "string(event_id * 7919 % 65536)",
}

_CLOCK = {
    "dd": "lpad(day(moment), 2, '0')",
    "d": "string(day(moment))",
    "mon": """get(array('Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'),
              month(moment) - 1)""",
    "yyyy": "string(year(moment))",
    "hh": "lpad(hour(moment), 2, '0')",
    "ms": "lpad(minute(moment), 2, '0') || ':' || lpad(second(moment), 2, '0') || ' -0400'",
}

_TEXTS = {
    "any_host": "CASE form WHEN 16 THEN '' WHEN 24 THEN 'h\"]' || host ELSE host END",
    "stamp": """CASE form
        WHEN 10 THEN '31/Feb/2024:' || hh || ':' || ms
        WHEN 11 THEN dd || '/Foo/' || yyyy || ':' || hh || ':' || ms
        WHEN 12 THEN upper(dd || '/' || mon || '/' || yyyy) || ':' || hh || ':' || ms
        WHEN 22 THEN dd || '/' || mon || '/' || yyyy
        WHEN 23 THEN d || '/' || mon || '/' || yyyy || '/x:' || hh || ':' || ms
        WHEN 29 THEN dd || '/' || mon || '/' || yyyy || ':25:' || ms
        ELSE dd || '/' || mon || '/' || yyyy || ':' || hh || ':' || ms END""",
    "request": """CASE form
        WHEN 2 THEN 'GET ' || path || ' x HTTP/1.0'
        WHEN 6 THEN 'GET ' || path
        WHEN 7 THEN 'GET HTTP/1.0'
        WHEN 8 THEN path
        WHEN 9 THEN ''
        WHEN 13 THEN '\t' || 'GET  ' || path || ' HTTP/1.0 '
        WHEN 14 THEN 'HTTP/1.0'
        WHEN 15 THEN 'HTTP/1.0 ' || path
        WHEN 19 THEN 'GET'
        WHEN 28 THEN 'GET /é' || path || ' HTTP/1.0'
        ELSE 'GET ' || path || ' HTTP/1.0' END""",
    "rest": """CASE form WHEN 3 THEN 'abc' WHEN 20 THEN '+404' WHEN 25 THEN code || '.5' ELSE code END
        || CASE form WHEN 4 THEN ' -' WHEN 5 THEN '' WHEN 17 THEN ' xyz' WHEN 20 THEN ' -5'
                     WHEN 21 THEN ' 99999999999999999999' ELSE ' ' || size END""",
}

_LINE = """CASE
    WHEN form = 0 AND event_id % 80 = 0 THEN ''
    WHEN form = 0 THEN ' \t '
    WHEN form = 1 THEN any_host || ' - - "' || request || '" ' || rest
    WHEN form = 26 THEN 'nospace' || event_id
    WHEN form = 27 THEN any_host || ' - - [' || stamp || '] "' || request || ' ' || rest
    ELSE any_host || ' - - [' || stamp || '] "' || request || '" ' || rest END"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")


def _texts(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def render_lines(events: DataFrame) -> DataFrame:
    """``event_id`` and the line ``value``."""
    parts = events.selectExpr("event_id", *_texts(_PARTS)).selectExpr("*", *_texts(_CLOCK))
    lines = parts.selectExpr("event_id", "form", *_texts(_TEXTS)).selectExpr("event_id", f"{_LINE} AS value")
    # Keep the rendering out of the parser's expressions: the parser gets lines as if from a file. The id
    # goes past, so that a filter on it reaches the scan and only lines that are asked for are rendered.
    return barrier(lines, ["event_id"], ["value"])

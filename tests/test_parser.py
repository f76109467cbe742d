"""Rules of the parser, line by line."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hitledger.functions.parser import parse
from hitledger.schemas import RECORD

T = "[01/Jul/1995:00:00:01 -0400]"
STAMP = T[1:-1]


def record(host="h", timestamp=STAMP, log_date="1995-07-01", log_hour=0, http_method="GET", resource_path="/a",
           protocol_version="HTTP/1.0", status_code=200, bytes_transferred=1, batch_id=199526, malformed=False):
    return dict(locals())


NOTHING = record(None, None, None, 0, None, None, None, 0, 0, 0, True)


def stamped(stamp, **changes):
    return f'h - - [{stamp}] "GET /a HTTP/1.0" 200 1', record(timestamp=stamp, **changes)


def requested(request, method, path, protocol, **changes):
    return f'h - - {T} "{request}" 200 1', record(
        http_method=method, resource_path=path, protocol_version=protocol, **changes
    )


BAD_DATE = dict(log_date=None, log_hour=0, batch_id=0, malformed=True)


def ended(rest, status, size, malformed=False):
    return f'h - - {T} "GET /a HTTP/1.0"{rest}', record(status_code=status, bytes_transferred=size, malformed=malformed)


CASES = [
    # Blank lines and lines cut short keep what came before the fault.
    (None, NOTHING),
    ("", NOTHING),
    (" \t ", NOTHING),
    ("\x01\x1f ", NOTHING),
    ("nospace", NOTHING),
    ("h - -", {**NOTHING, "host": "h"}),
    (" x", {**NOTHING, "host": ""}),
    ("h - - [01/Jul/1995:00:00:01", {**NOTHING, "host": "h"}),
    (f"h - - {T}", record(http_method=None, resource_path=None, protocol_version=None, status_code=0,
                          bytes_transferred=0, malformed=True)),
    (f'h - - {T} "GET /a HTTP/1.0 200 1', record(http_method=None, resource_path=None, protocol_version=None,
                                                  status_code=0, bytes_transferred=0, malformed=True)),
    # Host: whatever precedes the first space of the line as it is.
    (f' h - - {T} "GET /a HTTP/1.0" 200 1', record(host="")),
    (f'\th - - {T} "GET /a HTTP/1.0" 200 1', record(host="\th")),
    (f'a[b]"c - - {T} "GET /a HTTP/1.0" 200 1', record(host='a[b]"c')),
    (f'h ] " - {T} "GET /a HTTP/1.0" 200 1', record()),
    (f'h {T} "GET /a HTTP/1.0" 200 1', record()),
    (f'a[b - - {T} "GET /a HTTP/1.0" 200 1', record(host="a[b")),
    (f'a[b]c d {T} "GET /a HTTP/1.0" 200 1', record(host="a[b]c")),
    ("a[b c", {**NOTHING, "host": "a[b"}),
    ("[] x", {**NOTHING, "host": "[]"}),
    (f'[ {T} "GET /a HTTP/1.0" 200 1', record(host="[")),
    (f'é[日 - {T} "GET /a HTTP/1.0" 200 1', record(host="é[日")),
    # Timestamp.
    stamped("01/Jul/1995:07:x", log_hour=7),
    stamped('01/Jul/1995:07:"x"y', log_hour=7),
    stamped('01/Jul/1995:07:é"日', log_hour=7),
    stamped("01/Jul/1995:07:[x", log_hour=7),
    ('h - - [01/Jul/1995:07:"x" "GET /a HTTP/1.0" 200 1', {**NOTHING, "host": "h"}),
    ('h - - ["] "GET /a HTTP/1.0" 200 1', record(timestamp='"', **BAD_DATE)),
    stamped("01/Jul/1995:+07", log_hour=7),
    stamped("01/JUL/1995:25:00 -0400", log_hour=25),
    stamped("1/jul/1995:00"),
    stamped("04/ſep/1995:00", log_date="1995-09-04", batch_id=199536),
    stamped("45/Jul/1995:00:00:01 -0400", log_date="1995-07-45", batch_id=0),
    stamped("30/Feb/1995:00:00:01 -0400", log_date="1995-02-30", batch_id=0),
    stamped("123/Jul/1995:00", log_date="1995-07-123", batch_id=0),
    stamped("-1/Jul/1995:00", log_date="1995-07--1", batch_id=0),
    stamped("01/Jul/95:00", log_date="0095-07-01", batch_id=9526),
    stamped("01/Jul/19950:00", log_date="19950-07-01", batch_id=0),
    stamped("01/Jul/-5:00", log_date="-005-07-01", batch_id=0),
    stamped("01/Jul/1995/x/y:00"),
    stamped("01/Jan/1995:00", log_date="1995-01-01", batch_id=199452),
    stamped("30/Dec/1996:00", log_date="1996-12-30", batch_id=199701),
    stamped("29/Feb/1996:00", log_date="1996-02-29", batch_id=199609),
    stamped("01/Jul/1995", malformed=True),
    stamped("01/Jul/1995:", malformed=True),
    stamped("01/Jul/1995:x", malformed=True),
    stamped("01/Jul/1995: 7", malformed=True),
    stamped("01/Jul/1995:99999999999", malformed=True),
    stamped("01/Foo/1995:00", **BAD_DATE),
    stamped("01/July/1995:00", **BAD_DATE),
    stamped(" 01/Jul/1995:00", **BAD_DATE),
    stamped("x/Jul/1995:00", **BAD_DATE),
    stamped("01/Jul/x:00", **BAD_DATE),
    stamped("01/Jul:00", **BAD_DATE),
    stamped("", **BAD_DATE),
    stamped(":", **BAD_DATE),
    # Request.
    requested("GET /a HTTP/1.0", "GET", "/a", "HTTP/1.0"),
    requested("\tGET  /a \x0b HTTP/1.0 ", "GET", "/a", "HTTP/1.0"),
    requested("\x01GET /a\x02", "GET", "/a", None),
    requested("GET\x01 /a", "GET\x01", "/a", None),
    requested("GET /a", "GET", "/a", None),
    requested("GET HTTP/1.0", "GET", None, "HTTP/1.0"),
    requested("HTTP/1.0 /a", None, "/a", "HTTP/1.0"),
    requested("HTTP/1.0 HTTP/1.1", "HTTP/1.0", None, "HTTP/1.1"),
    requested("HTTP/1.0", None, None, "HTTP/1.0"),
    requested("http/1.0", "http/1.0", None, None),
    requested("/a", None, "/a", None),
    requested("GET", "GET", None, None),
    requested("", "", None, None),
    requested("  ", "", None, None),
    requested("GET /a b HTTP/1.0", None, None, None, malformed=True),
    requested("GET /ä/日本 HTTP/1.0", "GET", "/ä/日本", "HTTP/1.0"),
    # Status and bytes.
    ended(" 200 12", 200, 12),
    ended(" 200 12 trailing words", 200, 12),
    ended("200\t12", 200, 12),
    ended(" +404 -5", 404, -5),
    ended(" -1 0", -1, 0),
    ended(" 200 -", 200, 0),
    ended(" 200", 200, 0),
    ended(" 200 x", 200, 0),
    ended(" 200 1.5", 200, 0),
    ended(" 200 99999999999999999999", 200, 0),
    ended(" 200 9223372036854775807", 200, 9223372036854775807),
    ended("\x01200 7\x02", 200, 7),
    ended(" 200 7\x02 8", 200, 0),
    ended(" 200\x02 7", 0, 0, True),
    ended(" 20.5 1", 0, 0, True),
    ended(" 99999999999 1", 0, 0, True),
    ended(" abc 1", 0, 0, True),
    ended("", 0, 0, True),
    (f'h - - {T} "GET /a"b" 200 1', record(protocol_version=None, status_code=0, bytes_transferred=0, malformed=True)),
]


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(CASES)], "i int, value string")
    return {row["i"]: row.asDict() for row in parse(lines, keep=["i"]).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[repr(line) for line, _ in CASES])
def test_line(parsed, i):
    assert parsed[i] == {"i": i, **CASES[i][1]}


def test_schema_is_the_declared_one(spark):
    got = parse(spark.createDataFrame([], "value string")).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in RECORD]


def test_other_column_names_and_kept_columns(spark):
    df = spark.createDataFrame([("k", f'h - - {T} "GET /a HTTP/1.0" 200 1')], "`file name` string, line string")
    row = parse(df, line="line", keep=["file name"]).first().asDict()
    assert row == {"file name": "k", **record()}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet='ab 01/[]":-+\t\x01JulHTTPGE.é', max_size=60), min_size=1, max_size=40))
def test_any_text_gives_one_record(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    rows = parse(df, keep=["i"]).collect()
    assert sorted(row["i"] for row in rows) == list(range(len(texts)))
    for row in rows:
        assert None not in (row["log_hour"], row["status_code"], row["bytes_transferred"], row["batch_id"])
        if not row["malformed"]:
            assert row["host"] is not None and row["log_date"] is not None and row["timestamp"] is not None
            assert f'{row["host"]} ' == texts[row["i"]][: len(row["host"]) + 1]


def test_valid_and_malformed_make_up_all_lines(spark, log_folder):
    from hitledger.operators.counters import etl_counters
    from hitledger.sources.lines import read_lines

    row = etl_counters(parse(read_lines(spark, log_folder))).first()
    assert row["valid_records"] + row["malformed_records"] == row["total_lines"] == 1000
    assert min(row) > 0


def test_malformed_is_worked_out_once(spark, plan_of):
    """A filter on the flag must not repeat the patterns below the barrier."""
    plan = plan_of(parse(spark.createDataFrame([], "value string")).filter(~F.col("malformed")))
    assert plan.count("regexp_extract(") == 2
    assert "EvalPython" not in plan

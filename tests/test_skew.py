"""Whole loads in which one week, path, host and hour hold a third of all lines or more."""

import duckdb
import pytest

from hitledger.functions.parser import parse
from hitledger.operators import queries as q
from hitledger.operators.records import staged
from hitledger.sources.lines import read_lines
from hitledger.sources.stage import read_audit, write_by_batch

N = 120_000

# Fields of line ``id``; the same text is good SQL in both engines.
FIELDS = {
    "host": "CASE WHEN id % 3 = 0 THEN 'crawler' ELSE 'h' || CAST(id * 31 % 4001 AS VARCHAR(9)) END",
    "path": "CASE WHEN id % 5 < 2 THEN '/hot' ELSE '/p' || CAST(id * 17 % 907 AS VARCHAR(9)) END",
    "day": "CASE WHEN id % 2 = 0 THEN 10 ELSE 10 + id * 7 % 20 END",
    "hour": "CASE WHEN id % 7 < 4 THEN 12 ELSE id % 24 END",
    "status": "CASE WHEN id % 11 < 5 THEN 200 ELSE 396 + id % 210 END",
    "size": "id % 5000",
}
COLUMNS = ", ".join(f"{sql} AS {name}" for name, sql in FIELDS.items())

BRUTE = {
    q.daily_traffic: """SELECT week, date, status, count(*), sum(size) FROM lines GROUP BY ALL""",
    q.resource_stats: """SELECT week, path, count(*), sum(size), count(DISTINCT host) FROM lines GROUP BY ALL""",
    q.host_sets: """SELECT week, path, count(DISTINCT host) FROM lines GROUP BY ALL""",
    q.top_resources: """SELECT week, path, count(*), sum(size), count(DISTINCT host) FROM lines GROUP BY week, path
        QUALIFY row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, path) <= 20""",
    q.resource_ranks: """SELECT week, path, count(*), sum(size), count(DISTINCT host),
        row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, path) FROM lines GROUP BY week, path""",
    q.hourly_errors: """SELECT week, date, hour, count(*) FILTER (status BETWEEN 400 AND 599), count(*),
        round(count(*) FILTER (status BETWEEN 400 AND 599) / count(*), 6),
        count(DISTINCT host) FILTER (status BETWEEN 400 AND 599) FROM lines GROUP BY ALL""",
}


@pytest.fixture(scope="module")
def stage(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skew")
    lines = spark.range(0, N, 1, 8).selectExpr(*[f"{sql} AS {name}" for name, sql in FIELDS.items()]).selectExpr(
        """host || ' - - [' || day || '/Jul/1995:' || hour || ':00:00 -0400] "GET ' || path || ' HTTP/1.0" '
           || status || ' ' || size AS value"""
    )
    lines.write.text(str(folder / "lines"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    write_by_batch(parse(read_lines(spark, str(folder / "lines"))), str(folder / "stage"))
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return str(folder / "stage")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute(
        f"""CREATE TABLE lines AS SELECT *, strftime(make_date(1995, 7, CAST(day AS INTEGER)), '%Y-%m-%d') AS date,
            isoyear(make_date(1995, 7, CAST(day AS INTEGER))) * 100 + week(make_date(1995, 7, CAST(day AS INTEGER))) AS week
            FROM (SELECT {COLUMNS} FROM range({N}) AS r(id))"""
    )
    return con


@pytest.mark.parametrize("ask", BRUTE, ids=lambda ask: ask.__name__)
def test_against_brute_force(spark, stage, db, ask):
    want = sorted(tuple(row) for row in db.execute(BRUTE[ask]).fetchall())
    records = read_audit(spark, stage)
    assert sorted(map(tuple, ask(records).collect())) == want
    if ask is q.daily_traffic:
        assert sorted(map(tuple, ask(staged(records)).collect())) == want


def test_the_large_week_has_several_files(spark, stage):
    names = read_audit(spark, stage).filter("batch_id = 199528").inputFiles()
    weeks = [name for name in names if "batch_id=199528" in name]
    assert len(weeks) > 2

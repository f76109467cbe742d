"""Every registered query against its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from hitledger.plans.catalog import CATALOG as QUERIES
from hitledger.plans.oracles import ORACLES

TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    relation = db.execute(ORACLES[name])
    columns = {d[0]: str(d[1]) for d in relation.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == columns
    order = sorted(columns)
    want = sorted((tuple(dict(zip(columns, row))[c] for c in order) for row in relation.fetchall()), key=repr)
    got = sorted((tuple(row[c] for c in order) for row in df.collect()), key=repr)
    assert got == want and got


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_loads_render_only_their_own_lines(spark, sf_dir, plan_of):
    from hitledger.plans.rendered import events, render_lines

    plan = plan_of(render_lines(events(spark, sf_dir)).filter("event_id <= 5"))
    assert "LessThanOrEqual(event_id,5)" in plan[plan.index("PushedFilters") :]


def test_audit_by_name_asks_no_results(spark, sf_dir, monkeypatch):
    from hitledger.plans import by_batch, catalog

    def unasked(*_):
        raise AssertionError("not needed for the audit table")

    monkeypatch.setattr(by_batch, "refresh", unasked)
    monkeypatch.setattr(catalog, "_line_files", unasked)
    rows = catalog.CATALOG["table_audit"](spark, sf_dir)
    assert rows.count() == events_of(spark, sf_dir)


def events_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").count()

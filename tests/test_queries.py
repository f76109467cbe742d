"""The queries on hand-made records, and agreement between their forms."""

import pytest
from pyspark.sql import functions as F

from hitledger.functions.parser import parse
from hitledger.operators import queries as q
from hitledger.operators.counters import batch_catalog, batch_record_counts, etl_counters, valid_per_batch
from hitledger.operators.records import staged
from hitledger.sources.lines import read_lines


@pytest.fixture(scope="module")
def records(spark, log_folder):
    return parse(read_lines(spark, log_folder)).persist()


def line(host, path, status, size, day=1, hour=0):
    return f'{host} - - [{day:02}/Jul/1995:{hour:02}:00:00 -0400] "GET {path} HTTP/1.0" {status} {size}'


@pytest.fixture(scope="module")
def few(spark):
    lines = [
        line("a", "/x", 200, 10),
        line("a", "/x", 404, 1),
        line("b", "/x", 500, 2, hour=1),
        line("b", "/y", 399, 3, hour=1),
        line("b", "/y", 600, 4, hour=1),
        line("c", "", 400, 5, hour=1),
        line("b", "/z", 599, 6, hour=1),
        line("a", "/y", 200, 7, day=3),
        "bad",
    ]
    return parse(spark.createDataFrame([(text,) for text in lines], "value string"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_daily_traffic(few):
    assert rows(q.daily_traffic(few)) == [
        (199526, "1995-07-01", 200, 1, 10),
        (199526, "1995-07-01", 399, 1, 3),
        (199526, "1995-07-01", 400, 1, 5),
        (199526, "1995-07-01", 404, 1, 1),
        (199526, "1995-07-01", 500, 1, 2),
        (199526, "1995-07-01", 599, 1, 6),
        (199526, "1995-07-01", 600, 1, 4),
        (199527, "1995-07-03", 200, 1, 7),
    ]


def test_top_resources(few):
    assert rows(q.top_resources(few, k=2)) == [
        (199526, "/x", 3, 13, 2),
        (199526, "/y", 2, 7, 1),
        (199527, "/y", 1, 7, 1),
    ]
    assert list(map(tuple, q.top_resources(few, k=3, scope="global").collect())) == [
        ("/x", 3, 13, 2),
        ("/y", 3, 14, 2),
        ("(empty)", 1, 5, 1),
    ]
    with pytest.raises(ValueError):
        q.top_resources(few, scope="week")


def test_hourly_errors(few):
    assert rows(q.hourly_errors(few)) == [
        (199526, "1995-07-01", 0, 1, 2, 0.5, 1),
        (199526, "1995-07-01", 1, 3, 5, 0.6, 2),
        (199527, "1995-07-03", 0, 0, 1, 0.0, 0),
    ]


def test_rates_have_six_decimals(spark):
    lines = [line("a", "/x", 200 if n else 404, 1) for n in range(7)]
    df = parse(spark.createDataFrame([(text,) for text in lines], "value string"))
    assert q.hourly_errors(df).first()["error_rate"] == 0.142857


def test_a_sum_that_does_not_fit_is_null(spark):
    lines = [line("a", "/x", 200, 2**63 - 1)] * 2 + [line("a", "/y", 404, 1)]
    df = parse(spark.createDataFrame([(text,) for text in lines], "value string"))
    assert rows(q.daily_traffic(df).select("status_code", F.coalesce("total_bytes", F.lit(-1)))) == [(200, -1), (404, 1)]


def test_forms_agree(records):
    assert rows(q.top_resources_array(records)) == rows(q.top_resources(records))
    assert rows(q.host_sets(records)) == rows(
        q.resource_stats(records).select("batch_id", "resource_path", "distinct_host_count")
    )
    ranked = q.resource_ranks(records).filter("rn <= 20").drop("rn")
    assert rows(ranked) == rows(q.top_resources(records))
    assert rows(batch_record_counts(q.daily_traffic(records))) == rows(valid_per_batch(records))


def test_stage_gives_the_same_answers(records):
    stage = staged(records)
    assert rows(q.daily_traffic(stage)) == rows(q.daily_traffic(records))
    assert rows(q.top_resources(stage)) == rows(q.top_resources(records))
    assert rows(q.hourly_errors(stage)) == rows(q.hourly_errors(records))


def test_properties(records):
    assert q.top_resources(records).groupBy("batch_id").count().filter("count > 20").count() == 0
    assert q.hourly_errors(records).filter("error_rate NOT BETWEEN 0 AND 1").count() == 0
    valid = etl_counters(records).first()["valid_records"]
    for result in (q.daily_traffic(records).select("request_count"), q.hourly_errors(records).select("total_request_count")):
        assert result.agg(F.sum(result.columns[0])).first()[0] == valid
    batches = [row["batch_id"] for row in batch_catalog(records).collect()]
    assert batches == sorted(set(batches)) and 0 in batches


def test_a_hot_path_is_spread_by_its_hosts(records, plan_of):
    """The first shuffle of the distinct count is by path and host, after a partial aggregate."""
    plan = plan_of(q.resource_stats(records))
    shuffles = [text for text in plan.splitlines() if text.startswith("Arguments: hashpartitioning")]
    assert any("host" in text for text in shuffles) and len(shuffles) == 2

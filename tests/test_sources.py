import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hitledger.functions.parser import parse
from hitledger.operators import queries as q
from hitledger.operators.records import non_blank, staged
from hitledger.schemas import DAILY_TRAFFIC, HOURLY_ERRORS, TOP_RESOURCES
from hitledger.sources.lines import lines_view, read_lines
from hitledger.sources.stage import AUDIT_COLUMNS, load_name, read_audit, read_stage, spread_by_batch, write_by_batch
from hitledger.plans.runs import run
from hitledger.sources.store import ParquetStore
from hitledger.sources.tsv import read_tsv, write_tsv


def values(df):
    return [row[0] for row in df.collect()]


def test_line_ends(spark, tmp_path):
    (tmp_path / "log").write_bytes(b"a\nb\r\nc\rd\n\n e ")
    assert values(read_lines(spark, str(tmp_path / "log"))) == ["a", "b", "c", "d", "", " e "]


def test_folder_is_flat_and_compressed_files_are_read(spark, tmp_path):
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "log").write_text("no")
    (tmp_path / "log1").write_text("one")
    with gzip.open(tmp_path / "log2.gz", "wt") as file:
        file.write("two")
    assert sorted(values(read_lines(spark, str(tmp_path)))) == ["one", "two"]


def test_encodings(spark, tmp_path):
    (tmp_path / "log").write_bytes("GET /ä".encode("latin-1"))
    assert values(read_lines(spark, str(tmp_path / "log"), "ISO-8859-1")) == ["GET /ä"]
    assert values(read_lines(spark, str(tmp_path / "log"))) == ["GET /�"]
    (tmp_path / "log8").write_text("GET /ä", encoding="utf-8")
    assert values(read_lines(spark, str(tmp_path / "log8"))) == ["GET /ä"]


def test_view_reads_empty_lines_as_null(spark, tmp_path):
    (tmp_path / "log").write_text("a\n\n \n")
    lines_view(spark, str(tmp_path / "log"), "raw_lines")
    assert values(spark.sql("SELECT line FROM raw_lines")) == ["a", None, " "]


def test_non_blank_trims_spaces_only(spark):
    df = spark.createDataFrame([("",), ("  ",), ("\t",), (None,), ("a",)], "value string")
    assert values(non_blank(df)) == ["\t", "a"]


@pytest.fixture(scope="module")
def records(spark, log_folder):
    return parse(read_lines(spark, log_folder)).persist()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("spread", [True, False])
def test_audit_table(spark, records, tmp_path, fmt, spread):
    path = str(tmp_path / "audit")
    write_by_batch(records, path, fmt, spread=spread)
    back = read_audit(spark, path, fmt)
    assert back.columns == AUDIT_COLUMNS and rows(back) == rows(records)


def test_stage_reads_only_the_folders_asked_for(spark, records, tmp_path, plan_of):
    path = str(tmp_path / "stage")
    write_by_batch(staged(records), path)
    week = read_stage(spark, path, batches=[202402, 202403])
    assert rows(week) == rows(staged(records).filter("batch_id IN (202402, 202403)"))
    plan = plan_of(q.daily_traffic(week))
    assert "PartitionFilters: [batch_id" in plan
    scanned = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert sorted(c.split(":")[0] for c in scanned[scanned.index("<") + 1:-1].split(",")) == [
        "bytes_transferred", "log_date", "malformed", "status_code"
    ]


def test_write_modes(spark, records, tmp_path):
    path = str(tmp_path / "stage")
    stage = staged(records)
    one, two = stage.filter("batch_id = 202402"), stage.filter("batch_id = 202403")
    write_by_batch(one, path)
    write_by_batch(two, path, mode="append")
    assert rows(read_stage(spark, path)) == rows(one.union(two))
    write_by_batch(two, path, mode="append")
    assert read_stage(spark, path).count() == one.count() + 2 * two.count()
    write_by_batch(one, path)
    assert rows(read_stage(spark, path)) == rows(one)
    for mode, load in (("merge", "x"), ("replace-load", None), ("replace-load", "a/b")):
        with pytest.raises(ValueError):
            write_by_batch(one, path, mode=mode, load=load)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_loads_that_share_weeks_keep_each_others_rows(spark, tmp_path, fmt):
    """Two loads with a common week and undated lines, each loaded twice."""
    path = str(tmp_path / "audit")
    good = 'h{} - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1'
    loads = {"a": [good.format(1), "bad", "worse"], "b": [good.format(2), good.format(3), "bad"]}
    for name in ("a", "b", "a", "b"):
        part = spark.createDataFrame([(line,) for line in loads[name]], "value string")
        write_by_batch(parse(part), path, fmt, mode="replace-load", load=name)
    assert read_audit(spark, path, fmt).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 3), (199526, 3)]
    assert load_name("x") == load_name(["x"]) != load_name(["x", "y"])


def test_equal_rows_are_parted_without_adaptive_execution(spark, tmp_path):
    for n in range(8):
        (tmp_path / f"log{n}").write_text("unreadable\n" * 1250)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = spread_by_batch(parse(read_lines(spark, str(tmp_path))))
        held = spread.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(held) > 4 and sum(n for _, n in held) == 10_000 and max(n for _, n in held) < 5000


def test_a_large_batch_is_split_among_tasks(spark, tmp_path):
    """Three quarters of the rows are in one batch; its folder gets more than one file."""
    lines = spark.range(0, 200_000, 1, 8).selectExpr(
        """'host' || id || ' - - [' || if(id % 4 = 0, 20, 10) || '/Jul/1995:00:00:00 -0400] "GET /p'
           || hash(id) || ' HTTP/1.0" 200 ' || id AS value"""
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_by_batch(parse(lines), str(tmp_path / "adaptive"))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        write_by_batch(parse(lines), str(tmp_path / "plain"))
        assert "rebalance" not in spread_by_batch(parse(lines))._jdf.queryExecution().logical().toString().lower()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for name in ("adaptive", "plain"):
        files = list((tmp_path / name).glob("load=*/batch_id=199528/*.parquet"))
        assert len(files) > 1
        assert read_audit(spark, str(tmp_path / name)).count() == 200_000


def test_records_per_file(spark, records, tmp_path):
    path = tmp_path / "audit"
    write_by_batch(records, str(path), max_records_per_file=10)
    files = spark.read.parquet(str(path)).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] == 10


@pytest.mark.parametrize(
    "ask, schema, order",
    [
        (q.daily_traffic, DAILY_TRAFFIC, ["batch_id", "log_date", "status_code"]),
        (q.top_resources, TOP_RESOURCES, ["batch_id", "-request_count", "resource_path"]),
        (q.hourly_errors, HOURLY_ERRORS, ["batch_id", "log_date", "log_hour"]),
    ],
)
def test_tsv_round_trip(spark, records, tmp_path, ask, schema, order):
    path = str(tmp_path / "tsv")
    for _ in range(2):
        write_tsv(ask(records), path, order)
    assert rows(read_tsv(spark, path, schema)) == rows(ask(records))


def test_tsv_text(spark, tmp_path):
    path = tmp_path / "tsv"
    df = spark.createDataFrame([(1, 'a"b\\c', 0.5), (2, None, 2 / 3), (3, "\\N", None), (4, "\\\\N", 1.0), (5, "", 1.0)], "n int, s string, x double")
    write_tsv(df.coalesce(1), str(path), ["-n"])
    (part,) = path.glob("part-*")
    assert part.read_text() == '5\t\t1.000000\n4\t\\\\\\N\t1.000000\n3\t\\\\N\t\\N\n2\t\\N\t0.666667\n1\ta"b\\c\t0.500000\n'
    assert rows(read_tsv(spark, str(path), df.schema).drop("x")) == rows(df.drop("x"))


def test_sums_past_64_bits_survive_the_text(spark, tmp_path):
    line = 'h - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 9000000000000000000'
    (tmp_path / "log").write_text(f"{line}\n{line}\n{line.replace('200 9', '404 1')}\n")
    store = ParquetStore(str(tmp_path / "store"))
    run(spark, str(tmp_path / "log"), store, tsv=str(tmp_path / "tsv"))
    got = store.read(spark, "q1_daily_traffic").select("status_code", "request_count", "total_bytes")
    assert rows(got) == ["Row(status_code=200, request_count=2, total_bytes=None)", "Row(status_code=404, request_count=1, total_bytes=1000000000000000000)"]
    assert [tuple(r) for r in store.read(spark, "q2_top_resources").select("request_count", "total_bytes").collect()] == [(3, None)]


def test_tsv_faults(spark, tmp_path):
    good = "199526\t1995-07-01\t 200\t1 \t-5"
    (tmp_path / "good").write_text(f"{good}\textra\n\n  \n199526\t1995-07-01\n{good}\n1\t2\t3\t4\t\n")
    got = read_tsv(spark, str(tmp_path / "good"), DAILY_TRAFFIC)
    assert list(map(tuple, got.collect())) == [(199526, "1995-07-01", 200, 1, -5)] * 2
    for bad in ("x\t1995-07-01\t200\t1\t1", "1\t1995-07-01\t200\t1.5\t1"):
        (tmp_path / "bad").write_text(bad)
        with pytest.raises(PySparkException, match="not a"):
            read_tsv(spark, str(tmp_path / "bad"), DAILY_TRAFFIC).collect()

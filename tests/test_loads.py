"""Which loads are visible, what is counted with a load, and tables kept up to date by batch."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hitledger.functions.arrays import register_top_rows
from hitledger.functions.parser import parse
from hitledger.operators import queries as q
from hitledger.operators.counters import etl_counters, per_batch_counts
from hitledger.plans import by_batch, runs, tables
from hitledger.plans.by_batch import read_results, refresh
from hitledger.plans.runs import QUERIES, run
from hitledger.plans.views import register_parse_log_line
from hitledger.session import create_file
from hitledger.sources import loads, stage
from hitledger.sources.loads import state, vacuum
from hitledger.sources.stage import TooManyBatches, compact, load_name, observed_batches, observed_counters, read_audit, write_by_batch
from hitledger.sources.store import ParquetStore, batch_cuts, range_predicates
from hitledger.streaming.ingest import ingest

GOOD = 'h{} - - [{:02}/Jul/1995:00:00:01 -0400] "GET /a{} HTTP/1.0" {} 1'


def rows(df):
    return sorted(map(repr, df.collect()))


def lines(spark, *items):
    """Records of good lines (host, day) and of texts as they are."""
    texts = [x if isinstance(x, str) else GOOD.format(x[0], x[1], x[0], 404 if x[0] % 3 == 0 else 200) for x in items]
    return parse(spark.createDataFrame([(x,) for x in texts], "value string"))


def weeks(spark, n):
    """Valid records of ``n`` different weeks."""
    dated = f"date_format(date_add(DATE'1990-01-03', 7 * int(id % {n})), \"dd/MMM/yyyy\")"
    return parse(spark.range(2 * n).selectExpr(f"""'h - - [' || {dated} || ':00:00:01 -0400] "GET /a HTTP/1.0" 200 1' AS value"""))


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("spread", [True, False])
def test_a_load_is_counted_as_it_is_written(spark, log_folder, tmp_path, spread):
    from hitledger.sources.lines import read_lines

    records = parse(read_lines(spark, log_folder))
    done = write_by_batch(records, str(tmp_path), load="x", spread=spread)
    assert (done.total_lines, done.valid_records, done.malformed_records) == etl_counters(records).first()
    assert rows(observed_batches(spark, str(tmp_path))) == rows(per_batch_counts(records).select("batch_id", "record_count", "malformed_count"))
    assert list(map(tuple, observed_counters(spark, str(tmp_path)).collect())) == [("x", *etl_counters(records).first())]


def test_a_run_does_not_read_the_stage_for_its_counts(spark, log_folder, tmp_path, monkeypatch):
    def fail(*_):
        raise AssertionError("a second scan")

    monkeypatch.setattr(runs, "per_batch_counts", fail)
    store = ParquetStore(str(tmp_path))
    done = run(spark, log_folder, store, query=1)
    assert store.read(spark, "run_metadata", done.run_id).first()["total_records"] == 775


def test_too_many_batches_to_count_are_read(spark, log_folder, tmp_path, monkeypatch):
    monkeypatch.setattr(stage, "_counts", lambda seen: None)
    store = ParquetStore(str(tmp_path / "store"))
    done = run(spark, log_folder, store, query=1, stage=str(tmp_path / "stage"))
    row = store.read(spark, "run_metadata", done.run_id).first()
    assert (row["total_records"], row["malformed_count"]) == (775, 225)
    assert observed_batches(spark, str(tmp_path / "stage")) is None
    assert [tuple(r)[1:] for r in observed_counters(spark, str(tmp_path / "stage")).collect()] == [(1000, 775, 225)]
    assert refresh(spark, str(tmp_path / "stage"), str(tmp_path / "r"), 1) == {1: None}


def test_counts_of_more_kinds_than_the_sketch_holds_are_not_trusted():
    seen = {"kinds": stage._TRACKED, "total": 5, "counted": [{"item": 2, "count": 5}]}
    assert stage._counts(seen) is None
    assert stage._counts(seen | {"kinds": 1}) == {1: (5, 0)}
    assert stage._counts(seen | {"kinds": 1, "total": 6}) is None


def test_a_load_of_too_many_weeks_never_shows(spark, tmp_path):
    path = str(tmp_path)
    write_by_batch(lines(spark, (1, 1)), path, load="a")
    for mode, load in (("append", None), ("replace", None), ("replace-load", "a")):
        with pytest.raises(TooManyBatches, match="1001 batches"):
            write_by_batch(weeks(spark, 1001), path, mode=mode, load=load)
        assert read_audit(spark, path).count() == 1
    assert len(list(tmp_path.glob("load=*"))) == 1
    done = write_by_batch(weeks(spark, 1000), path, mode="append")
    assert done.valid_records == 2000 and len(done.load.counts) == 1000
    write_by_batch(weeks(spark, 1001), path, mode="append", most_batches=0)
    assert read_audit(spark, path).count() == 1 + 2000 + 2002


def test_what_is_not_committed_is_not_there(spark, tmp_path):
    path = str(tmp_path)
    assert state(spark, path) is None
    folder = loads.begin(spark, path, "dead")
    lines(spark, (1, 1), (2, 1)).write.partitionBy("batch_id").parquet(f"{path}/{folder}")
    assert read_audit(spark, path).count() == 0
    # A writer that died before its commit was whole keeps its number and nothing else.
    create_file(spark, f"{path}/{loads.LOG}/{1:012}", '{"kind": "appe')
    write_by_batch(lines(spark, (3, 1)), path, mode="append")
    assert read_audit(spark, path).count() == 1 and state(spark, path).version == 2


def test_two_writers_get_numbers_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: write_by_batch(lines(spark, (n, 1)), path, mode="append"), range(6)))
    assert read_audit(spark, path).count() == 6 and state(spark, path).version == 6


def test_small_loads_are_merged(spark, tmp_path):
    path = str(tmp_path)
    write_by_batch(lines(spark, (1, 1), "bad"), path, mode="replace-load", load="named")
    for n in range(5):
        write_by_batch(lines(spark, (n, 1), (n, 9), "bad"), path, mode="append")
    before, reader = rows(read_audit(spark, path)), read_audit(spark, path)
    many, counts = len(files(path)), observed_batches(spark, path).orderBy("batch_id").collect()
    after = compact(spark, path)
    assert after.applied and len(after.loads) == 2 and after.touched == set()
    assert rows(read_audit(spark, path)) == before and rows(reader) == before
    assert observed_batches(spark, path).orderBy("batch_id").collect() == counts
    vacuum(spark, path, older_than_hours=0)
    assert rows(read_audit(spark, path)) == before and len(files(path)) < many
    assert compact(spark, path) is None
    # The named load can still be replaced, and so can all.
    write_by_batch(lines(spark, (7, 1)), path, mode="replace-load", load="named")
    assert read_audit(spark, path).count() == 16
    write_by_batch(lines(spark, (7, 1)), path)
    assert read_audit(spark, path).count() == 1


def test_a_merge_of_what_is_gone_has_no_effect(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for n in range(3):
        write_by_batch(lines(spark, (n, 1)), path, mode="append")
    real = stage._write

    def replaced_meanwhile(*arguments):
        monkeypatch.setattr(stage, "_write", real)
        write_by_batch(lines(spark, (9, 1)), path)
        return real(*arguments)

    monkeypatch.setattr(stage, "_write", replaced_meanwhile)
    assert not compact(spark, path).applied
    assert rows(read_audit(spark, path).select("host")) == ["Row(host='h9')"]


def test_a_stream_is_merged_while_it_runs(spark, tmp_path):
    folder, path, progress = tmp_path / "in", str(tmp_path / "stage"), str(tmp_path / "progress")
    folder.mkdir()
    for n in range(4):
        (folder / f"log{n}").write_text(GOOD.format(n, 1, n, 200) + "\nbad\n")
        ingest(spark, str(folder), path, progress, files_per_chunk=1).awaitTermination()
        compact(spark, path)
    now = state(spark, path)
    assert sorted(len(x.names) for x in now.loads) == [1, 3] and read_audit(spark, path).count() == 8
    counted = observed_counters(spark, path).agg(*(F.sum(c) for c in ("total_lines", "valid_records", "malformed_records"))).first()
    assert tuple(counted) == (8, 4, 4)
    # A chunk that is told again after it was merged is not there twice, nor is the last one.
    chunk = lines(spark, (0, 1), "bad")
    last, merged = sorted(now.loads, key=lambda x: len(x.names))
    for name in (merged.names[0], last.names[0]):
        done = write_by_batch(chunk, path, mode="replace-load", load=name, stream=load_name(progress), number=3)
        assert done.state.applied == (name == last.names[0])
    assert read_audit(spark, path).count() == 8


def test_the_log_is_shortened(spark, tmp_path):
    path = str(tmp_path)
    for n in range(4):
        write_by_batch(lines(spark, (n, 1)), path, mode="replace-load", load=f"l{n % 2}")
    before = rows(read_audit(spark, path))
    vacuum(spark, path, older_than_hours=1)
    assert len(list(tmp_path.glob("load=*"))) == 4
    vacuum(spark, path, older_than_hours=-1)
    assert [p.name for p in (tmp_path / loads.LOG).iterdir() if not p.name.startswith(".")] == ["000000000004.snapshot"]
    assert len(list(tmp_path.glob("load=*"))) == 2 and rows(read_audit(spark, path)) == before
    write_by_batch(lines(spark, (8, 1)), path, mode="append")
    now = state(spark, path, since=2)
    assert now.version == 5 and len(now.loads) == 3 and now.touched is None and state(spark, path, since=4).touched == {199526}


def test_names_do_not_depend_on_how_a_path_is_typed(spark, tmp_path):
    path = str(tmp_path)
    assert len({load_name(x) for x in (path, path + "/", f"file:{path}", f"file://{path}/", [path])}) == 1
    assert load_name(path) != load_name(os.path.dirname(path))


def test_only_touched_batches_are_worked_out_anew(spark, tmp_path):
    path, root = str(tmp_path / "stage"), str(tmp_path / "results")
    first = [(n, day) for n in range(30) for day in (1, 10, 17)]
    write_by_batch(lines(spark, *first, "bad"), path, load="a")
    assert refresh(spark, path, root) == {1: None, 2: None, 3: None}
    before = files(root)
    assert refresh(spark, path, root) == {1: set(), 2: set(), 3: set()} and files(root) == before

    write_by_batch(lines(spark, (50, 10), (51, 25)), path, mode="replace-load", load="b")
    assert refresh(spark, path, root) == {n: {199528, 199530} for n in (1, 2, 3)}
    after = files(root)
    same = [f for f in before if "batch_id=199526" in f or "batch_id=199529" in f]
    assert len(same) == 6 and all(after[f] == before[f] for f in same)
    for number, (_, ask, *_) in QUERIES.items():
        assert rows(read_results(spark, root, number)) == rows(ask(read_audit(spark, path)))
    assert {r[0] for r in read_results(spark, root, 1, [199530]).select("batch_id").collect()} == {199530}

    # The load comes again without one of its weeks.
    write_by_batch(lines(spark, (50, 10), "bad"), path, mode="replace-load", load="b")
    assert refresh(spark, path, root, 2) == {2: {0, 199528, 199530}}
    assert not os.path.exists(f"{root}/q2_top_resources/batch_id=199530")
    refresh(spark, path, root)
    for number, (_, ask, *_) in QUERIES.items():
        assert rows(read_results(spark, root, number)) == rows(ask(read_audit(spark, path)))
    with pytest.raises(ValueError):
        refresh(spark, str(tmp_path / "none"), root)


def test_a_refresh_that_was_cut_short_is_done_again(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "stage"), str(tmp_path / "results")
    write_by_batch(lines(spark, (1, 1)), path, load="a")
    refresh(spark, path, root, 1)
    write_by_batch(lines(spark, (2, 1)), path, mode="append")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(by_batch, "create_file", fail)
        with pytest.raises(OSError):
            refresh(spark, path, root, 1)
    assert refresh(spark, path, root, 1) == {1: {199526}}
    assert rows(read_results(spark, root, 1)) == rows(q.daily_traffic(read_audit(spark, path)))


def test_tables_by_name_show_what_is_visible(spark, tmp_path):
    spark.sql(f"CREATE DATABASE named LOCATION '{tmp_path}/db'")
    before = spark.catalog.currentDatabase()
    spark.sql("USE named")
    path, root, store = str(tmp_path / "it's a stage"), str(tmp_path / "results"), str(tmp_path / "store")
    try:
        (tmp_path / "log").write_text("one\n\ntwo\n")
        for n in range(3):
            write_by_batch(lines(spark, (n, 1), (n, 9), "bad"), path, mode="append")
            write_by_batch(lines(spark, (n, 17 + n)), path, mode="replace-load", load="named")
            refresh(spark, path, root)
            run(spark, str(tmp_path / "log"), ParquetStore(store))
            # Made once, told of what is new each time.
            tables.create_tables(spark, str(tmp_path / "log"), path, root, store)
            assert rows(spark.table("parsed_logs_audit").select(*stage.AUDIT_COLUMNS)) == rows(read_audit(spark, path))
            assert spark.table("parsed_logs_stage").count() == 2 * n + 3
            assert rows(spark.table("batch_ids")) == rows(read_audit(spark, path).filter("NOT malformed").select("batch_id").distinct())
            assert rows(spark.table("q1_daily_traffic").select(*QUERIES[1][3].fieldNames())) == rows(read_results(spark, root, 1))
            assert spark.table("run_events").count() == 2 * (n + 1)
        compact(spark, path)
        tables.sync_tables(spark, path)
        assert rows(spark.table("parsed_logs_audit").select(*stage.AUDIT_COLUMNS)) == rows(read_audit(spark, path))
        assert [r[0] for r in spark.table("raw_logs").collect()] == ["one", "", "two"]
        assert rows(spark.sql(tables.top_resources_sql(5))) == rows(q.top_resources(read_audit(spark, path), 5))
        spark.sql("DROP TABLE parsed_logs_audit")
        assert read_audit(spark, path).count() == 10
    finally:
        spark.sql(f"USE {before}")
        spark.sql("DROP DATABASE named CASCADE")


def test_events_of_runs(spark, tmp_path):
    store = ParquetStore(str(tmp_path / "store"))
    (tmp_path / "log").write_text("bad\n")
    run(spark, str(tmp_path / "log"), store, query=1)
    with pytest.raises(Exception):
        run(spark, str(tmp_path / "missing"), store, query=1)
    events = store.read(spark, "run_events")
    assert sorted((r.run_id, r.event) for r in events.collect()) == [(1, "finished"), (1, "started"), (2, "failed"), (2, "started")]
    # A run that is killed notes nothing more.
    store.note("started", events.filter("run_id = 2 AND event = 'started'").withColumn("run_id", F.lit(9)))
    from hitledger.operators.metadata import run_history

    assert {r.run_id: r.event for r in run_history(store.read(spark, "run_events")).collect()} == {1: "finished", 2: "failed", 9: "started"}
    assert store.read(spark, "run_metadata").count() == 3 and store.reserve(spark) == 10
    with pytest.raises(ValueError):
        store.note("lost", events)


def test_one_failing_query_leaves_the_others_records(spark, log_folder, tmp_path, monkeypatch):
    serial, store = ParquetStore(str(tmp_path / "serial")), ParquetStore(str(tmp_path / "store"))
    run(spark, log_folder, serial)
    done = run(spark, log_folder, store, side_by_side=True)
    names = [table for table, *_ in QUERIES.values()]
    for name in names:
        assert rows(store.read(spark, name).drop("loaded_at")) == rows(serial.read(spark, name).drop("loaded_at"))
    assert sorted(done.query_runtimes) == [1, 2, 3] and done.failures == {}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None

    def broken(records):
        raise ArithmeticError("query 2")

    monkeypatch.setitem(QUERIES, 2, (QUERIES[2][0], broken, *QUERIES[2][2:]))
    with pytest.raises(ArithmeticError):
        run(spark, log_folder, store, side_by_side=True)
    counts = [store.read(spark, name, 2).count() for name in names]
    assert counts[0] and not counts[1] and counts[2]
    assert {r[0] for r in store.read(spark, "batch_metadata", 2).select("query_name").collect()} == {"Q1", "Q3"}
    row = store.read(spark, "run_events", 2).filter("event = 'failed'").first()
    assert row["q1_runtime_ms"] > 0 and row["q2_runtime_ms"] == 0 < row["q3_runtime_ms"]


def test_ranges_of_a_database_read_follow_the_runs_batches(spark):
    assert range_predicates(7, []) == ["run_id = 7"]
    assert range_predicates(7, [30, 10, 30]) == [
        "run_id = 7 AND (batch_id < 10 OR batch_id IS NULL)", "run_id = 7 AND batch_id >= 10 AND batch_id < 30", "run_id = 7 AND batch_id >= 30"
    ]
    batches = spark.range(199501, 199553).selectExpr("int(id) AS batch_id").persist()
    cuts = batch_cuts(batches, 8)
    parts = [batches.filter(p.replace("run_id = 7 AND ", "")).count() for p in range_predicates(7, cuts)]
    assert sum(parts) == 52 and len(parts) == 8 and max(parts) <= 8
    assert batch_cuts(batches, 1) == [] and batch_cuts(batches.limit(0), 8) == []


def test_the_table_function_takes_one_line(spark, plan_of):
    register_parse_log_line(spark)
    got = spark.sql("SELECT r.* FROM VALUES ('bad'), (NULL), (NULL), ('bad') AS t(line), LATERAL parse_log_line(line) AS r")
    assert [r.malformed for r in got.collect()] == [True] * 4
    for wrong in ("parse_log_line()", "parse_log_line('a', 'b')"):
        with pytest.raises(Exception, match="WRONG_NUM_ARGS"):
            spark.sql(f"SELECT * FROM {wrong}").collect()
    plan = plan_of(spark.sql("SELECT r.* FROM VALUES ('a'), ('b') AS t(line), LATERAL parse_log_line(line) AS r WHERE NOT r.malformed"))
    # One generator keeps the filter from parsing the line again.
    assert len([text for text in plan.splitlines() if text.startswith("Arguments: inline(array(struct(")]) == 1


def test_top_rows_of_arrays(spark):
    register_top_rows(spark)
    rows = [
        ([["a", "5", "1", "1"], None, ["b", "7"], ["c", "x", "1", "1"], ["d", "7", "1", "1", "more"], ["e", "5", "1", "1"]], ["d", "a", "e", "c"]),
        ([["f", None, "1", "1"], ["g", "-3", "1", "1"], ["h", " 4", "1", "1"], ["i", "99999999999999999999", "1", "1"], ["j", "+2", "1", "1"]], ["j", "f", "h", "i", "g"]),
        ([], []),
        (None, []),
        ([[str(n), str(n % 7), "", ""] for n in range(50)], [str(n) for k in (6, 5, 4) for n in range(50) if n % 7 == k][:20]),
    ]
    spark.createDataFrame([(i, r) for i, (r, _) in enumerate(rows)], "id int, rows array<array<string>>").createOrReplaceTempView("some_rows")
    got = spark.sql("SELECT id, transform(top_rows(rows), r -> r[0]) AS names, size(top_rows(rows, 2)) AS two FROM some_rows").collect()
    assert {r.id: r.names for r in got} == {i: want for i, (_, want) in enumerate(rows)}
    assert all(r.two <= 2 for r in got)

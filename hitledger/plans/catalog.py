"""The registered queries: each operator run over the lines rendered from ``events``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.arrays import register_top_rows
from hitledger.functions.batching import register_week_batch_id
from hitledger.functions.parser import parse
from hitledger.operators import counters, metadata, queries, records, report
from hitledger.plans import by_batch, tables
from hitledger.plans.runs import DEFAULT_BATCH_SIZE, run
from hitledger.plans.runs import QUERIES as RUN_QUERIES
from hitledger.plans.rendered import events, render_lines
from hitledger.plans.views import register_parse_log_line, register_stage, register_views
from hitledger.schemas import DAILY_TRAFFIC, HOURLY_ERRORS, TOP_RESOURCES
from hitledger.session import scratch_path
from hitledger.sources import lines, stage, tsv
from hitledger.sources.store import ParquetStore
from hitledger.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]

# Run times the metadata queries work with, so that their results do not depend on the clock.
_RUN, _PIPELINE = 1, "Spark"
_RUNTIMES = {1: 1234, 2: 98765, 3: 7}

CATALOG: dict[str, Query] = {}


def _register(query: Query) -> Query:
    CATALOG[query.__name__] = query
    return query


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_lines(events(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the id of their event."""
    return parse(_lines(spark, sf_dir), keep=["event_id"])


def _line_files(spark: SparkSession, sf_dir: str) -> str:
    """The lines as text files in a scratch folder."""
    path = scratch_path(spark, "lines")
    _lines(spark, sf_dir).select("value").write.text(path)
    return path


@_register
def scan_lines(spark, sf_dir):
    return lines.read_lines(spark, _line_files(spark, sf_dir))


@_register
def scan_latin1(spark, sf_dir):
    """The lines written and read back as ISO-8859-1."""
    path = scratch_path(spark, "latin1")
    encoded = F.encode("value", "ISO-8859-1").cast("string")
    _lines(spark, sf_dir).select(encoded.alias("value")).write.text(path)
    return lines.read_lines(spark, path, "ISO-8859-1")


@_register
def scan_lines_view(spark, sf_dir):
    """The lines as a view, queried in SQL."""
    lines.lines_view(spark, _line_files(spark, sf_dir), "raw_lines")
    return spark.sql("SELECT line, count(*) AS copies FROM raw_lines GROUP BY line")


@_register
def filter_blank(spark, sf_dir):
    return records.non_blank(_lines(spark, sf_dir))


@_register
def parse_fields(spark, sf_dir):
    return _records(spark, sf_dir)


@_register
def filter_valid(spark, sf_dir):
    return records.valid(_records(spark, sf_dir))


@_register
def malformed_rows(spark, sf_dir):
    return records.malformed(_records(spark, sf_dir))


@_register
def blank_malformed(spark, sf_dir):
    return records.blank_malformed(_records(spark, sf_dir)).drop("timestamp")


@_register
def fill_missing(spark, sf_dir):
    return records.fill_missing(_records(spark, sf_dir)).drop("timestamp")


@_register
def week_batch_id(spark, sf_dir):
    """The batch id as a SQL function, on the dates of all records."""
    register_week_batch_id(spark)
    dates = _records(spark, sf_dir).groupBy("log_date").agg(F.count("*").alias("lines"))
    return dates.select("log_date", "lines", F.call_function("week_batch_id", F.col("log_date")).alias("week"))


@_register
def normalize_path(spark, sf_dir):
    return records.normalize_path(filter_valid(spark, sf_dir)).select("event_id", "resource_path")


@_register
def flag_errors(spark, sf_dir):
    return records.flag_errors(filter_valid(spark, sf_dir)).select("event_id", "status_code", "is_error")


@_register
def etl_counters(spark, sf_dir):
    return counters.etl_counters(_records(spark, sf_dir))


@_register
def batch_catalog(spark, sf_dir):
    return counters.batch_catalog(_records(spark, sf_dir))


@_register
def batch_record_counts(spark, sf_dir):
    return counters.batch_record_counts(q1_daily_traffic(spark, sf_dir))


@_register
def valid_per_batch(spark, sf_dir):
    return counters.valid_per_batch(_records(spark, sf_dir))


@_register
def q1_daily_traffic(spark, sf_dir):
    return queries.daily_traffic(_records(spark, sf_dir))


@_register
def resource_stats(spark, sf_dir):
    return queries.resource_stats(_records(spark, sf_dir))


@_register
def resource_ranks(spark, sf_dir):
    return queries.resource_ranks(_records(spark, sf_dir))


@_register
def host_sets(spark, sf_dir):
    return queries.host_sets(_records(spark, sf_dir))


@_register
def q2_top_resources(spark, sf_dir):
    return queries.top_resources(_records(spark, sf_dir))


@_register
def q2_top_resources_array(spark, sf_dir):
    return queries.top_resources_array(_records(spark, sf_dir))


@_register
def q2_top_resources_global(spark, sf_dir):
    return queries.top_resources(_records(spark, sf_dir), scope="global")


@_register
def q3_hourly_error(spark, sf_dir):
    return queries.hourly_errors(_records(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> str:
    """Stage the lines that are not blank."""
    path = scratch_path(spark, "stage")
    parsed = parse(records.non_blank(_lines(spark, sf_dir)))
    stage.write_by_batch(records.staged(parsed), path, fmt)
    return path


@_register
def stage_write(spark, sf_dir):
    return stage.read_stage(spark, _staged(spark, sf_dir))


@_register
def stage_write_orc(spark, sf_dir):
    return stage.read_stage(spark, _staged(spark, sf_dir, "orc"), "orc")


@_register
def stage_scan_pruned(spark, sf_dir):
    """Daily traffic of real weeks: the folder of impossible dates is not read."""
    return queries.daily_traffic(stage.read_stage(spark, _staged(spark, sf_dir)).filter("batch_id <> 0"))


@_register
def sql_over_stage(spark, sf_dir):
    """Top resources asked in SQL, over views of a loaded table."""
    path = scratch_path(spark, "audit")
    stage.write_by_batch(parse(_lines(spark, sf_dir)), path)
    register_stage(spark, path)
    return spark.sql(
        """
        WITH totals AS (
          SELECT batch_id, if(resource_path = '', '(empty)', resource_path) AS resource_path,
                 count(*) AS request_count, sum(bytes_transferred) AS total_bytes,
                 count(DISTINCT host) AS distinct_host_count
          FROM parsed_logs_stage
          GROUP BY batch_id, if(resource_path = '', '(empty)', resource_path)
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY request_count DESC, resource_path) AS rn
          FROM totals
        )
        SELECT batch_id, resource_path, request_count, total_bytes, distinct_host_count FROM ranked WHERE rn <= 20
        """
    )


@_register
def audit_stage(spark, sf_dir):
    path = scratch_path(spark, "audit")
    stage.write_by_batch(parse(_lines(spark, sf_dir)), path)
    return stage.read_audit(spark, path)


@_register
def audit_two_loads(spark, sf_dir):
    """Two loads of one table that share all their weeks, the second one loaded twice."""
    path = scratch_path(spark, "audit")
    parts = _lines(spark, sf_dir)
    for name, rest in (("even", 0), ("odd", 1), ("odd", 1)):
        part = parts.filter(F.col("event_id") % 2 == rest)
        stage.write_by_batch(parse(part), path, mode="replace-load", load=name)
    return stage.read_audit(spark, path)


@_register
def parsed_view(spark, sf_dir):
    """Raw lines asked in SQL, through the view of their records."""
    register_views(spark, _line_files(spark, sf_dir))
    return spark.sql("SELECT * FROM parsed_logs")


@_register
def stream_ingest(spark, sf_dir):
    path = scratch_path(spark, "ingested")
    ingest(spark, _line_files(spark, sf_dir), path, scratch_path(spark, "progress")).awaitTermination()
    return stage.read_audit(spark, path)


@_register
def tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    tsv.write_tsv(q1_daily_traffic(spark, sf_dir), path, ["batch_id", "log_date", "status_code"])
    return tsv.read_tsv(spark, path, DAILY_TRAFFIC)


@_register
def tsv_roundtrip_q3(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    tsv.write_tsv(q3_hourly_error(spark, sf_dir), path, ["batch_id", "log_date", "log_hour"])
    return tsv.read_tsv(spark, path, HOURLY_ERRORS)


@_register
def tsv_roundtrip_q2(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    tsv.write_tsv(q2_top_resources(spark, sf_dir), path, ["batch_id", "-request_count", "resource_path"])
    return tsv.read_tsv(spark, path, TOP_RESOURCES)


@_register
def run_through_text(spark, sf_dir):
    """A whole run whose results go to the store by way of tab-separated text; its top resources."""
    store = ParquetStore(scratch_path(spark, "store"))
    done = run(spark, _line_files(spark, sf_dir), store, tsv=scratch_path(spark, "tsv"))
    return store.read(spark, "q2_top_resources", done.run_id).drop("loaded_at")


@_register
def run_one_query(spark, sf_dir):
    """A run of one query: the rows that each result table got."""
    store = ParquetStore(scratch_path(spark, "store"))
    run(spark, _line_files(spark, sf_dir), store, query=3)
    tables = [store.read(spark, table) for table, *_ in RUN_QUERIES.values()]
    counted = [
        table.agg(F.count("*").alias("result_rows")).select(F.lit(number).alias("query"), "result_rows")
        for number, table in zip(RUN_QUERIES, tables)
    ]
    return reduce(DataFrame.unionByName, counted)


@_register
def runtime_slices(spark, sf_dir):
    runtimes = {metadata.QUERY_NAMES[number]: ms for number, ms in _RUNTIMES.items()}
    return metadata.runtime_slices(batch_record_counts(spark, sf_dir), runtimes)


def _run(spark: SparkSession, sf_dir: str, run_id: int = _RUN) -> DataFrame:
    return metadata.run_metadata(
        _records(spark, sf_dir), run_id, _PIPELINE, DEFAULT_BATCH_SIZE, _RUNTIMES, sum(_RUNTIMES.values())
    )


@_register
def run_metadata(spark, sf_dir):
    return _run(spark, sf_dir)


@_register
def latest_run(spark, sf_dir):
    """The newest of three runs over the same lines."""
    runs = _run(spark, sf_dir).withColumn("run_id", F.explode(F.array(F.lit(1), F.lit(3), F.lit(2))))
    return metadata.latest_run(runs).select("run_id", "total_records")


@_register
def report_batches(spark, sf_dir):
    return report.batch_listing(runtime_slices(spark, sf_dir).select(F.lit(_RUN).alias("run_id"), "*"), _RUN)


def _stored(spark: SparkSession, table: str, result: DataFrame) -> DataFrame:
    """A result put into a store and read back."""
    store = ParquetStore(scratch_path(spark, "store"))
    store.write(table, report.to_store(result, _RUN))
    return store.read(spark, table).drop("loaded_at")


@_register
def report_q1(spark, sf_dir):
    return report.traffic_listing(_stored(spark, "q1_daily_traffic", q1_daily_traffic(spark, sf_dir)), _RUN)


@_register
def report_q2(spark, sf_dir):
    return report.resource_listing(_stored(spark, "q2_top_resources", q2_top_resources(spark, sf_dir)), _RUN)


@_register
def report_q3(spark, sf_dir):
    return report.error_listing(_stored(spark, "q3_hourly_error", q3_hourly_error(spark, sf_dir)), _RUN)


@_register
def report_run(spark, sf_dir):
    return report.run_summary(_run(spark, sf_dir), _RUN)


@_register
def report_totals(spark, sf_dir):
    """Rows that the report counts below its listings."""
    return report.row_totals({"q1_daily_traffic": report_q1(spark, sf_dir), "q3_hourly_error": report_q3(spark, sf_dir)})


@_register
def report_with_run(spark, sf_dir):
    return report.with_run(report_q1(spark, sf_dir), _run(spark, sf_dir), _RUN)


@_register
def whole_run(spark, sf_dir):
    """A whole run from text files to the store; what it notes about its batches, without times."""
    store = ParquetStore(scratch_path(spark, "store"))
    done = run(spark, _line_files(spark, sf_dir), store)
    batches = store.read(spark, "batch_metadata", done.run_id)
    # A run has one record; its values are set beside each batch.
    noted = store.read(spark, "run_metadata", done.run_id).drop("executed_at", "run_id")
    row = noted.first()
    rows = batches.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in noted.schema})
    return rows.select(
        "run_id", "pipeline_name", "batch_size", "total_batches", "avg_batch_size", "total_records",
        "malformed_count", "query_name", "batch_id", "record_count",
    )


@_register
def observed_counters(spark, sf_dir):
    """Lines, valid and malformed records, as the job that loaded them counted them."""
    path = scratch_path(spark, "audit")
    loaded = stage.write_by_batch(parse(_lines(spark, sf_dir)), path, load="lines")
    return spark.createDataFrame(
        [(loaded.total_lines, loaded.valid_records, loaded.malformed_records)],
        "total_lines bigint, valid_records bigint, malformed_records bigint",
    )


@_register
def observed_batches(spark, sf_dir):
    """Valid records per batch over two loads, from the table's log alone."""
    path = _two_loads(spark, sf_dir)
    return stage.observed_batches(spark, path).filter("record_count > 0").select("batch_id", "record_count")


@_register
def stream_counters(spark, sf_dir):
    """The counts that a stream's chunks left, added up."""
    path = scratch_path(spark, "ingested")
    ingest(spark, _line_files(spark, sf_dir), path, scratch_path(spark, "progress"), files_per_chunk=1).awaitTermination()
    names = ("total_lines", "valid_records", "malformed_records")
    return stage.observed_counters(spark, path).agg(*(F.sum(c).alias(c) for c in names))


def _two_loads(spark: SparkSession, sf_dir: str, after=lambda path: None) -> str:
    """Lines of the earlier events loaded first, then the others; ``after`` runs behind each load."""
    path = scratch_path(spark, "audit")
    parts = _lines(spark, sf_dir)
    middle = events(spark, sf_dir).agg(F.max("event_id")).first()[0] // 2
    for name, part in (("early", F.col("event_id") <= middle), ("late", F.col("event_id") > middle)):
        stage.write_by_batch(parse(parts.filter(part)), path, mode="replace-load", load=name)
        after(path)
    return path


def _by_batch(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    root = scratch_path(spark, "results")
    _two_loads(spark, sf_dir, lambda path: by_batch.refresh(spark, path, root, number))
    return by_batch.read_results(spark, root, number)


@_register
def q1_by_batch(spark, sf_dir):
    """The table of daily traffic, brought up to date after each of two loads."""
    return _by_batch(spark, sf_dir, 1)


@_register
def q2_by_batch(spark, sf_dir):
    return _by_batch(spark, sf_dir, 2)


@_register
def q3_by_batch(spark, sf_dir):
    return _by_batch(spark, sf_dir, 3)


@_register
def parse_log_line_sql(spark, sf_dir):
    """Records of the lines by the SQL table function."""
    _lines(spark, sf_dir).createOrReplaceTempView("rendered_lines")
    register_parse_log_line(spark)
    return spark.sql("SELECT event_id, r.* FROM rendered_lines, LATERAL parse_log_line(value) AS r")


def _named(spark: SparkSession, sf_dir: str, of: str) -> None:
    """Tables by name, in a database of their own: the ``lines``, the ``stage`` told of a second load, or it and its ``results``."""
    name = scratch_path(spark, "db").rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    spark.sql(f"USE {name}")
    if of == "lines":
        tables.create_tables(spark, logs=_line_files(spark, sf_dir))
        return
    root = scratch_path(spark, "results") if of == "results" else None

    def after(path: str) -> None:
        if root:
            by_batch.refresh(spark, path, root)
        tables.create_tables(spark, stage=path, results=root)

    _two_loads(spark, sf_dir, after)


def _by_name(spark: SparkSession, sf_dir: str, sql: str, of: str = "stage") -> DataFrame:
    before = spark.catalog.currentDatabase()
    try:
        _named(spark, sf_dir, of)
        return spark.sql(sql)
    finally:
        spark.sql(f"USE {before}")


@_register
def table_raw_logs(spark, sf_dir):
    return _by_name(spark, sf_dir, f"SELECT line, count(*) AS copies FROM {tables.LINES} GROUP BY line", "lines")


@_register
def table_audit(spark, sf_dir):
    return _by_name(spark, sf_dir, f"SELECT {', '.join(stage.AUDIT_COLUMNS)} FROM {tables.AUDIT}")


@_register
def table_batch_ids(spark, sf_dir):
    return _by_name(spark, sf_dir, f"SELECT batch_id FROM {tables.BATCHES}")


@_register
def table_top_resources(spark, sf_dir):
    """Top resources asked of the staged table and the list of batches by name."""
    return _by_name(spark, sf_dir, tables.top_resources_sql())


@_register
def table_q3_hourly_error(spark, sf_dir):
    """The result table by name."""
    return _by_name(spark, sf_dir, f"SELECT {', '.join(HOURLY_ERRORS.fieldNames())} FROM q3_hourly_error", "results")


@_register
def compacted_stage(spark, sf_dir):
    """Four appended loads merged into one."""
    path = scratch_path(spark, "audit")
    parts = _lines(spark, sf_dir)
    for rest in range(4):
        stage.write_by_batch(parse(parts.filter(F.col("event_id") % 4 == rest)), path, mode="append")
    stage.compact(spark, path)
    return stage.read_audit(spark, path)


@_register
def run_history(spark, sf_dir):
    """What is known of three runs: one finished, one failed, one that was killed."""
    store = ParquetStore(scratch_path(spark, "store"))
    counts = counters.totals(counters.per_batch_counts(_records(spark, sf_dir))).persist()
    nothing = counts.select(*(F.lit(0).cast(kind).alias(c) for c, kind in counts.dtypes))
    for run_id, events in ((1, ("started", "finished")), (2, ("started", "failed")), (3, ("started",))):
        for event in events:
            seen = counts if event == "finished" else nothing
            store.note(event, metadata.describe_run(seen, run_id, _PIPELINE, DEFAULT_BATCH_SIZE, {}, 0))
    return metadata.run_history(store.read(spark, "run_events")).select("run_id", "event", "total_batches", "total_records", "malformed_count")


@_register
def top_rows_sql(spark, sf_dir):
    """The 20 most requested paths of each batch from an array of text rows, some of them unfit."""
    register_top_rows(spark)
    row = F.array("resource_path", F.col("request_count").cast("string"), F.col("total_bytes").cast("string"), F.col("distinct_host_count").cast("string"))
    none = F.lit(None).cast("string")
    unfit = F.array(
        F.lit(None).cast("array<string>"),
        F.array(F.lit("/short"), F.lit("999999999")),
        F.array(F.lit("/no-number"), F.lit("many"), F.lit("1"), F.lit("1")),
        F.array(F.lit("/no-count"), none, F.lit("1"), F.lit("1")),
    )
    keyed = F.struct(F.col("resource_path"), row.alias("row"))
    arrays = q2_top_resources(spark, sf_dir).groupBy("batch_id").agg(F.array_sort(F.collect_list(keyed)).alias("rows"))
    arrays = arrays.select("batch_id", F.concat(unfit, F.col("rows.row")).alias("rows"))
    arrays.createOrReplaceTempView("batch_rows")
    return spark.sql(
        """SELECT batch_id, int(place) AS place, r[0] AS resource_path, r[1] AS request_count
           FROM (SELECT batch_id, top_rows(rows, 25) AS top FROM batch_rows) LATERAL VIEW posexplode(top) AS place, r"""
    )


@_register
def run_side_by_side(spark, sf_dir):
    """A run that asks its queries at the same time; its hourly errors."""
    store = ParquetStore(scratch_path(spark, "store"))
    done = run(spark, _line_files(spark, sf_dir), store, side_by_side=True)
    return store.read(spark, "q3_hourly_error", done.run_id).drop("loaded_at").withColumn("log_date", F.col("log_date").cast("string"))

"""The engine's data as tables of the session's catalogue, read by name.

All but the list of batches are tables over folders that the engine keeps: making one reads nothing,
dropping one deletes nothing. Their partitions are what the catalogue was last told;
:func:`sync_tables` tells it what loads and runs have changed since. Of a staged table only visible
loads get partitions, so the table shows what the engine's own readers show.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from hitledger.operators.records import NO_PATH
from hitledger.plans.by_batch import table_schema
from hitledger.plans.runs import QUERIES
from hitledger.schemas import RECORD, RUN_EVENTS, STORE
from hitledger.session import list_folder
from hitledger.sources import loads
from hitledger.sources.stage import STAGE_COLUMNS

LINES, AUDIT, STAGED, BATCHES = "raw_logs", "parsed_logs_audit", "parsed_logs_stage", "batch_ids"
RUN_TABLES = ("run_events", "batch_metadata")

# Partitions told to the catalogue in one statement.
_AT_ONCE = 200


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: Iterable[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _create(spark: SparkSession, name: str, schema: Iterable[T.StructField], fmt: str, path: str, by: Iterable[str] = ()) -> None:
    parts = f"PARTITIONED BY ({', '.join(by)})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING {fmt} {parts} LOCATION {_text(path)}")


def _stage_schema() -> list[T.StructField]:
    inner = [f for f in RECORD if f.name != "batch_id"]
    return [*inner, T.StructField("load", T.StringType()), RECORD["batch_id"]]


def create_tables(
    spark: SparkSession,
    logs: str | None = None,
    stage: str | None = None,
    results: str | None = None,
    store: str | None = None,
    stage_format: str = "parquet",
) -> None:
    """Make the tables that don't exist yet, of whichever folders are named, in the current database.

    ``logs``: ``raw_logs(line)``. ``stage``: ``parsed_logs_audit``, all records by load and batch, and the
    view ``parsed_logs_stage`` of its valid ones. ``results``: the three results by batch. ``store``: the
    run tables of a :class:`hitledger.sources.store.ParquetStore`, with its results as ``run_q1...``.
    """
    if logs:
        _create(spark, LINES, [T.StructField("line", T.StringType())], "text", logs)
    if stage:
        _create(spark, AUDIT, _stage_schema(), stage_format, stage, ("load", "batch_id"))
        texts = {f.name for f in RECORD if isinstance(f.dataType, T.StringType)}
        columns = [f"coalesce({c}, '') AS {c}" if c in texts else c for c in STAGE_COLUMNS]
        spark.sql(f"CREATE OR REPLACE VIEW {STAGED} AS SELECT {', '.join(columns)} FROM {AUDIT} WHERE NOT malformed")
    if results:
        for number, (table, *_) in QUERIES.items():
            _create(spark, table, table_schema(number), "parquet", f"{results}/{table}", ["batch_id"])
    if store:
        folders = {f"run_{table}": table for table, *_ in QUERIES.values()} | {table: table for table in RUN_TABLES}
        for table, folder in folders.items():
            schema = RUN_EVENTS if folder == "run_events" else STORE[folder]
            fields = [f for f in schema if f.name != "run_id"]
            _create(spark, table, [*fields, schema["run_id"]], "parquet", f"{store}/{folder}", ["run_id"])
    sync_tables(spark, stage)


def _partition(load: str, batch: str) -> str:
    return f"PARTITION (load={_text(load)}, {batch})"


def _in_parts(spark: SparkSession, change: str, partitions: list[str], between: str) -> None:
    for at in range(0, len(partitions), _AT_ONCE):
        spark.sql(f"ALTER TABLE {AUDIT} {change} {between.join(partitions[at : at + _AT_ONCE])}")


def _sync_stage(spark: SparkSession, stage: str) -> None:
    known = [row[0].removeprefix("load=").split("/") for row in spark.sql(f"SHOW PARTITIONS {AUDIT}").collect()]
    now, told = loads.state(spark, stage), {load for load, _ in known}
    visible = {x.folder.removeprefix("load="): x.folder for x in now.loads} if now else {}
    # A load's folder never changes once it is visible, so those known need no second look.
    new = []
    for load, folder in visible.items():
        if load not in told:
            found = [name for name, _ in list_folder(spark, f"{stage}/{folder}") if name.startswith("batch_id=")]
            new += [_partition(load, name) for name in found]
    _in_parts(spark, "ADD IF NOT EXISTS", new, " ")
    # Catalogues need not take part of a partition's name for all that have it.
    _in_parts(spark, "DROP IF EXISTS", [_partition(load, batch) for load, batch in known if load not in visible], ", ")


def sync_tables(spark: SparkSession, stage: str | None = None) -> None:
    """Tell the catalogue about partitions that came and went; list the batches anew.

    ``stage`` is the folder of the staged table, if there is one.
    """
    here = {row["tableName"] for row in spark.sql("SHOW TABLES").collect() if not row["isTemporary"]}
    if stage and AUDIT in here:
        _sync_stage(spark, stage)
    for table in [*(t for t, *_ in QUERIES.values()), *(f"run_{t}" for t, *_ in QUERIES.values()), *RUN_TABLES]:
        if table in here:
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    if LINES in here:
        spark.sql(f"REFRESH TABLE {LINES}")
    if stage and AUDIT in here:
        spark.sql(f"REFRESH TABLE {AUDIT}")
        spark.sql(f"DROP TABLE IF EXISTS {BATCHES}")
        spark.sql(f"CREATE TABLE {BATCHES} USING parquet AS SELECT DISTINCT batch_id FROM {STAGED}")


def top_resources_sql(k: int = 20) -> str:
    """Top resources asked of the stage by name."""
    path = f"if(resource_path = '', '{NO_PATH}', resource_path)"
    return f"""
        SELECT batch_id, resource_path, request_count, total_bytes, distinct_host_count FROM (
          SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY request_count DESC, resource_path) AS rn FROM (
            SELECT batch_id, {path} AS resource_path, count(*) AS request_count, try_sum(bytes_transferred) AS total_bytes,
                   count(DISTINCT host) AS distinct_host_count
            FROM {STAGED} JOIN {BATCHES} USING (batch_id) GROUP BY batch_id, {path}))
        WHERE rn <= {k}"""

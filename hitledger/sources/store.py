"""Where results and run records are kept: Parquet folders by default, or a database over JDBC."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.operators.metadata import EVENTS, run_history
from hitledger.schemas import JDBC_TYPES, RUN_EVENTS, RUN_METADATA, STORE
from hitledger.session import create_file


# Batches that ranges of a database read are cut from: the weeks of 1990 to 2050.
BATCH_RANGE = (199001, 205053)


_EVENTS = "run_events"
_TABLES = {**STORE, _EVENTS: RUN_EVENTS}


def _last_id(runs: DataFrame) -> int:
    return runs.agg(F.max("run_id")).first()[0] or 0


def _in_layout(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _TABLES[table].fields])


def _event(row: DataFrame, event: str) -> DataFrame:
    if event not in EVENTS:
        raise ValueError(f"event must be one of {', '.join(EVENTS)}, got {event!r}")
    return _in_layout(row.withColumns({"executed_at": F.current_timestamp(), "event": F.lit(event)}), _EVENTS)


def range_predicates(run_id: int, cuts: list[int]) -> list[str]:
    """Conditions that part a run's rows at the batches ``cuts``; every row meets exactly one of them.

    Rows without a batch go with the first.
    """
    mine = f"run_id = {int(run_id)}"
    cuts = sorted(set(map(int, cuts)))
    if not cuts:
        return [mine]
    inner = [f"{mine} AND batch_id >= {a} AND batch_id < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{mine} AND (batch_id < {cuts[0]} OR batch_id IS NULL)", *inner, f"{mine} AND batch_id >= {cuts[-1]}"]


def batch_cuts(batches: DataFrame, parts: int) -> list[int]:
    """Batches at which ``batches``, one row each, falls into ``parts`` nearly equal ranges."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    return batches.agg(F.percentile_approx("batch_id", at, 10_000)).first()[0] or []


@dataclass(frozen=True)
class ParquetStore:
    """One folder per table, in it one per run.

    A run's rows replace any it wrote before, so a repeated write leaves no copies. What happens to
    runs is only ever added, to ``run_events``; reading ``run_metadata`` folds it to a row per run. A
    run's id is reserved by a file that only one run can create, on stores that create files
    atomically (HDFS and local ones).
    """

    root: str

    def reserve(self, spark: SparkSession) -> int:
        """An id no other run has or will get."""
        run_id = _last_id(self.read(spark, _EVENTS)) + 1
        while not create_file(spark, f"{self.root}/_run_ids/{run_id}"):
            run_id += 1
        return run_id

    def write(self, table: str, rows: DataFrame) -> None:
        writer = _in_layout(rows, table).write.mode("overwrite").partitionBy("run_id")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/{table}")

    def note(self, event: str, row: DataFrame) -> None:
        """Add what has happened to a run; ``row`` has the columns of ``run_metadata`` but the time."""
        _event(row, event).coalesce(1).write.mode("append").partitionBy("run_id").parquet(f"{self.root}/{_EVENTS}")

    def read(self, spark: SparkSession, table: str, run_id: int | None = None) -> DataFrame:
        if table == "run_metadata":
            return run_history(self.read(spark, _EVENTS, run_id)).select(*RUN_METADATA.fieldNames())
        schema = _TABLES[table]
        try:
            rows = spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = spark.createDataFrame([], schema)
        rows = rows.select(*schema.fieldNames())
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)


@dataclass(frozen=True)
class JdbcStore:
    """Tables of the same names in a database; Spark creates those that are missing.

    Spark only adds rows, so a run has a row of ``run_events`` for each thing that happens to it, as in
    the other store, and its id is reserved by adding a row of a token to the table
    ``run_ids`` and reading it back: of runs that took the same id, the one with the smallest token
    keeps it and the others go on. The table must exist or be creatable, and a committed row must be
    visible to other readers.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = 10_000
    connections: int = 8

    def write_options(self, table: str) -> dict[str, str]:
        options = {**self.properties, "batchsize": str(self.batch_size), "numPartitions": str(self.connections)}
        if table in JDBC_TYPES:
            options["createTableColumnTypes"] = JDBC_TYPES[table]
        return options

    def write(self, table: str, rows: DataFrame) -> None:
        self._append(table, _in_layout(rows, table))

    def read_options(self, table: str) -> dict[str, str | int]:
        """Result tables are read over several connections, each a range of batches.

        The bounds only set the ranges' width; rows beyond them, or without a batch, are read too.
        """
        if "batch_id" not in _TABLES[table].fieldNames():
            return {}
        first, last = BATCH_RANGE
        return {"column": "batch_id", "lowerBound": first, "upperBound": last, "numPartitions": self.connections}

    def note(self, event: str, row: DataFrame) -> None:
        """Add what has happened to a run; ``row`` has the columns of ``run_metadata`` but the time."""
        self._append(_EVENTS, _event(row, event))

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.write.jdbc(self.url, table, mode="append", properties=self.write_options(table))

    def _part(self, spark: SparkSession, table: str, predicates: list[str]) -> DataFrame:
        return spark.read.jdbc(self.url, table, predicates=predicates, properties=self.properties)

    def read(self, spark: SparkSession, table: str, run_id: int | None = None) -> DataFrame:
        """A table, or one run's part of it.

        A run's rows are read over several connections, cut at quantiles of the run's own batches, so
        that each has about as many batches, however the weeks are spread.
        """
        if table == "run_metadata":
            return run_history(self.read(spark, _EVENTS, run_id)).select(*RUN_METADATA.fieldNames())
        if run_id is None:
            return spark.read.jdbc(self.url, table, properties=self.properties, **self.read_options(table))
        cuts = []
        if "batch_id" in _TABLES[table].fieldNames() and table != "batch_metadata":
            noted = self._part(spark, "batch_metadata", range_predicates(run_id, []))
            cuts = batch_cuts(noted.select("batch_id").distinct(), self.connections)
        return self._part(spark, table, range_predicates(run_id, cuts))

    def reserve(self, spark: SparkSession) -> int:
        """An id no other run has or will get."""
        token = uuid.uuid4().hex
        run_id = _last_id(self.read(spark, _EVENTS))
        while True:
            run_id += 1
            mine = spark.createDataFrame([(run_id, token)], "run_id int, token string")
            mine.write.jdbc(self.url, "run_ids", mode="append", properties=self.properties)
            taken = spark.read.jdbc(self.url, "run_ids", properties=self.properties)
            if taken.filter(F.col("run_id") == run_id).agg(F.min("token")).first()[0] == token:
                return run_id


Store = ParquetStore | JdbcStore

"""Parsed records on disk, one folder per load and, in it, per batch.

Two tables share the layout: the *stage* has the valid records the queries read, the *audit* table
has every line's record, malformed ones included. Which loads are visible is told by the log of
:mod:`hitledger.sources.loads`.

A load is counted by the job that writes it: the rows are observed on their way into the files, above
the shuffle, where a task that runs again still counts once. The counts go into the log, so totals
and batches of a table are known without reading it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.schemas import RECORD
from hitledger.session import remove, whole_path
from hitledger.sources import loads
from hitledger.sources.loads import Counts, Load, State

AUDIT_COLUMNS = RECORD.fieldNames()
STAGE_COLUMNS = [name for name in AUDIT_COLUMNS if name != "timestamp"]

MODES = ("replace", "append", "replace-load")

# Ways to part one batch among writing tasks when the session does not split large ones itself.
_SALTS = 64

# Folders of a table: one per load, in it one per batch.
_LOAD = "load"

# Fixed value: batches that one load may have unless it is told otherwise.
MOST_BATCHES = 1000

# Batches, valid and malformed ones apart, that are counted exactly with the write.
_TRACKED = 1 << 17


class TooManyBatches(ValueError):
    """A load has more batches than it may; nothing of it is visible."""


@dataclass(frozen=True)
class Loaded:
    """What one load brought, counted as it was written, and the table's state with it."""

    load: Load
    total_lines: int
    valid_records: int
    malformed_records: int
    state: State


def spread_by_batch(df: DataFrame) -> DataFrame:
    """Bring a batch's rows together without forcing a large batch into one task.

    One week may hold a third of all rows. A rebalance is sized at run time from the shuffle's
    real partition sizes: large batches are split, small ones share a task. Without adaptive
    execution a row's place in its scan parts each batch a fixed number of ways, so that equal rows
    are parted as well; a task that runs again finds the same places.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", F.col("batch_id"))
    placed = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)))
    return placed.repartition("batch_id", "_salt").drop("_salt")


def load_name(source: str | Iterable[str]) -> str:
    """The name of a load, the same each time its input is loaded, however its paths are typed."""
    spark = SparkSession.active()
    paths = sorted(whole_path(spark, path) for path in ([source] if isinstance(source, str) else source))
    return hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]


def _observed(rows: DataFrame, seen: Observation) -> DataFrame:
    bad = F.col("malformed")
    # One number for batch and kind; the sketch is exact as long as it has room for all of them.
    kind = "CAST(batch_id AS BIGINT) * 2 + CAST(malformed AS INT)"
    return rows.observe(
        seen,
        F.count("*").alias("total"),
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("malformed"),
        F.approx_count_distinct(F.expr(kind), 0.02).alias("kinds"),
        F.approx_count_distinct("batch_id", 0.02).alias("batches"),
        F.expr(f"approx_top_k({kind}, 100000, {_TRACKED})").alias("counted"),
    )


def _counts(seen: dict) -> Counts | None:
    """Records per batch, where they are sure to be exact."""
    if seen["kinds"] > _TRACKED // 2 or sum(row["count"] for row in seen["counted"]) != seen["total"]:
        return None
    counts: dict[int, list[int]] = {}
    for row in seen["counted"]:
        counts.setdefault(row["item"] // 2, [0, 0])[row["item"] % 2] += row["count"]
    return {batch: (good, bad) for batch, (good, bad) in sorted(counts.items())}


def write_by_batch(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "replace",
    compression: str = "snappy",
    max_records_per_file: int = 0,
    spread: bool = True,
    load: str | None = None,
    most_batches: int = MOST_BATCHES,
    stream: str | None = None,
    number: int = 0,
) -> Loaded:
    """Write the rows of one load, one folder per ``batch_id`` in the load's own folder.

    ``mode`` is ``replace`` for a new table, ``append`` to add a load, or ``replace-load`` to replace
    the earlier rows of the load named, and only those: loads may share weeks, and all share the
    batch 0 of undated lines. An appended load gets a fresh name, so nothing is ever replaced.
    Logs that already arrive in time order can be written straight from the scan with
    ``spread=False``, which saves the shuffle.

    The load shows all at once, when its log entry is there. One with more than ``most_batches``
    batches (0 for any number) never shows: :class:`TooManyBatches` is raised and no row is dropped
    silently. A chunk of a ``stream`` that was merged into others by :func:`compact` is not written
    again.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode!r}")
    if mode == "replace-load" and not load:
        raise ValueError("name the load to replace")
    name = uuid.uuid4().hex if mode == "append" or not load else load
    if not name.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a load's name has letters, digits, - and _ only, got {name!r}")
    spark = df.sparkSession
    folder = loads.begin(spark, path, name)
    seen = _write(df, f"{path}/{folder}", fmt, compression, max_records_per_file, spread)
    counts = _counts(seen)
    batches = seen["batches"] if counts is None else len(counts)
    if most_batches and batches > most_batches:
        remove(spark, f"{path}/{folder}")
        raise TooManyBatches(f"{batches} batches, more than {most_batches}; nothing was loaded")
    new = Load(folder, [name], counts, appended=mode == "append", stream=stream, number=number)
    return Loaded(new, seen["total"], seen["valid"], seen["malformed"], loads.commit(spark, path, mode, new))


def _write(df: DataFrame, path: str, fmt: str, compression: str, max_records_per_file: int, spread: bool) -> dict:
    seen = Observation()
    writer = _observed(spread_by_batch(df) if spread else df, seen).write.format(fmt).partitionBy("batch_id")
    writer = writer.option("compression", compression).option("maxRecordsPerFile", max_records_per_file)
    writer.option("partitionOverwriteMode", "static").mode("overwrite").save(path)
    return seen.get


def compact(
    spark: SparkSession, path: str, fmt: str = "parquet", most_rows: int = 50_000_000, compression: str = "snappy", max_records_per_file: int = 0
) -> State | None:
    """Merge the small loads of an audit table that nobody replaces into one, visible in one step.

    Those are appended loads and a stream's chunks but the last, of up to ``most_rows`` records; None if
    there are fewer than two. Readers see either all of the old folders or the new one. Where a load
    was replaced meanwhile, the merge has no effect, as ``applied`` of the state tells.
    """
    now = loads.state(spark, path)
    small = [x for x in (now.mergeable() if now else []) if x.counts is not None and sum(map(sum, x.counts.values())) <= most_rows]
    if len(small) < 2:
        return None
    names = [name for x in small for name in x.names]
    folder = loads.begin(spark, path, "merged")
    _write(_of_folders(spark, path, AUDIT_COLUMNS, fmt, small), f"{path}/{folder}", fmt, compression, max_records_per_file, True)
    new = Load(folder, names, State(loads=small).counts(), appended=True)
    after = loads.commit(spark, path, "merge", new, [x.folder for x in small])
    if not after.applied:
        remove(spark, f"{path}/{folder}")
    return after


def observed_counters(spark: SparkSession, path: str) -> DataFrame:
    """A row per visible load: lines, valid and malformed records as counted when it was written.

    Loads whose batches were too many to be counted with the write are read.
    """
    rows = []
    for load in loads.state(spark, path).loads:
        if load.counts is None:
            bad = F.count_if("malformed")
            good, wrong = _of_folders(spark, path, AUDIT_COLUMNS, "parquet", [load]).agg(F.count("*") - bad, bad).first()
        else:
            good, wrong = (sum(n[k] for n in load.counts.values()) for k in (0, 1))
        rows.append((",".join(load.names), good + wrong, good, wrong))
    return spark.createDataFrame(rows, "load string, total_lines bigint, valid_records bigint, malformed_records bigint")


def observed_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """Valid and malformed records of each batch, from the log alone; None if some load has no counts."""
    counts = loads.state(spark, path).counts()
    if counts is None:
        return None
    return spark.createDataFrame([(batch, *n) for batch, n in counts.items()], "batch_id int, record_count bigint, malformed_count bigint")


def _layout(columns: list[str]) -> T.StructType:
    inner = [RECORD[name] for name in columns if name != "batch_id"]
    return T.StructType([*inner, T.StructField(_LOAD, T.StringType()), RECORD["batch_id"]])


def _of_folders(spark: SparkSession, path: str, columns: list[str], fmt: str, found: list[Load]) -> DataFrame:
    reader = spark.read.format(fmt).schema(_layout(columns)).option("basePath", path)
    rows = reader.load([f"{path}/{x.folder}" for x in found]) if found else spark.createDataFrame([], _layout(columns))
    return rows.select(*columns)


def _read(spark, path, columns, fmt, batches) -> DataFrame:
    now = loads.state(spark, path)
    if now is None:
        df = spark.read.format(fmt).schema(_layout(columns)).load(path).select(*columns)
    else:
        df = _of_folders(spark, path, columns, fmt, now.loads)
    return df if batches is None else df.filter(F.col("batch_id").isin(list(batches)))


def read_stage(
    spark: SparkSession, path: str, fmt: str = "parquet", batches: Iterable[int] | None = None
) -> DataFrame:
    """Staged records. ``batches``, like any filter on ``batch_id``, limits the folders listed."""
    return _read(spark, path, STAGE_COLUMNS, fmt, batches)


def read_audit(
    spark: SparkSession, path: str, fmt: str = "parquet", batches: Iterable[int] | None = None
) -> DataFrame:
    return _read(spark, path, AUDIT_COLUMNS, fmt, batches)

"""Tables and files in the folder that all executors reach, and small helpers for frames."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


_BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))

# For the C library's allocator: what a worker frees goes back to the system, so that its memory follows what it holds.
_ALLOCATION = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed, as in a local session.

    Batches of rows are bounded by bytes, unless the session says how: texts may be of any length.
    """
    if spark.conf.get(_BATCH_BYTES[0], None) is None:
        spark.conf.set(*_BATCH_BYTES)
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (_ROOT, known)))


def frugal(spark: SparkSession) -> None:
    """Have workers started from now on return large arrays' memory at once; it costs them some time."""
    for name, value in _ALLOCATION.items():
        spark.sparkContext.environment.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def folder(spark: SparkSession, label: str) -> str:
    """A new folder for files that workers write, as a URI or absolute path."""
    prepare(spark)
    return scratch_path(spark, label)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def write_file(path: str, parts: list[bytes | memoryview | pa.Buffer]) -> int:
    """Write under a name of its own and move into place, so that a task that runs again does no harm."""
    fs, name = file_system(path)
    fs.create_dir(os.path.dirname(name), recursive=True)
    own = f"{name}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    fs.move(own, name)
    return sum(memoryview(x).nbytes for x in parts)


def read_file(path: str) -> pa.Buffer:
    fs, name = file_system(path)
    with fs.open_input_file(name) as f:
        return f.read_buffer()


def with_columns(batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])


def in_order(docs: DataFrame, by: str, text: str, task_bytes: int) -> DataFrame:
    """``docs`` in ranges of ``by``, sorted in each and one range per partition.

    Rows that share a key are ordered, and spread over ranges, by a hash of the text. There is a
    partition per ``task_bytes`` of text up to 10,000 partitions, then they grow.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tie = fresh(docs, "tie")
    parts = min(max(1, -(-size // task_bytes)), 10_000)
    keyed = docs.withColumn(tie, F.xxhash64(text))
    return keyed.repartitionByRange(parts, by, tie).sortWithinPartitions(by, tie).drop(tie)

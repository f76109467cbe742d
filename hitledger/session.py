"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the plans here rely on for size: run-time coalescing, skew splitting in joins and in
# rebalanced writes, and re-runs that replace only the partitions they write.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_MB = 1 << 20

# One local scratch folder per Python process, made only when the cluster names none.
_local_scratch: list[str] = []


def build_session(app_name: str = "hitledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a load of ``input_bytes`` of text on ``cores`` cores.

    - A scan task reads 128 MB of a small load and up to 1 GB of a large one, so that the number of
      tasks, and with it of map outputs, stays near 100,000 at 100 TB; a line is dropped from
      memory once parsed, so the size of a scan task costs time only.
    - Shuffles start with one partition per 2 GB of text, at least two per core. The largest one, of
      (batch, path, host), carries three columns of the records after partial aggregation in each task.
      Adaptive execution joins small partitions.
    - Staged batches are cut to 256 MB per writing task, which sets the size of their files.
    """
    scan = min(max(input_bytes // 100_000, 128 * _MB), 1024 * _MB)
    shuffle = max(input_bytes // (2048 * _MB), 2 * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * _MB),
    }


def size_session(spark: SparkSession, paths: str | list[str]) -> None:
    """Set the sizes of :func:`sized_for` in a running session, from the bytes under ``paths``."""
    total = sum(folder_bytes(spark, path) for path in ([paths] if isinstance(paths, str) else paths))
    for key, value in sized_for(total, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def _hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself reaches them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files a path, which may hold wildcards, stands for."""
    where, files = _hadoop_path(spark, path)
    found = files.globStatus(where)
    return sum(files.getContentSummary(status.getPath()).getLength() for status in found or [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is in; nothing happens if it isn't there."""
    where, files = _hadoop_path(spark, path)
    files.delete(where, True)


def create_file(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with ``text``, and tell whether it was this call that created it."""
    where, files = _hadoop_path(spark, path)
    files.mkdirs(where.getParent())
    if files.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the operating system does it in one step.
        try:
            with open(where.toUri().getPath(), "x") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = files.create(where, False)
    except Py4JJavaError as fault:
        if "AlreadyExists" not in str(fault.java_exception.getClass().getName()):
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    where, files = _hadoop_path(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    where, files = _hadoop_path(spark, path)
    files.mkdirs(where)


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int]] | None:
    """Names in a folder and when each last changed, in milliseconds; None if there is no such folder."""
    where, files = _hadoop_path(spark, path)
    if not files.exists(where):
        return None
    return sorted((status.getPath().getName(), status.getModificationTime()) for status in files.listStatus(where))


def whole_path(spark: SparkSession, path: str) -> str:
    """A path in one form, however it was typed: absolute, with its file system, without a slash at the end."""
    where, files = _hadoop_path(spark, path)
    return files.makeQualified(where).toString()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may go without it. It then gets a folder of its own, which goes
    when the process ends.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master.startswith("local-cluster") or not master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="hitledger-"))
        atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
    return _local_scratch[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, for a table that is the caller's to remove."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh path that is removed at the end."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)

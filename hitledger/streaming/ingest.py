"""Loading log files as they arrive, in chunks, into the audit table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitledger.functions.parser import parse
from hitledger.sources import loads
from hitledger.sources.stage import MOST_BATCHES, load_name, write_by_batch


def stream_records(spark: SparkSession, folder: str, files_per_chunk: int = 1000) -> DataFrame:
    """Records of the files in ``folder``, present and future. The plan is the batch plan."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_chunk).text(folder)
    return parse(lines.select(F.make_valid_utf8("value").alias("value")))


def ingest(
    spark: SparkSession,
    folder: str,
    stage: str,
    checkpoint: str,
    files_per_chunk: int = 1000,
    continuous: bool = False,
    most_batches: int = MOST_BATCHES,
) -> StreamingQuery:
    """Add new files' records to the audit table at ``stage``, each file exactly once.

    The checkpoint remembers which files each chunk has; a chunk is a load of its own, named by the
    checkpoint and the chunk's number, so one that is repeated after a failure replaces itself. Its
    counts are in the table's log, see :func:`hitledger.sources.stage.observed_counters`, and
    :func:`hitledger.sources.stage.compact` merges chunks, also while the stream runs.
    Batch loads and streams can share a table. By default the query takes what is there now and
    ends; read the table with :func:`hitledger.sources.stage.read_audit`.
    """
    name = load_name(checkpoint)

    def write(chunk: DataFrame, number: int) -> None:
        now = loads.state(spark, stage)
        if now is None or not now.merged(f"{name}-{number}"):
            write_by_batch(
                chunk, stage, mode="replace-load", load=f"{name}-{number}", most_batches=most_batches, stream=name, number=number
            )

    writer = stream_records(spark, folder, files_per_chunk).writeStream.foreachBatch(write)
    trigger = {"processingTime": "1 minute"} if continuous else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

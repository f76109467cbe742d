"""A whole run: read lines, stage their records, answer the queries, keep results and run records."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitledger.functions.parser import parse
from hitledger.operators import queries as q
from hitledger.operators.counters import per_batch_counts, totals
from hitledger.operators.metadata import QUERY_NAMES, describe_run, runtime_slices
from hitledger.operators.report import to_store
from hitledger.schemas import DAILY_TRAFFIC, HOURLY_ERRORS, PER_BATCH, TOP_RESOURCES
from hitledger.session import scratch
from hitledger.sources.lines import read_lines
from hitledger.sources.stage import MOST_BATCHES, load_name, observed_batches, read_audit, write_by_batch
from hitledger.sources.store import Store
from hitledger.sources.tsv import read_tsv, write_tsv

# Fixed value: the batch size noted in a run's record where the caller names none.
DEFAULT_BATCH_SIZE = 10_000

# Query number: store table, function of records, order of its rows as text, columns.
QUERIES: dict[int, tuple[str, Callable[[DataFrame], DataFrame], list[str], StructType]] = {
    1: ("q1_daily_traffic", q.daily_traffic, ["batch_id", "log_date", "status_code"], DAILY_TRAFFIC),
    2: ("q2_top_resources", q.top_resources, ["batch_id", "-request_count", "resource_path"], TOP_RESOURCES),
    3: ("q3_hourly_error", q.hourly_errors, ["batch_id", "log_date", "log_hour"], HOURLY_ERRORS),
}


@dataclass
class Run:
    run_id: int
    stage: str | None
    runtime_ms: int = 0
    query_runtimes: dict[int, int] = field(default_factory=dict)
    # Of queries asked side by side, those that failed.
    failures: dict[int, Exception] = field(default_factory=dict)


def select_queries(query: int | Collection[int] = 0) -> list[int]:
    """The queries asked for: a number, several, or 0 for all."""
    wanted = sorted(QUERIES) if query == 0 else [query] if isinstance(query, int) else sorted(set(query))
    unknown = [number for number in wanted if number not in QUERIES]
    if unknown or not wanted:
        raise ValueError(f"query must be 0, 1, 2 or 3, got {query!r}")
    return wanted


def _since(start: float) -> int:
    return round((time.monotonic() - start) * 1000)


def run(
    spark: SparkSession,
    input_path: str | list[str],
    store: Store,
    query: int | Collection[int] = 0,
    pipeline_name: str = "Spark",
    batch_size: int = DEFAULT_BATCH_SIZE,
    encoding: str = "UTF-8",
    stage: str | None = None,
    stage_format: str = "parquet",
    mode: str = "replace",
    time_ordered: bool = False,
    tsv: str | None = None,
    most_batches: int = MOST_BATCHES,
    side_by_side: bool = False,
) -> Run:
    """Load ``input_path`` and answer the queries; return the run's id and times.

    Lines are parsed once, into an audit table of all records at ``stage``, which the queries then
    read column by column. Without a ``stage`` the table is scratch and goes when the run ends.
    ``mode`` says what becomes of loads already there, see
    :func:`hitledger.sources.stage.write_by_batch`; the queries cover the whole table. A load is
    named by its input, so with ``replace-load`` a repeated run replaces just its own rows.
    ``time_ordered`` says that files hold lines in the order of time, so that the table can be
    written without a shuffle. ``tsv`` names a folder that gets each result as tab-separated text,
    from which the store is then loaded.

    A query's time covers its plan and its writes. The counts in the run's record are taken by the job
    that writes the stage, whichever queries are asked for; only where a load had too many batches to
    be counted there is the stage read for them. Results are written by the tasks that hold them; only
    ids, times and counts pass through this process. A run's events are noted as they happen, so one
    that fails or is killed leaves its record too.

    ``side_by_side`` asks the queries at the same time, each as jobs of its own in a scheduler pool named
    after it (fair if the session's ``spark.scheduler.mode`` is ``FAIR``). One that fails doesn't keep
    the others from being stored and noted; then the run fails with its fault.
    """
    if batch_size <= 0:
        raise ValueError(f"batch_size must be positive, got {batch_size}")
    numbers = select_queries(query)
    this = Run(store.reserve(spark), stage)

    def note(event: str, counts: DataFrame) -> None:
        store.note(event, describe_run(counts, this.run_id, pipeline_name, batch_size, this.query_runtimes, this.runtime_ms))

    # No rows yet: sums over none of them.
    nothing = totals(spark.createDataFrame([], PER_BATCH))
    note("started", nothing)
    start = time.monotonic()
    with scratch(spark, "run") as work:
        table = stage or f"{work}/audit"
        try:
            records = parse(read_lines(spark, input_path, encoding))
            name = load_name(input_path)
            write_by_batch(records, table, stage_format, mode, spread=not time_ordered, load=name, most_batches=most_batches)
            staged = read_audit(spark, table, stage_format)
            per_batch = observed_batches(spark, table)
            if per_batch is None:
                # One row per ISO week, read more than once below.
                per_batch_counts(staged).write.parquet(f"{work}/batches")
                per_batch = spark.read.schema(PER_BATCH).parquet(f"{work}/batches")

            def answer(number: int) -> None:
                began = time.monotonic()
                _answer(spark, number, staged, store, this.run_id, tsv)
                this.query_runtimes[number] = _since(began)

            if side_by_side:
                this.failures |= _at_once(spark, numbers, answer)
            else:
                for number in numbers:
                    answer(number)
            runtimes = {QUERY_NAMES[number]: ms for number, ms in sorted(this.query_runtimes.items())}
            slices = runtime_slices(per_batch.filter("record_count > 0"), runtimes, f"{work}/slices")
            store.write(
                "batch_metadata",
                slices.select(F.lit(this.run_id).alias("run_id"), "*", F.current_timestamp().alias("loaded_at")),
            )
            for fault in this.failures.values():
                raise fault
        except BaseException:
            this.runtime_ms = _since(start)
            # The first fault is the one to tell; it may have taken the session with it.
            with suppress(Exception):
                note("failed", nothing)
            raise
        this.runtime_ms = _since(start)
        note("finished", totals(per_batch))
    return this


def _at_once(spark: SparkSession, numbers: list[int], ask: Callable[[int], None]) -> dict[int, Exception]:
    """Ask every query in a thread of its own; what failed, by query. Job groups and pools are the threads' own."""
    context, faults = spark.sparkContext, {}

    def one(number: int) -> None:
        context.setLocalProperty("spark.scheduler.pool", f"query-{number}")
        context.setJobGroup(f"query-{number}", f"query {number}")
        try:
            ask(number)
        except Exception as fault:
            faults[number] = fault
        finally:
            for name in ("spark.scheduler.pool", "spark.jobGroup.id", "spark.job.description"):
                context.setLocalProperty(name, None)

    with ThreadPoolExecutor(len(numbers)) as pool:
        list(pool.map(one, numbers))
    return dict(sorted(faults.items()))


def _answer(spark: SparkSession, number: int, staged: DataFrame, store: Store, run_id: int, tsv: str | None) -> None:
    table, ask, order, schema = QUERIES[number]
    result = ask(staged)
    if tsv:
        write_tsv(result, f"{tsv}/q{number}", order)
        result = read_tsv(spark, f"{tsv}/q{number}", schema)
    store.write(table, to_store(result, run_id))

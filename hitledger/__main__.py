"""Command line: ``python -m hitledger run ...``, ``load ...``, ``refresh ...``, ``compact ...`` and ``report ...``."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.parser import parse
from hitledger.operators.counters import per_batch_counts, totals
from hitledger.operators.report import TOTALLED, printed, report
from hitledger.plans.by_batch import refresh
from hitledger.plans.runs import DEFAULT_BATCH_SIZE, run
from hitledger.session import build_session, size_session
from hitledger.sources.lines import read_lines
from hitledger.sources.loads import vacuum
from hitledger.sources.stage import MODES, MOST_BATCHES, compact, load_name, observed_batches, read_audit, write_by_batch
from hitledger.sources.store import JdbcStore, ParquetStore, Store


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hitledger", description="Web access-log analytics on Spark")
    commands = parser.add_subparsers(dest="command", required=True)

    store = argparse.ArgumentParser(add_help=False)
    where = store.add_mutually_exclusive_group(required=True)
    where.add_argument("--store", help="folder of the Parquet result tables")
    where.add_argument("--db-url", help="JDBC address of the result tables")
    store.add_argument("--db-user", default="")
    store.add_argument("--db-pass", default="")

    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--input", required=True, help="log file or folder")
    source.add_argument("--encoding", default="UTF-8")
    source.add_argument("--max-batches", type=int, default=MOST_BATCHES, help="most week batches of a load, 0 for no limit")
    source.add_argument("--time-ordered", action="store_true", help="files hold lines in order of time")

    one = commands.add_parser("run", parents=[source, store], help="load logs and answer the queries")
    one.add_argument("--output", help="folder for results as tab-separated text")
    one.add_argument("--stage", help="folder of the parsed records")
    one.add_argument("--stage-format", default="parquet", choices=("parquet", "orc"))
    one.add_argument("--mode", default="replace", choices=MODES, help="what becomes of loads already there")
    one.add_argument("--query", type=int, default=0, choices=range(4), help="0 for all")
    one.add_argument("--batch", type=int, default=DEFAULT_BATCH_SIZE, help="batch size to note")
    one.add_argument("--pipeline-name", default="Spark")
    one.add_argument("--side-by-side", action="store_true", help="ask the queries at the same time")

    load = commands.add_parser("load", parents=[source], help="only parse logs into a stage")
    load.add_argument("--stage", required=True)
    load.add_argument("--batch", type=int, default=0, help="most records per file, 0 for no limit")
    load.add_argument("--drop", action="store_true", help="replace records already there")

    kept = commands.add_parser("refresh", help="bring result tables by batch up to date with a stage")
    kept.add_argument("--stage", required=True)
    kept.add_argument("--results", required=True, help="folder of the tables")
    kept.add_argument("--query", type=int, default=0, choices=range(4), help="0 for all")

    merged = commands.add_parser("compact", help="merge a stage's small loads, remove what no reader sees any more")
    merged.add_argument("--stage", required=True)
    merged.add_argument("--keep-hours", type=float, default=24.0, help="how long hidden files stay for readers under way")

    shown = commands.add_parser("report", parents=[store], help="show a run's results")
    shown.add_argument("run_id", type=int, nargs="?", help="latest if left out")
    return parser


def _store(options: argparse.Namespace) -> Store:
    if options.store:
        return ParquetStore(options.store)
    return JdbcStore(options.db_url, {"user": options.db_user, "password": options.db_pass})


def _print(listing: DataFrame) -> None:
    for line in printed(listing):
        print(line)


def _load(spark: SparkSession, options: argparse.Namespace) -> None:
    """Load, then print what was loaded: lines, batches and the time it took."""
    start = time.monotonic()
    records = parse(read_lines(spark, options.input, options.encoding))
    write_by_batch(
        records,
        options.stage,
        mode="replace" if options.drop else "replace-load",
        max_records_per_file=options.batch,
        spread=not options.time_ordered,
        load=load_name(options.input),
        most_batches=options.max_batches,
    )
    took = round((time.monotonic() - start) * 1000)
    # Counted as the loads were written; only where that was not possible is the table read.
    counts = observed_batches(spark, options.stage)
    counts = per_batch_counts(read_audit(spark, options.stage)).persist() if counts is None else counts
    valid = F.col("total_records")
    _print(totals(counts).select((valid + F.col("malformed_count")).alias("total_lines"), valid.alias("valid_records"), F.col("malformed_count").alias("malformed_records")))
    batches = counts.filter("record_count > 0").select("batch_id", "record_count").orderBy("batch_id")
    _print(batches)
    print(f"week batches: {batches.count()}, runtime: {took} ms")


def main(arguments: list[str] | None = None) -> None:
    options = _arguments().parse_args(arguments)
    spark = build_session()
    if options.command in ("run", "load"):
        size_session(spark, options.input)
    if options.command == "load":
        _load(spark, options)
    elif options.command == "run":
        done = run(
            spark,
            options.input,
            _store(options),
            query=options.query,
            pipeline_name=options.pipeline_name,
            batch_size=options.batch,
            encoding=options.encoding,
            stage=options.stage,
            stage_format=options.stage_format,
            mode=options.mode,
            time_ordered=options.time_ordered,
            tsv=options.output,
            most_batches=options.max_batches,
            side_by_side=options.side_by_side,
        )
        print(f"run {done.run_id}: {done.runtime_ms} ms, queries {done.query_runtimes}")
    elif options.command == "refresh":
        for number, batches in refresh(spark, options.stage, options.results, options.query).items():
            print(f"query {number}: {'all' if batches is None else len(batches)} batches worked out anew")
    elif options.command == "compact":
        after = compact(spark, options.stage)
        vacuum(spark, options.stage, options.keep_hours)
        print("nothing to merge" if after is None else f"loads: {len(after.loads)}, merged: {after.applied}")
    else:
        for name, listing in report(spark, _store(options), options.run_id).items():
            print(f"\n{name}")
            _print(listing)
            if name in TOTALLED:
                print(f"Total rows: {listing.count()}")


if __name__ == "__main__":
    main()

"""Command line: ``python -m roadlake <job> --root <folder>``; also usable with spark-submit."""

from __future__ import annotations

import argparse
import logging
import signal

from pyspark.sql import DataFrame, SparkSession

from roadlake.session import prepare
from roadlake.sinks.files import ROWS_PER_RAW_FILE
from roadlake.sources.kafka import TOPIC, kafka_stream
from roadlake.sources.raw import FILES_PER_TRIGGER
from roadlake.streaming.audit import audited
from roadlake.streaming.jobs import (
    ALERT_TOPIC,
    LOAD_TRIGGER,
    TRIGGER,
    Job,
    Layout,
    load_full,
    run_available,
    start_alerts,
    start_enrich,
    start_ingest,
    start_load,
)

# The jobs that each option means something to; given to another job it is refused.
_OPTION_JOBS = {
    "servers": {"ingest", "run", "alerts"},
    "topic": {"ingest", "run", "alerts"},
    "once": {"ingest", "enrich", "load", "alerts"},
    "every": {"ingest", "enrich", "load", "alerts"},
    "rows_per_file": {"ingest", "run"},
    "max_offsets": {"ingest", "run"},
    "option": {"ingest", "run"},
    "keep_extras": {"ingest"},
    "keep_offsets": {"ingest"},
    "max_files": {"enrich", "load", "run", "alerts"},
    "max_bytes": {"enrich", "load", "run", "alerts"},
    "precision": {"enrich", "run"},
    "enforce_contract": {"enrich", "run"},
}
# Messages that a micro-batch takes unless told otherwise, so that a first start does not take the whole topic at once.
MAX_OFFSETS = 1_000_000


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="roadlake", description=__doc__)
    parser.add_argument("job", choices=["ingest", "enrich", "load", "full-load", "alerts", "run"])
    parser.add_argument("--root", required=True, help="folder all stages share, on any file system")
    parser.add_argument("--servers", help="message brokers (ingest; optional for run and alerts)")
    parser.add_argument("--topic", help=f"default {TOPIC}; for alerts {ALERT_TOPIC}")
    parser.add_argument("--max-offsets", type=int, help=f"messages per micro-batch, default {MAX_OFFSETS}")
    parser.add_argument("--option", action="append", metavar="KEY=VALUE", help="further option of the topic reader")
    parser.add_argument("--keep-extras", action="store_true", default=None, help="keep fields that the schema lacks")
    parser.add_argument("--keep-offsets", action="store_true", default=None, help="keep a ledger of the offsets taken")
    parser.add_argument("--once", action="store_true", default=None, help="work off what is there, then stop")
    parser.add_argument("--every", help=f"pause between micro-batches, default {TRIGGER}; for load {LOAD_TRIGGER}")
    parser.add_argument("--rows-per-file", type=int, help=f"default {ROWS_PER_RAW_FILE}")
    parser.add_argument("--max-files", type=int, help=f"files per micro-batch, default {FILES_PER_TRIGGER}; for load no limit")
    parser.add_argument("--max-bytes", type=int, help="input bytes per micro-batch; replaces --max-files")
    parser.add_argument("--precision", choices=["second", "micro"])
    parser.add_argument("--enforce-contract", action="store_true", default=None)
    args = parser.parse_args(argv)
    for name, jobs in _OPTION_JOBS.items():
        if getattr(args, name) is not None and args.job not in jobs:
            parser.error(f"--{name.replace('_', '-')} means nothing to {args.job}")
    if args.job == "ingest" and not args.servers:
        parser.error("ingest needs --servers")
    if any("=" not in o for o in args.option or ()):
        parser.error("--option takes KEY=VALUE")

    def default(name: str, value: object) -> None:
        if getattr(args, name) is None:
            setattr(args, name, value)

    default("topic", ALERT_TOPIC if args.job == "alerts" else TOPIC)
    default("every", LOAD_TRIGGER if args.job == "load" else TRIGGER)
    default("rows_per_file", ROWS_PER_RAW_FILE)
    default("max_offsets", MAX_OFFSETS)
    default("max_files", None if args.job == "load" else FILES_PER_TRIGGER)
    default("precision", "second")
    for flag in ("enforce_contract", "keep_extras", "keep_offsets"):
        default(flag, False)
    args.option = dict(o.split("=", 1) for o in args.option or ())
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    owned = SparkSession.getActiveSession() is None
    spark = prepare(SparkSession.builder.appName(f"roadlake-{args.job}").getOrCreate())
    try:
        _work(spark, args)
    finally:
        if owned:
            spark.stop()


def _work(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = Layout(args.root.rstrip("/"))
    trigger = None if args.once else args.every
    messages = None
    if args.servers and args.job != "alerts":
        messages = kafka_stream(spark, args.servers, args.topic, max_offsets=args.max_offsets, **args.option)

    if args.job == "run":
        run_available(
            spark, layout, messages, args.rows_per_file, args.max_files, args.max_bytes, args.precision, args.enforce_contract
        )
    elif args.job == "full-load":
        logging.info("%s", load_full(spark, layout))
    else:
        with audited(spark, layout.audit):
            _await(_started(spark, args, layout, trigger, messages))


def _started(spark: SparkSession, args: argparse.Namespace, layout: Layout, trigger: str | None, messages: DataFrame | None) -> Job:
    if args.job == "ingest":
        return start_ingest(
            messages, layout, trigger, args.rows_per_file, keep_extras=args.keep_extras, keep_offsets=args.keep_offsets
        )
    if args.job == "enrich":
        return start_enrich(spark, layout, trigger, args.max_files, args.max_bytes, args.precision, args.enforce_contract)
    if args.job == "alerts":
        return start_alerts(spark, layout, trigger, args.max_files, args.max_bytes, args.servers, args.topic)
    return start_load(spark, layout, trigger, args.max_files, args.max_bytes)


def _await(query: Job) -> None:
    """Wait for a job; an interrupt or a termination signal stops it, and the next start goes on from there."""

    def interrupt(*_: object) -> None:
        raise KeyboardInterrupt

    before = signal.signal(signal.SIGTERM, interrupt)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        logging.info("stopping")
        query.stop()
    finally:
        signal.signal(signal.SIGTERM, before)


if __name__ == "__main__":
    main()

import contextlib
import os
import signal
import time

import pytest
from pyspark.sql import functions as F

from conftest import at, event
from roadlake import __main__ as cli
from roadlake.__main__ import arguments, main
from roadlake.operators.upsert import read_target
from roadlake.schema import EVENT_SCHEMA
from roadlake.sinks.files import write_raw
from roadlake.streaming.jobs import Layout


def test_defaults_are_the_fixed_values():
    args = arguments(["ingest", "--root", "/r", "--servers", "h:1"])
    assert (args.topic, args.every, args.rows_per_file, args.max_files) == ("vehicle-info", "1 minute", 100, 10)
    load = arguments(["load", "--root", "/r"])
    assert (load.every, load.max_files, load.precision, load.enforce_contract) == ("1 hour", None, "second", False)
    assert arguments(["alerts", "--root", "/r"]).topic == "vehicle-alerts"


def test_topic_options_reach_the_reader(monkeypatch):
    seen = {}
    monkeypatch.setattr(cli, "kafka_stream", lambda spark, *args, **options: seen.update(args=args, **options))
    monkeypatch.setattr(cli, "start_ingest", lambda *args, **options: None)
    monkeypatch.setattr(cli, "audited", lambda *_: contextlib.nullcontext())
    monkeypatch.setattr(cli, "_await", lambda query: None)
    extra = ["--option", "failOnDataLoss=false", "--option", "kafka.x=a=b"]
    cli._work(None, arguments(["ingest", "--root", "/r", "--servers", "h:1", "--topic", "t", "--max-offsets", "7", *extra]))
    assert seen == {"args": ("h:1", "t"), "max_offsets": 7, "failOnDataLoss": "false", "kafka.x": "a=b"}


@pytest.mark.parametrize("line", [
    "full-load --max-bytes 5", "full-load --once", "load --precision micro", "enrich --servers h:1", "ingest --servers h:1 --max-files 3",
    "ingest --servers h:1 --option novalue", "run --once",
])
def test_options_without_meaning_are_refused(line):
    with pytest.raises(SystemExit):
        arguments([*line.split(), "--root", "/r"])


def test_run_passes_every_option(spark, folder):
    layout = Layout(folder)
    df = spark.createDataFrame([event("V1001"), event("V1002", speed=500.0)], EVENT_SCHEMA)
    write_raw(df.withColumn("arrived", F.lit(at("2024-01-01"))), layout.raw)
    main(["run", "--root", folder, "--enforce-contract", "--precision", "micro", "--max-bytes", "1000"])
    rows = read_target(spark, layout.target).collect()
    assert [(r.vehicle_id, r.event_time.microsecond) for r in rows] == [("V1001", 500_000)]


def test_an_interrupt_stops_the_query():
    class Query:
        stopped = False

        def awaitTermination(self):
            os.kill(os.getpid(), signal.SIGTERM)
            time.sleep(5)

        def stop(self):
            self.stopped = True

    query, before = Query(), signal.getsignal(signal.SIGTERM)
    cli._await(query)
    assert query.stopped and signal.getsignal(signal.SIGTERM) == before


def test_ingest_needs_servers():
    with pytest.raises(SystemExit):
        arguments(["ingest", "--root", "/r"])


def test_jobs_from_the_command_line(spark, folder):
    layout = Layout(folder)
    df = spark.createDataFrame([event(f"V{1000 + i}") for i in range(7)], EVENT_SCHEMA)
    write_raw(df.withColumn("arrived", F.lit(at("2024-01-01"))), layout.raw)
    main(["enrich", "--root", folder + "/", "--once", "--enforce-contract"])
    main(["load", "--root", folder, "--once"])
    assert read_target(spark, layout.target).count() == 7
    main(["full-load", "--root", folder])
    main(["run", "--root", folder])
    assert read_target(spark, layout.target).count() == 7

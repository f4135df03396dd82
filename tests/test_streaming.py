"""The three jobs: results, restarts, replays, quarantine."""

import glob
import json
import os
import shutil
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import at, event
from roadlake.functions.event_time import add_event_time
from roadlake.functions.records import encode_events
from roadlake.operators.alerts import overspeed_alerts
from roadlake.operators.offsets import findings
from roadlake.operators.upsert import read_target
from roadlake.schema import EVENT_SCHEMA, KEY_COLS, PROCESSED_SCHEMA
from roadlake.sinks.files import write_processed, write_raw
from roadlake.sources.processed import read_processed
from roadlake.sources.raw import raw_stream, read_raw
from roadlake.streaming import jobs
from roadlake.streaming.audit import audited, read_audit
from roadlake.streaming.jobs import Layout, load_full, read_offsets, read_quarantine, run_available, start_alerts, start_enrich, start_ingest, start_load
from test_storage import START


@pytest.fixture
def layout(spark, folder):
    made = Layout(folder)
    made.create(spark)
    return made


def rows(spark, n, first=0, **changes):
    made = [event(f"V{1000 + i}", START + i * 3600, **changes) for i in range(first, first + n)]
    return spark.createDataFrame(made, EVENT_SCHEMA)


def put_raw(df, layout, day="2024-01-01"):
    write_raw(df.coalesce(1).withColumn("arrived", F.lit(at(day))), layout.raw, rows_per_file=10)


def put_messages(spark, folder, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").parquet(folder)


def messages(spark, folder):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(folder)


def drain(query):
    query.awaitTermination()
    return query


def aside(spark, layout):
    return read_quarantine(spark, layout).collect()


def test_enrich_equals_the_batch_result(spark, layout):
    put_raw(rows(spark, 95), layout)
    drain(start_enrich(spark, layout, None, max_files=4))
    got = read_processed(spark, layout.enriched)
    want = add_event_time(rows(spark, 95)).select(*PROCESSED_SCHEMA.names)
    assert got.count() == 95 and got.exceptAll(want).isEmpty()
    assert aside(spark, layout) == []


def test_rate_limit_bounds_a_batch(spark, layout):
    put_raw(rows(spark, 95), layout)
    query = drain(start_enrich(spark, layout, None, max_files=4))
    # Ten files of at most ten rows, four files a batch.
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3


def test_size_limit_bounds_a_batch(spark, layout):
    put_raw(rows(spark, 95), layout)
    query = drain(start_enrich(spark, layout, None, max_bytes=3000))
    assert read_processed(spark, layout.enriched).count() == 95
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 3


def fail_after(monkeypatch, name, calls):
    """Let ``jobs.<name>`` do its work, then fail on the given call."""
    real, made = getattr(jobs, name), []

    def wrapped(*args, **kwargs):
        result = real(*args, **kwargs)
        made.append(name)
        if len(made) == calls:
            raise RuntimeError("lost after the write")
        return result

    monkeypatch.setattr(jobs, name, wrapped)


def lose_commit(layout, job):
    """As when the driver dies after the files of a batch have been noted and before its commit: the batch is repeated."""
    shutil.rmtree(f"{layout.checkpoint(job)}/commits")


def test_replayed_enrich_batch_is_not_doubled(spark, layout):
    put_raw(rows(spark, 50), layout)
    drain(start_enrich(spark, layout, None, max_files=2))
    lose_commit(layout, "enrich")
    put_raw(rows(spark, 10, 50), layout)
    drain(start_enrich(spark, layout, None, max_files=2))
    got = read_processed(spark, layout.enriched)
    assert got.count() == 60 and got.select("vehicle_id").distinct().count() == 60


def test_replayed_ingest_batch_is_not_doubled(spark, layout, folder):
    source = f"{folder}/messages"
    for i in range(3):
        put_messages(spark, source, [r.value for r in encode_events(rows(spark, 10, i * 10)).collect()] + ["{bad"])
        drain(start_ingest(messages(spark, source), layout, None))
        lose_commit(layout, "ingest")
        lose_commit(layout, "decode-quarantine")
    drain(start_ingest(messages(spark, source), layout, None))
    assert sorted(r.vehicle_id for r in read_raw(spark, layout.ingested).collect()) == [f"V{1000 + i}" for i in range(30)]
    assert len(aside(spark, layout)) == 3


def test_a_write_that_was_cut_off_is_made_anew(spark, layout, monkeypatch):
    """Half of a batch's files lie in the tree and nothing notes them; the batch is written whole and read once."""
    put_raw(rows(spark, 1000), layout)
    write_processed(add_event_time(rows(spark, 28)), layout.enriched)
    drain(start_enrich(spark, layout, None, max_files=1000))
    drain(start_load(spark, layout, None))
    assert read_processed(spark, layout.enriched).count() == 1000
    assert read_target(spark, layout.target).count() == 1000


def test_replayed_load_batch_is_not_doubled(spark, layout, monkeypatch):
    write_processed(add_event_time(rows(spark, 50)), layout.processed)
    fail_after(monkeypatch, "upsert", 1)
    with pytest.raises(StreamingQueryException):
        start_load(spark, layout, None).awaitTermination()
    monkeypatch.undo()
    drain(start_load(spark, layout, None))
    assert read_target(spark, layout.target).count() == 50


def test_a_repeated_batch_does_not_double_the_next_stage(spark, layout, folder):
    """Ingest loses its commit after its write, enrich runs, ingest repeats the batch, enrich runs again; so does load."""
    source = f"{folder}/messages"
    put_messages(spark, source, [r.value for r in encode_events(rows(spark, 20)).collect()])
    for job in ("ingest", "enrich", None):
        drain(start_ingest(messages(spark, source), layout, None))
        drain(start_enrich(spark, layout, None))
        drain(start_load(spark, layout, None))
        if job:
            lose_commit(layout, job)
    assert read_raw(spark, layout.ingested).count() == 20
    assert read_processed(spark, layout.enriched).count() == 20
    assert read_target(spark, layout.target).count() == 20


def test_a_failing_query_stops_the_job(spark, layout, folder):
    put_messages(spark, f"{folder}/messages", ["{bad"])
    slow = messages(spark, f"{folder}/messages")
    fine = slow.writeStream.format("noop").trigger(processingTime="1 hour").start()
    failing = slow.selectExpr("raise_error('lost')").writeStream.format("noop").trigger(availableNow=True).start()
    with pytest.raises(StreamingQueryException, match="lost"):
        jobs.Job(fine, failing).awaitTermination()
    assert not fine.isActive


def test_old_files_are_read_like_new_ones(spark, layout):
    put_raw(rows(spark, 5), layout)
    drain(start_enrich(spark, layout, None))
    put_raw(rows(spark, 5, 5), layout)
    known = {r.vehicle_id for r in read_processed(spark, layout.enriched).collect()}
    month_ago = time.time() - 30 * 86_400
    for path in glob.glob(f"{layout.raw}/**/*.csv", recursive=True):
        os.utime(path, (month_ago, month_ago))
    put_raw(rows(spark, 5, 10), layout)
    drain(start_enrich(spark, layout, None))
    assert len(known) == 5 and read_processed(spark, layout.enriched).count() == 15


def test_the_latest_event_wins_in_any_order_of_loads(spark, layout):
    late, early = rows(spark, 1, speed=90.0).withColumn("timestamp", F.lit(START + 0.9)), rows(spark, 1, speed=10.0)
    for df in (late, early):
        write_processed(add_event_time(df), layout.processed)
        drain(start_load(spark, layout, None))
    assert [r.speed for r in read_target(spark, layout.target).collect()] == [90.0]
    load_full(spark, layout)
    assert [r.speed for r in read_target(spark, layout.target).collect()] == [90.0]


def test_alerts_job_writes_each_alert_once(spark, layout):
    put_raw(rows(spark, 3).union(rows(spark, 2, 3, speed=160.0, fine=1000)), layout)
    for _ in range(2):
        drain(start_alerts(spark, layout, None))
    alerts = spark.read.json(layout.alerts)
    assert {r.vehicle_id for r in alerts.collect()} == {"V1003", "V1004"} and alerts.count() == 2
    assert all("overspeeding" in r.message for r in alerts.collect())


def test_new_day_folder_is_seen_by_the_next_run(spark, layout):
    put_raw(rows(spark, 5), layout, "2024-01-01")
    drain(start_enrich(spark, layout, None))
    put_raw(rows(spark, 5, 5), layout, "2024-01-02")
    drain(start_enrich(spark, layout, None))
    assert read_processed(spark, layout.enriched).count() == 10


def test_trees_filled_by_another_tool_can_be_taken_over(spark, layout):
    day = f"{layout.raw}/year=2024/month=01/day=01"
    rows(spark, 4).coalesce(1).write.option("header", "true").csv(day)
    put_raw(rows(spark, 4, 4), layout)
    drain(start_enrich(spark, layout, None))
    plain = add_event_time(rows(spark, 4, 8)).select(*PROCESSED_SCHEMA.names)
    plain.write.mode("append").partitionBy("year", "month", "day").parquet(layout.processed)
    drain(start_load(spark, layout, None))
    assert read_target(spark, layout.target).count() == 12
    assert load_full(spark, layout) == (12, 0)


def test_late_events_go_to_their_own_day(spark, layout):
    put_raw(rows(spark, 1), layout, "2024-03-31")
    drain(start_enrich(spark, layout, None))
    row = read_processed(spark, layout.enriched).first()
    assert (row.year, row.month, row.day) == (2024, 1, 1)


def test_continuous_trigger_and_stop(spark, layout):
    put_raw(rows(spark, 5), layout)
    query = start_enrich(spark, layout, "1 second")
    query.processAllAvailable()
    put_raw(rows(spark, 5, 5), layout)
    query.processAllAvailable()
    query.stop()
    assert not query.isActive
    assert read_processed(spark, layout.enriched).count() == 10


def test_bad_messages_are_set_aside(spark, layout, folder):
    good = [r.value for r in encode_events(rows(spark, 5)).collect()]
    put_messages(spark, f"{folder}/messages", good + ["{bad", None, "[]"])
    drain(start_ingest(messages(spark, f"{folder}/messages"), layout, None))
    assert read_raw(spark, layout.ingested).count() == 5
    kept = [json.loads(r.row) for r in aside(spark, layout)]
    assert sorted((r["reason"], str(r["value"])) for r in kept) == [
        ("malformed_json", "[]"), ("malformed_json", "{bad"), ("null_value", "None"),
    ]


def test_batch_of_bad_messages_only(spark, layout, folder):
    put_messages(spark, f"{folder}/messages", ["{bad"] * 3)
    drain(start_ingest(messages(spark, f"{folder}/messages"), layout, None))
    assert len(aside(spark, layout)) == 3
    assert not glob.glob(f"{layout.ingested}/**/*.csv", recursive=True)


def test_bad_lines_and_broken_contract_are_set_aside(spark, layout):
    put_raw(rows(spark, 3).union(rows(spark, 2, 3, speed=500.0)), layout)
    drain(start_enrich(spark, layout, None, enforce_contract=True))
    assert read_processed(spark, layout.enriched).count() == 3
    assert {tuple(json.loads(r.row)["reasons"]) for r in aside(spark, layout)} == {("speed", "fine")}


def test_rows_without_a_key_are_set_aside_once(spark, layout):
    df = rows(spark, 4).withColumn("timestamp", F.when(F.col("vehicle_id") > "V1000", F.col("timestamp")))
    write_processed(add_event_time(df), layout.processed)
    drain(start_load(spark, layout, None))
    load_full(spark, layout)
    load_full(spark, layout)
    assert read_target(spark, layout.target).count() == 3
    runs = {r.run for r in spark.read.parquet(layout.set_aside("load")).collect()}
    assert len(aside(spark, layout)) == 2 and len(runs) == 2


def test_load_full_reloads_everything(spark, layout):
    write_processed(add_event_time(rows(spark, 6)), layout.processed)
    drain(start_load(spark, layout, None))
    run = at("2030-01-01")
    assert load_full(spark, layout, F.lit(run)) == (6, 0)
    assert {r.last_updated for r in read_target(spark, layout.target).collect()} == {run}


def test_load_full_without_input(spark, layout):
    assert load_full(spark, layout) == (0, 0)
    assert load_full(spark, Layout(f"{layout.root}/elsewhere")) == (0, 0)


def test_incremental_load_leaves_loaded_rows_alone(spark, layout):
    write_processed(add_event_time(rows(spark, 3)), layout.processed)
    drain(start_load(spark, layout, None))
    first = {r.vehicle_id: r.last_updated for r in read_target(spark, layout.target).collect()}
    write_processed(add_event_time(rows(spark, 3, 3)), layout.processed)
    drain(start_load(spark, layout, None))
    both = {r.vehicle_id: r.last_updated for r in read_target(spark, layout.target).collect()}
    assert len(both) == 6 and first.items() <= both.items()


def test_full_run_twice(spark, layout, folder):
    source = f"{folder}/messages"
    put_messages(spark, source, [r.value for r in encode_events(rows(spark, 30)).collect()])
    run_available(spark, layout, messages(spark, source))
    put_messages(spark, source, [r.value for r in encode_events(rows(spark, 30, 20, speed=99.0)).collect()])
    run_available(spark, layout, messages(spark, source))
    target = read_target(spark, layout.target)
    assert target.count() == 50 == target.select(*KEY_COLS).distinct().count()
    assert target.where("speed = 99").count() == 30


def test_alerts_on_a_stream(spark, layout):
    put_raw(rows(spark, 3).union(rows(spark, 2, 3, speed=160.0, fine=1000)), layout)
    alerts = overspeed_alerts(raw_stream(spark, layout.raw))
    query = alerts.writeStream.format("memory").queryName("alerts").trigger(availableNow=True).start()
    drain(query)
    assert {r.vehicle_id for r in spark.table("alerts").collect()} == {"V1003", "V1004"}


def test_the_audit_table_has_every_batch_once(spark, layout, folder):
    source = f"{folder}/messages"
    for i in range(3):
        put_messages(spark, source, [r.value for r in encode_events(rows(spark, 10, i * 10)).collect()] + ["{bad"] * i)
    with audited(spark, layout.audit):
        drain(start_ingest(messages(spark, source), layout, None))
        drain(start_enrich(spark, layout, None, enforce_contract=True))
        lose_commit(layout, "enrich")
        drain(start_enrich(spark, layout, None, enforce_contract=True))
    noted = read_audit(spark, layout.audit).collect()
    ingested = sorted(((r.rows_in, r["rows"], r.left_out) for r in noted if r.job == "ingest"))
    assert ingested == [(10, 10, 0), (11, 10, 1), (12, 10, 2)]
    assert [(r.rows_in, r["rows"], r.left_out) for r in noted if r.job == "enrich"] == [(30, 30, 0)]
    assert len({(r.query_id, r.batch) for r in noted}) == len(noted)
    put_raw(rows(spark, 4), layout)
    drain(start_enrich(spark, layout, None))  # outside of the block nothing is noted
    assert read_audit(spark, layout.audit).count() == len(noted)


def test_ingest_keeps_extra_fields_and_offsets(spark, layout, folder):
    sent = [r.value for r in encode_events(rows(spark, 20)).collect()]
    made = [("t", i % 2, i // 2 + (5 if i >= 10 else 0), '{"colour":"red",' + v[1:] if i < 3 else v) for i, v in enumerate([*sent, "{bad"])]
    schema = "topic string, partition int, offset bigint, value string"
    for i in range(0, 21, 7):
        spark.createDataFrame(made[i : i + 7], schema).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/topic")
    for _ in range(2):
        drain(start_ingest(stream, layout, None, keep_extras=True, keep_offsets=True))
        lose_commit(layout, "offsets")
        lose_commit(layout, "extras")
    kept = spark.read.parquet(layout.extras).select("vehicle_id", F.to_json("extras").alias("e")).collect()
    assert sorted(tuple(r) for r in kept) == [(f"V{1000 + i}", '{"colour":"red"}') for i in range(3)]
    assert read_raw(spark, layout.ingested).count() == 20 and len(aside(spark, layout)) == 1
    found = findings(read_offsets(spark, layout), ["topic", "partition"]).collect()
    assert sorted((r.partition, r.kind, r["first"], r["last"]) for r in found) == [(0, "skipped", 5, 9), (1, "skipped", 5, 9)]


def age(layout, days):
    """Let time pass for all files of the job's own trees."""
    for path in glob.glob(f"{layout.ingested}/**/*.csv", recursive=True):
        os.utime(path, (os.stat(path).st_mtime - days * 86_400,) * 2)


def test_own_trees_are_read_once_over_many_days(spark, layout, folder):
    """Names are remembered for a week; days pass between runs, and once the reader pauses for months."""
    source = f"{folder}/messages"
    for run in range(5):
        put_messages(spark, source, [r.value for r in encode_events(rows(spark, 6, run * 6)).collect()])
        drain(start_ingest(messages(spark, source), layout, None, rows_per_file=2))
        if run not in (2, 3):
            drain(start_enrich(spark, layout, None, max_files=1))
        age(layout, 30)
    drain(start_enrich(spark, layout, None, max_files=1))
    got = [r.vehicle_id for r in read_processed(spark, layout.enriched).collect()]
    assert sorted(got) == sorted(f"V{1000 + i}" for i in range(30))

"""Loads by digest and bucket against a dictionary; what they read, write and report."""

import datetime as dt
import glob

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import event
from roadlake.functions.event_time import add_event_time, stamp
from roadlake.operators import changes as module
from roadlake.operators.changes import Changed, apply_changes, read_feed, read_keyed
from roadlake.schema import EVENT_SCHEMA, KEY_COLS, TARGET_SCHEMA
from roadlake.session import scratch_path
from test_storage import DAY, START, plan_line
from test_upsert import explain

RUN = dt.datetime(2024, 6, 1)


def load(spark, rows, run=RUN):
    return stamp(add_event_time(spark.createDataFrame(rows, EVENT_SCHEMA)), F.lit(run))


def files(path):
    return sorted(glob.glob(f"{path}/year=*/month=*/day=*/bucket=*/*.parquet"))


def speeds(spark, path):
    rows = read_keyed(spark, path).collect()
    out = {(r.vehicle_id, r.event_time): r.speed for r in rows}
    assert len(out) == len(rows)
    return out


def put(spark, folder, rows, run, **options):
    return apply_changes(load(spark, rows), f"{folder}/table", f"{folder}/feed", run, **options)


def test_each_row_is_told_what_it_did(spark, folder):
    first = [event(f"V{i}", START + d * DAY) for i in range(20) for d in range(3)]
    assert put(spark, folder, first, "1") == Changed(60, 0, 0, 0, len({f.rsplit("/", 1)[0] for f in files(f"{folder}/table")}))
    second = [event("V1", START, speed=1.0), event("V2", START), event("V99", START + DAY), event("V99", START + DAY, speed=2.0)]
    done = put(spark, folder, second, "2")
    assert done[:4] == (1, 1, 1, 0)
    feed = read_feed(spark, f"{folder}/feed").where("run = '2'").collect()
    assert {(r.vehicle_id, r.change) for r in feed} == {("V1", "updated"), ("V99", "inserted")}
    got = speeds(spark, f"{folder}/table")
    assert len(got) == 61 and read_keyed(spark, f"{folder}/table").columns == TARGET_SCHEMA.names


def test_a_load_without_changes_writes_no_file(spark, folder):
    rows = [event(f"V{i}", START + i * DAY) for i in range(8)]
    put(spark, folder, rows, "1")
    before = files(f"{folder}/table")
    again = apply_changes(load(spark, rows, dt.datetime(2025, 1, 1)), f"{folder}/table", f"{folder}/feed", "2")
    assert again == Changed(0, 0, 8, 0, 0) and files(f"{folder}/table") == before
    assert {r.last_updated for r in read_keyed(spark, f"{folder}/table").collect()} == {RUN}
    assert read_feed(spark, f"{folder}/feed").where("run = '2'").isEmpty()


def test_only_folders_with_changes_are_written(spark, folder):
    put(spark, folder, [event(f"V{i}", START) for i in range(400)], "1", buckets=32)
    before = files(f"{folder}/table")
    done = put(spark, folder, [event(f"V{i}", START) for i in range(200)] + [event("V300", START, speed=1.0)], "2", buckets=32)
    assert done == Changed(0, 1, 200, 0, 1)
    assert len(set(before) - set(files(f"{folder}/table"))) == 1
    assert sum(s == 1.0 for s in speeds(spark, f"{folder}/table").values()) == 1 and len(speeds(spark, f"{folder}/table")) == 400


def test_a_step_opens_the_listed_folders_and_shuffles_no_row_that_stays(spark, folder, monkeypatch):
    put(spark, folder, [event(f"V{i}", START + d * DAY) for i in range(40) for d in range(3)], "1")
    whole = module.table_schema()
    table = spark.read.schema(whole).parquet(f"{folder}/table")
    some = [r.f for r in table.select(module._folder().alias("f")).distinct().limit(2).collect()]
    filters = plan_line(module._of(table, some), "PartitionFilters")
    assert all(name in filters for name in some)
    narrow = module._outcomes(module._of(table, some), module._of(table, some), KEY_COLS, ["timestamp"], True)
    read = plan_line(narrow, "ReadSchema")
    assert read.count("number_plate") == 1 and read.count(module.DIGEST) == 2
    plans = []
    monkeypatch.setattr(module, "_by_folder", lambda df, *_: plans.append(df) or type("W", (), {"parquet": lambda *_: None}))
    module._rewrite(module._of(table, some).withColumn("change", F.lit("updated")), module._of(table, some), KEY_COLS, folder)
    plan = explain(plans[0])
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_many_folders_are_taken_step_by_step(spark, folder):
    rows = [event(f"V{i}", START + i * DAY) for i in range(7)]
    assert put(spark, folder, rows, "1", listed=2)[:4] == (7, 0, 0, 0)
    assert put(spark, folder, [*rows[:5], event("V6", START + 6 * DAY, speed=1.0)], "2", listed=3) == Changed(0, 1, 5, 0, 1)
    assert read_feed(spark, f"{folder}/feed").count() == 8


def test_changed_keys_beyond_a_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_BYTES", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        put(spark, folder, [event(f"V{i}", START) for i in range(30)], "1")
        assert put(spark, folder, [event(f"V{i}", START, speed=1.0) for i in range(10)], "2")[:2] == (0, 10)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(speeds(spark, f"{folder}/table").values()).count(1.0) == 10


def test_rows_without_a_key(spark, folder):
    rows = [event(None, START), event("V1", None), event("V2", START)]
    with pytest.raises(ValueError, match="null in vehicle_id"):
        put(spark, folder, rows, "1")
    handed = []
    assert put(spark, folder, rows, "1", on_unkeyed=lambda df: handed.append(df.count()))[0] == 1
    assert handed == [2]
    with pytest.raises(ValueError, match="event_time"):
        put(spark, folder, rows, "1", keys=["vehicle_id"])


def test_no_rows(spark, folder):
    assert put(spark, folder, [], "1") == Changed(0, 0, 0, 0, 0)
    assert read_keyed(spark, f"{folder}/table").isEmpty() and read_feed(spark, f"{folder}/feed").isEmpty()
    assert read_keyed(spark, f"{folder}/nowhere").isEmpty()


def test_a_repeated_run_keeps_what_it_has_noted(spark, folder):
    put(spark, folder, [event("V1", START)], "1")
    for _ in range(2):
        put(spark, folder, [event("V1", START, speed=1.0)], "2")
    assert sorted((r.run, r.change) for r in read_feed(spark, f"{folder}/feed").collect()) == [("1", "inserted"), ("2", "updated")]


def test_a_load_cut_off_before_it_rewrites_is_finished_by_its_repetition(spark, folder, monkeypatch):
    put(spark, folder, [event(f"V{i}", START) for i in range(20)], "1")
    load_ = [event(f"V{i}", START, speed=1.0) for i in range(5)] + [event("V77", START)]
    monkeypatch.setattr(module, "_rewrite", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        put(spark, folder, load_, "2")
    monkeypatch.undo()
    assert put(spark, folder, load_, "2")[:4] == (1, 5, 0, 0)
    noted = read_feed(spark, f"{folder}/feed").where("run = '2'").collect()
    assert len(noted) == 6 and len(speeds(spark, f"{folder}/table")) == 21


def test_rows_are_brought_together_by_folder_once(spark, folder, monkeypatch):
    by_folder, moved = module._by_folder, []
    monkeypatch.setattr(module, "_by_folder", lambda rows, *how: (moved.append(rows.count()), by_folder(rows, *how))[1])
    rows = [event(f"V{i}", START + i % 3 * DAY) for i in range(60)]
    assert put(spark, folder, rows, "1", buckets=2)[:4] == (60, 0, 0, 0) and sum(moved) == 60
    moved.clear()
    assert put(spark, folder, rows, "2", buckets=2)[:4] == (0, 0, 60, 0) and sum(moved) == 0
    assert len(speeds(spark, f"{folder}/table")) == 60


def test_the_exchange_that_dedupes_serves_the_comparison(spark, folder):
    rows = [event(f"V{i}", START) for i in range(20)]
    put(spark, folder, rows, "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incoming = module.split_on_null(load(spark, rows), KEY_COLS)[0]
        fresh = module.dedupe_keyed(module._with_folder(incoming, KEY_COLS, 16), KEY_COLS, ["timestamp", module.DIGEST])
        plan = explain(module._outcomes(fresh, module._table(spark, f"{folder}/table", module.table_schema()), KEY_COLS, ["timestamp"], False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_whole_rows_cross_one_exchange_and_are_not_sorted_before(spark, folder):
    rows = [event(f"V{i}", START) for i in range(20)]
    put(spark, folder, rows, "1")
    current = module._table(spark, f"{folder}/table", module.table_schema())
    incoming = module._with_folder(module.split_on_null(load(spark, rows), KEY_COLS)[0], KEY_COLS, 16)
    plan = explain(module._outcomes(incoming, current, KEY_COLS, ["timestamp"], False, module.FOLDER_COLS)).splitlines()
    plan = plan[: next((n for n, line in enumerate(plan) if not line.strip()), len(plan))]
    exchanges = [n for n, line in enumerate(plan) if "Exchange" in line]
    assert len(exchanges) == 1 and any("Aggregate" in line for line in plan[: exchanges[0]])
    assert not any("Aggregate" in line or "Sort" in line for line in plan[exchanges[0]:])


def test_a_load_without_changes_moves_keys_and_digests_only(spark, folder, monkeypatch):
    rows = [event(f"V{i}", START + i % 3 * DAY) for i in range(30)]
    put(spark, folder, rows, "1")
    monkeypatch.setattr(module, "_note", lambda *_: pytest.fail("whole rows were read"))
    assert put(spark, folder, rows, "2") == Changed(0, 0, 30, 0, 0)


def test_whole_rows_are_read_of_folders_with_a_change(spark, folder, monkeypatch):
    put(spark, folder, [event(f"V{i}", START + i % 3 * DAY) for i in range(30)], "1", buckets=1)
    note, noted = module._note, []
    monkeypatch.setattr(module, "_note", lambda found, *how: (noted.append(found.count()), note(found, *how))[1])
    second = [event(f"V{i}", START + i % 3 * DAY, speed=1.0 if i == 4 else 80.0) for i in range(30)] + [event("V1", START + 5 * DAY)]
    assert put(spark, folder, second, "2", buckets=1) == Changed(1, 1, 29, 0, 2)
    assert noted == [11] and len(speeds(spark, f"{folder}/table")) == 31


def test_a_large_folder_is_cut_by_key(spark, folder, monkeypatch):
    monkeypatch.setattr(module, "CUT_ROWS", 10)
    rows = [event(f"V{i}", START) for i in range(35)] + [event(f"V{i}", START + DAY) for i in range(10)]
    assert put(spark, folder, [*rows, *rows], "1", buckets=1) == Changed(45, 0, 0, 0, 2)
    assert put(spark, folder, [*rows, *rows], "2", buckets=1)[:4] == (0, 0, 45, 0)
    assert put(spark, folder, [event(f"V{i}", START, speed=1.0) for i in range(40)], "3", buckets=1)[:4] == (5, 35, 0, 0)
    assert sorted(speeds(spark, f"{folder}/table").values()) == [1.0] * 40 + [80.0] * 10


def test_keys_that_come_often_are_reduced_before_they_are_sent(spark, folder, monkeypatch):
    monkeypatch.setattr(module, "REPEATED_ROWS", 20)
    dedupe, reduced = module.dedupe_keyed, []
    monkeypatch.setattr(module, "dedupe_keyed", lambda *how: (reduced.append(1), dedupe(*how))[1])
    assert put(spark, folder, [event(f"V{i}", START) for i in range(30)], "1", buckets=1)[0] == 30 and not reduced
    often = [event("V1", START + n / 100, speed=float(n)) for n in range(60)] + [event("V2", START)]
    assert put(spark, folder, often, "2", buckets=1)[:4] == (0, 1, 1, 0) and reduced
    assert {k[0]: s for k, s in speeds(spark, f"{folder}/table").items()}["V1"] == 59.0


def test_a_source_that_changes_its_outcomes_is_refused(spark, folder, monkeypatch):
    put(spark, folder, [event("V1", START)], "1", buckets=1)
    recount = module._recount
    monkeypatch.setattr(module, "_recount", lambda *how: {f: c + module.Counter({"updated": 1}) for f, c in recount(*how).items()})
    with pytest.raises(RuntimeError, match="other rows"):
        put(spark, folder, [event("V1", START, speed=1.0)], "2", buckets=1)
    assert set(speeds(spark, f"{folder}/table").values()) == {80.0}


def test_steps_hold_as_many_updated_keys_as_a_broadcast_takes(monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_BYTES", 10)
    assert list(module._steps({"d": 0, "a": 4, "c": 30, "b": 6}, 100)) == [["a", "b"], ["c"], ["d"]]
    assert list(module._steps({"a": 0, "b": 0, "c": 0}, 2)) == [["a", "b"], ["c"]] and not list(module._steps({}, 2))


def test_a_source_that_changes_its_folders_is_refused(spark, folder, monkeypatch):
    put(spark, folder, [event(f"V{i}", START) for i in range(5)], "1")
    monkeypatch.setattr(module, "_changed_folders", lambda *_: {"2099/1/1/0": 0})
    with pytest.raises(RuntimeError, match="other rows"):
        put(spark, folder, [event("V1", START, speed=1.0)], "2")
    assert set(speeds(spark, f"{folder}/table").values()) == {80.0}


def test_counts_of_a_load_without_changes_come_from_keys_and_digests(spark, folder, monkeypatch):
    put(spark, folder, [event("V1", START + 0.5), event("V2", START + 0.5), event("V3", START + DAY)], "1")
    outcomes, compared = module._outcomes, []
    monkeypatch.setattr(module, "_outcomes", lambda fresh, *rest: (compared.append(fresh.columns), outcomes(fresh, *rest))[1])
    older = [event("V1", START + 0.1, speed=9.0), event("V2", START + 0.5), event("V2", START + 0.5), event("V3", START + DAY)]
    assert put(spark, folder, older, "2", keep_newer=True) == Changed(0, 0, 2, 1, 0)
    assert "number_plate" in compared[0] and sorted(compared[-1]) == sorted([*KEY_COLS, "timestamp", module.DIGEST])


def test_a_feed_is_shuffled_only_for_runs_that_were_repeated(spark, folder):
    put(spark, folder, [event(f"V{i}", START) for i in range(9)], "1")

    def final_plan():
        feed = read_feed(spark, f"{folder}/feed").where("run = '1'")
        assert len(feed.collect()) == 9
        return feed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    assert "vehicle_id" not in "".join(l for l in final_plan().splitlines() if "hashpartitioning" in l)
    noted = spark.read.parquet(glob.glob(f"{folder}/feed/run=1/attempt=*")[0])
    noted.write.partitionBy(*module.FOLDER_COLS).parquet(f"{folder}/feed/run=1/attempt=lost")
    assert "vehicle_id" in "".join(l for l in final_plan().splitlines() if "hashpartitioning" in l)


def test_a_feed_without_attempts_is_read(spark, folder):
    put(spark, folder, [event(f"V{i}", START) for i in range(9)], "1")
    noted = spark.read.parquet(glob.glob(f"{folder}/feed/run=1/attempt=*")[0])
    noted.unionByName(noted).write.parquet(f"{folder}/old/run=1")
    assert read_feed(spark, f"{folder}/old").count() == 9


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("ABC"), st.sampled_from([0.1, 0.5, 0.9]), st.integers(1, 3)), min_size=1, max_size=8, unique_by=lambda r: r[:2]
    ),
    cut=st.integers(0, 8), newer=st.booleans(),
)
def test_any_split_gives_one_table(spark, rows, cut, newer):
    """With ``keep_newer`` neither the order nor the split of loads matters; without it the last load has its way."""
    events = [event(v, START + t, speed=float(s)) for v, t, s in rows]
    results = []
    for parts in ([events], [events[:cut], events[cut:]], [events[cut:], events[:cut]]):
        folder = scratch_path(spark, "any-split")
        for n, part in enumerate(parts):
            put(spark, folder, part, str(n), keep_newer=newer, buckets=2)
        results.append({k: (r.speed, r.timestamp) for k, r in (((r.vehicle_id, r.event_time), r) for r in read_keyed(spark, f"{folder}/table").collect())})
    if newer:
        assert results[0] == results[1] == results[2]
    assert {k[0] for k in results[0]} == {v for v, _, _ in rows}
    for vehicle, (speed, at) in ((k[0], v) for k, v in results[0].items()):
        assert at == max(START + t for v, t, _ in rows if v == vehicle)
        assert (vehicle, round(at - START, 1), speed) in {(v, t, float(s)) for v, t, s in rows}


def test_a_correction_with_the_same_time_lands_and_an_older_row_does_not(spark, folder):
    put(spark, folder, [event("V1", START + 0.5, speed=5.0), event("V2", START + 0.5, speed=5.0)], "1")
    done = put(spark, folder, [event("V1", START + 0.5, speed=4.0), event("V2", START + 0.1, speed=9.0)], "2", keep_newer=True)
    assert done[:4] == (0, 1, 0, 1)
    assert {k[0]: s for k, s in speeds(spark, f"{folder}/table").items()} == {"V1": 4.0, "V2": 5.0}

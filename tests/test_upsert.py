"""Dedupe and upsert: semantics, idempotence, locality, recovery."""

import datetime as dt
import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import event
from roadlake.functions.event_time import add_event_time, stamp
from roadlake.operators import upsert as module
from roadlake.operators.dedupe import dedupe_latest
from roadlake.operators.merge import merge_table
from roadlake.operators.upsert import Touch, create_target, finish_interrupted, merge, read_target, stage, upsert
from roadlake.schema import EVENT_SCHEMA, KEY_COLS, TARGET_SCHEMA
from roadlake.session import scratch_path
from test_storage import DAY, START, plan_line

RUN = dt.datetime(2024, 6, 1)


def load(spark, rows, run=RUN):
    return stamp(add_event_time(spark.createDataFrame(rows, EVENT_SCHEMA)), F.lit(run))


def table(spark, path):
    """Target rows by key."""
    rows = read_target(spark, path).collect()
    return {(r.vehicle_id, str(r.event_time)): r for r in rows}, len(rows)


def files_by_day(path):
    return {d: sorted(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/year=*/month=*/day=*")}


def explain(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_create_target_keeps_what_is_there(spark, folder):
    create_target(spark, folder)
    assert read_target(spark, folder).schema == TARGET_SCHEMA and read_target(spark, folder).isEmpty()
    upsert(load(spark, [event()]), folder)
    create_target(spark, folder)
    assert read_target(spark, folder).count() == 1


def test_match_overwrites_every_column_and_the_rest_is_kept(spark, folder):
    assert upsert(load(spark, [event("V1", START), event("V2", START)]), folder) == (2, 0)
    later = dt.datetime(2024, 7, 1)
    changed = [event("V2", START + 0.5, speed=None, vehicle_name="Kia Seltos"), event("V3", START)]
    assert upsert(load(spark, changed, later), folder) == (2, 1)
    rows, n = table(spark, folder)
    assert n == 3
    kept, updated, new = (rows[(v, "2024-01-01 00:00:00")] for v in ("V1", "V2", "V3"))
    assert kept.last_updated == RUN and kept.speed == 80.0
    assert updated.speed is None and updated.vehicle_name == "Kia Seltos" and updated.last_updated == later
    assert new.last_updated == later


def test_column_the_source_lacks_becomes_null(spark, folder):
    upsert(load(spark, [event()]), folder)
    upsert(load(spark, [event()]).drop("user_id"), folder)
    rows, n = table(spark, folder)
    assert n == 1 and next(iter(rows.values())).user_id is None


def test_missing_key_column_is_refused(spark, folder):
    with pytest.raises(ValueError, match="vehicle_id"):
        upsert(load(spark, [event()]).drop("vehicle_id"), folder)


def test_latest_source_row_wins(spark, folder):
    rows = [event("V1", START + f, speed=s) for f, s in [(0.1, 30.0), (0.9, 50.0), (0.5, 40.0)]]
    assert upsert(load(spark, rows), folder) == (1, 0)
    assert table(spark, folder)[0][("V1", "2024-01-01 00:00:00")].speed == 50.0


def test_null_keys_match_nothing(spark, folder):
    source = load(spark, [event(None, START), event("V1", None), event("V1", START)])
    upsert(source, folder)
    upsert(source, folder)
    assert table(spark, folder)[1] == 5


def test_empty_source_changes_nothing(spark, folder):
    upsert(load(spark, [event()]), folder)
    before = files_by_day(folder)
    assert upsert(load(spark, [event()]).where("speed < 0"), folder) == (0, 0)
    assert files_by_day(folder) == before


def test_untouched_days_keep_their_files(spark, folder):
    upsert(load(spark, [event(f"V{i}", START + d * DAY) for d in range(10) for i in range(5)]), folder)
    before = files_by_day(folder)
    upsert(load(spark, [event("V1", START + 3 * DAY), event("V9", START + 3 * DAY)]), folder)
    after = files_by_day(folder)
    assert [d for d in before if before[d] != after[d]] == [f"{folder}/year=2024/month=1/day=4"]
    assert table(spark, folder)[1] == 51


def touching(days):
    return Touch(days=days, key_bytes=100, whole=True)


def test_unkeyed_rows_are_handed_over(spark, folder, monkeypatch):
    handed = []
    source = load(spark, [event(None, START), event("V1", None), event(None, START + DAY), event("V1", START)])
    for limit in (1000, 1):
        monkeypatch.setattr(module, "LISTED_PARTITIONS", limit)
        upsert(source, folder, on_unkeyed=lambda df: handed.append(df.count()))
    assert handed == [3, 3] and table(spark, folder)[1] == 1
    upsert(load(spark, [event("V2", START)]), folder, on_unkeyed=lambda df: handed.append(df.count()))
    assert sum(handed) == 6 and table(spark, folder)[1] == 2
    only = load(spark, [event(None, START)])
    monkeypatch.setattr(module, "LISTED_PARTITIONS", 1000)
    assert upsert(only, folder, on_unkeyed=lambda df: handed.append(df.count())) == (0, 0)


def test_only_touched_days_are_read(spark, folder):
    upsert(load(spark, [event("V1", START + d * DAY) for d in range(10)]), folder)
    source, target = load(spark, [event("V1", START + 3 * DAY)]), read_target(spark, folder)
    one_day = merge(source, target, KEY_COLS, ["timestamp"], touching(["2024/1/4"]))
    filters = plan_line(one_day, "PartitionFilters")
    assert "year" in filters and "day" in filters and "2024/1/4" in filters
    plan = explain(one_day)
    assert "REBALANCE" not in plan and "BroadcastHashJoin" in plan
    days = [f"2024/1/{d}" for d in range(1, 10)]
    many = explain(merge(source, target, KEY_COLS, ["timestamp"], touching(days)))
    assert "REBALANCE_PARTITIONS_BY_COL" in many


def test_keys_are_broadcast_only_when_measured_small(spark, folder, monkeypatch):
    upsert(load(spark, [event("V1", START), event("V2", START)]), folder)
    monkeypatch.setattr(module, "BROADCAST_BYTES", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source, target = load(spark, [event("V1", START)]), read_target(spark, folder)
        plan = explain(merge(source, target, KEY_COLS, ["timestamp"], next(module._touched_slices(source, KEY_COLS, 1000))))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert upsert(source, folder) == (1, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_new_days_need_no_join(spark, folder):
    upsert(load(spark, [event("V1", START)]), folder)
    source = load(spark, [event("V1", START + DAY)])
    merged = merge(source, read_target(spark, folder), KEY_COLS, ["timestamp"], next(module._touched_slices(source, KEY_COLS, 1000)))
    assert "Join" not in explain(merged)


def test_more_days_than_can_be_listed(spark, folder, monkeypatch):
    rows = [event("V1", START + d * DAY) for d in range(8)]
    upsert(load(spark, rows + [event("V2", START + 20 * DAY)]), folder)
    before = files_by_day(folder)
    monkeypatch.setattr(module, "LISTED_PARTITIONS", 2)
    assert upsert(load(spark, rows[:5] + [event("V3", START)]), folder) == (6, 0)
    after = files_by_day(folder)
    assert table(spark, folder)[1] == 10
    assert sum(before[d] == after[d] for d in before) == 4


def test_slices_read_touched_days_only(spark, folder, monkeypatch):
    upsert(load(spark, [event("V1", START + d * DAY) for d in range(10)]), folder)
    monkeypatch.setattr(module, "LISTED_PARTITIONS", 2)
    source = load(spark, [event("V1", START + d * DAY) for d in range(5)])
    slices = list(module._touched_slices(source, KEY_COLS, 2))
    assert [len(t.days) for t in slices] == [2, 2, 1] and not any(t.whole for t in slices)
    for touch in slices:
        filters = plan_line(merge(source, read_target(spark, folder), KEY_COLS, ["timestamp"], touch), "PartitionFilters")
        assert all(day in filters for day in touch.days)


def test_a_source_in_slices_is_read_twice(spark, folder):
    """Once for its keys and once to be written by day, however many slices there are."""
    reads = spark.sparkContext.accumulator(0)
    rows = [event("V1", START + d * DAY) for d in range(9)]
    upsert(load(spark, rows), folder)
    noted = F.udf(lambda v: reads.add(1) or v)
    source = load(spark, rows).withColumn("vehicle_name", noted(F.lit("new").substr(F.lit(1), F.length("vehicle_name"))))
    assert upsert(source, folder, slice_days=2)[0] == 9
    assert {r.vehicle_name for r in table(spark, folder)[0].values()} == {"new"}
    assert reads.value <= 2 * len(rows)


def test_keys_without_event_time_are_refused(spark, folder):
    with pytest.raises(ValueError, match="event_time"):
        upsert(load(spark, [event()]), folder, keys=["vehicle_id"])


def test_later_row_of_the_table_stays_when_asked_for(spark, folder):
    old, new = event("V1", START + 0.1, speed=10.0), event("V1", START + 0.9, speed=90.0)
    upsert(load(spark, [new, event("V2", START, speed=1.0)]), folder)
    upsert(load(spark, [old, event("V2", START, speed=2.0)]), folder, keep_newer=True)
    speeds = {k[0]: r.speed for k, r in table(spark, folder)[0].items()}
    assert speeds == {"V1": 90.0, "V2": 2.0}
    upsert(load(spark, [old]), folder)
    assert table(spark, folder)[0][("V1", "2024-01-01 00:00:00")].speed == 10.0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from([0.1, 0.5, None]), st.integers(1, 3)), min_size=1, max_size=6),
    cuts=st.lists(st.integers(0, 6), min_size=1, max_size=2),
    order=st.randoms(use_true_random=False),
)
def test_any_split_and_order_of_loads_gives_one_table(spark, rows, cuts, order):
    events = [event(v, None if t is None else START + t, speed=float(s)) for v, t, s in rows]
    keyed = [e for e, (_, t, _) in zip(events, rows) if t is not None]
    bounds = sorted({0, len(keyed), *[c for c in cuts if c < len(keyed)]})
    parts = [keyed[a:b] for a, b in zip(bounds, bounds[1:])]
    order.shuffle(parts)
    one, many = scratch_path(spark, "one"), scratch_path(spark, "many")
    if keyed:
        upsert(load(spark, keyed), one, keep_newer=True)
    for part in parts:
        upsert(load(spark, part), many, keep_newer=True)
    values = lambda path: {k: (r.speed, r.timestamp) for k, r in table(spark, path)[0].items()}
    assert values(one) == values(many)


def test_date_parts_always_follow_the_event_time(spark, folder):
    upsert(load(spark, [event()]).withColumn("year", F.lit(1999)), folder)
    upsert(load(spark, [event()]), folder)
    assert table(spark, folder)[1] == 1


def test_stage_fixes_values(spark, folder):
    staged = stage(load(spark, [event(f"V{i}") for i in range(20)]).withColumn("speed", F.rand()), folder)
    assert sorted(r.speed for r in staged.collect()) == sorted(r.speed for r in staged.collect())
    assert staged.columns == TARGET_SCHEMA.names


class Stop(Exception):
    pass


@pytest.mark.parametrize("swapped", [False, True])
def test_journal_finishes_an_interrupted_swap(spark, folder, monkeypatch, swapped):
    journal = scratch_path(spark, "journal")
    upsert(load(spark, [event("V1", START), event("V2", START)]), folder, journal=journal)

    swap = module._swap_partitions

    def interrupted(rows, path):
        if swapped:
            swap(rows, path)
        raise Stop

    monkeypatch.setattr(module, "_swap_partitions", interrupted)
    with pytest.raises(Stop):
        upsert(load(spark, [event("V2", START, speed=99.0)]), folder, journal=journal)
    monkeypatch.undo()
    if not swapped:
        # The worst case: the old folder is gone and the new one never arrived.
        for f in glob.glob(f"{folder}/year=2024/month=1/day=1/*.parquet"):
            os.remove(f)

    finish_interrupted(spark, journal)
    rows, n = table(spark, folder)
    assert n == 2 and rows[("V2", "2024-01-01 00:00:00")].speed == 99.0
    upsert(load(spark, [event("V3", START)]), folder, journal=journal)
    assert table(spark, folder)[1] == 3


def test_journal_ignores_a_merge_that_was_not_completed(spark, folder, monkeypatch):
    journal = scratch_path(spark, "journal")
    upsert(load(spark, [event("V1", START)]), folder, journal=journal)

    def interrupted(*_):
        raise Stop

    monkeypatch.setattr(module, "_note", interrupted)
    with pytest.raises(Stop):
        upsert(load(spark, [event("V1", START, speed=99.0)]), folder, journal=journal)
    monkeypatch.undo()
    finish_interrupted(spark, journal)
    assert table(spark, folder)[0][("V1", "2024-01-01 00:00:00")].speed == 80.0


def test_journal_keeps_nothing_of_an_earlier_run(spark, folder):
    journal = scratch_path(spark, "journal")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        upsert(load(spark, [event("V1", START)]), folder, journal=journal)
        upsert(load(spark, [event("V1", START, speed=30.0)]), folder)
        upsert(load(spark, [event("V1", START + DAY)]), folder, journal=journal)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    rows, n = table(spark, folder)
    assert n == 2 and rows[("V1", "2024-01-01 00:00:00")].speed == 30.0


def test_dedupe_combines_each_key_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = explain(dedupe_latest(df, ["user_id"], ["ts"]))
    assert 0 < plan.index("Exchange hashpartitioning(user_id") < plan.index("partial_max")


def test_dedupe_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", None, 9), ("a", 1.0, None), ("a", 1.0, 3), ("b", None, 1), ("b", None, 2)], "k string, t double, x int"
    )
    assert sorted(map(tuple, dedupe_latest(df, ["k"], ["t"]).collect())) == [("a", 1.0, 3), ("b", None, 2)]


def test_dedupe_takes_nan_for_no_time(spark):
    df = spark.createDataFrame([("a", float("nan"), 1), ("a", 5.0, 2), ("b", float("nan"), 3), ("b", None, 4)], "k string, t double, n int")
    got = sorted((r.k, r.n) for r in dedupe_latest(df, ["k"], ["t"]).collect())
    assert got[0] == ("a", 2) and len(got) == 2


def test_dedupe_keeps_every_row_without_a_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, t int")
    assert sorted(map(str, map(tuple, dedupe_latest(df, ["k"], ["t"]).collect()))) == [
        "('a', 2)", "(None, 1)", "(None, 1)",
    ]


keys = st.tuples(st.integers(1, 4), st.integers(0, 3), st.integers(0, 2))
loads = st.lists(st.tuples(keys, st.floats(20, 200, width=32)), min_size=1, max_size=12)


def rows_of(generated):
    return [event(f"V{v}", START + d * DAY + s + 0.25, speed=x) for (v, d, s), x in generated]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=loads, second=loads)
def test_upsert_against_a_dictionary(spark, first, second):
    path = scratch_path(spark, "property")
    upsert(load(spark, rows_of(first)), path)
    upsert(load(spark, rows_of(second)), path)
    once = sorted(map(tuple, read_target(spark, path).collect()))
    upsert(load(spark, rows_of(second)), path)
    assert sorted(map(tuple, read_target(spark, path).collect())) == once

    want = {}
    for generated in (first, second):
        # One timestamp per key, so ties within a load go to the greatest speed.
        latest = {}
        for key, speed in generated:
            latest[key] = max(speed, latest.get(key, speed))
        want.update(latest)
    got = {(int(r.vehicle_id[1:]), r.day - 1, r.event_time.second): r.speed for r in read_target(spark, path).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=loads, order=st.randoms())
def test_dedupe_does_not_depend_on_row_order(spark, rows, order):
    shuffled = rows_of(rows)
    order.shuffle(shuffled)
    results = [
        sorted(map(tuple, dedupe_latest(load(spark, r), list(KEY_COLS), ["timestamp"]).collect()))
        for r in (rows_of(rows), shuffled)
    ]
    assert results[0] == results[1]


def test_tables_without_merge_are_refused(spark):
    create = load(spark, [event()]).where("false")
    create.write.mode("overwrite").saveAsTable("plain_table")
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            merge_table(load(spark, [event()]), "plain_table")
    finally:
        spark.sql("DROP TABLE plain_table")

"""Declared keys."""

import datetime as dt
import uuid

import pytest

from conftest import event
from roadlake.functions.event_time import add_event_time
from roadlake.operators.keys import check_key, declare, declared, repeated_keys
from roadlake.operators.upsert import read_target, upsert
from roadlake.schema import EVENT_SCHEMA, KEY_COLS
from test_storage import DAY, START, plan_line
from test_upsert import load


@pytest.fixture
def table(spark, folder):
    upsert(load(spark, [event(f"V{i}", START + d * DAY) for i in range(5) for d in range(3)]), folder)
    name = f"t{uuid.uuid4().hex}"
    declare(spark, name, folder)
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_a_declared_table_has_rows_partitions_and_key(spark, folder, table):
    assert declared(spark, table) == KEY_COLS
    assert spark.table(table).count() == 15 and spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    check_key(spark, table)


def test_a_planted_duplicate_is_found_on_its_day(spark, folder, table):
    more = load(spark, [event("V1", START + DAY), event("V7", START + 8 * DAY), event(None, START), event(None, START)])
    more.select(*read_target(spark, folder).columns).write.mode("append").partitionBy("year", "month", "day").parquet(folder)
    declare(spark, table, folder)
    with pytest.raises(ValueError, match=r"V1, 2024-01-02 00:00:00 \(2 rows\)$"):
        check_key(spark, table)
    check_key(spark, table, dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    check_key(spark, table, dt.date(2024, 1, 3))
    with pytest.raises(ValueError, match="V1"):
        check_key(spark, table, dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 4


def test_only_touched_days_and_the_key_are_read(spark, table):
    from roadlake.operators.time_range import on_days

    plan = repeated_keys(on_days(spark.table(table), dt.date(2024, 1, 2)), KEY_COLS)
    assert "make_date" in plan_line(plan, "PartitionFilters")
    assert "number_plate" not in plan_line(plan, "ReadSchema")


def test_other_keys_are_refused(spark, folder, table):
    with pytest.raises(ValueError, match="has the key"):
        declare(spark, table, folder, ["user_id"])
    with pytest.raises(ValueError, match="missing columns: nothing"):
        declare(spark, f"{table}x", folder, ["nothing"])
    spark.range(1).write.saveAsTable(f"{table}y")
    try:
        with pytest.raises(ValueError, match="no declared key"):
            check_key(spark, f"{table}y")
    finally:
        spark.sql(f"DROP TABLE {table}y")


def test_nulls_repeat_no_key(spark):
    frame = add_event_time(spark.createDataFrame([event("A", START)] * 3 + [event(None, START)] * 2 + [event("B", None)] * 2, EVENT_SCHEMA))
    assert [(r.vehicle_id, r.n_rows) for r in repeated_keys(frame, KEY_COLS).collect()] == [("A", 3)]

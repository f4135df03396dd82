"""Count-or-time batches against a plain Python fold."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from roadlake.operators.batching import assign_batches, batch_counts

BASE = 1704067200


def frame(spark, seconds):
    rows = [(i, s) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "id bigint, s double").selectExpr("id", "cast(s + %d as timestamp) as t" % BASE)


def expected(seconds, max_rows, max_seconds):
    seen = Counter()
    result = {}
    for second, i in sorted((s, i) for i, s in enumerate(seconds)):
        bucket = (BASE + int(second // 1)) // max_seconds * max_seconds
        result[i] = (bucket, seen[bucket] // max_rows)
        seen[bucket] += 1
    return result


def actual(df):
    return {r.id: (int(r.bucket_start.timestamp()), r.batch_no) for r in df.collect()}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(seconds=st.lists(st.floats(0, 400, width=16), min_size=1, max_size=60), max_rows=st.integers(1, 9))
def test_matches_a_fold(spark, seconds, max_rows):
    batched = assign_batches(frame(spark, seconds), "t", ["id"], max_rows, 60)
    assert actual(batched) == expected(seconds, max_rows, 60)


def test_bounds_hold_when_one_bucket_has_most_rows(spark):
    seconds = [5.0] * 700 + [float(s) for s in range(300)]
    batched = assign_batches(frame(spark, seconds), "t", ["id"])
    counts = batch_counts(batched).collect()
    assert sum(r.n_rows for r in counts) == 1000
    assert max(r.n_rows for r in counts) == 100
    assert sum(r.n_rows == 100 for r in counts) == 7
    assert actual(batched) == expected(seconds, 100, 60)


def test_runs_are_joined_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seconds = [float(s % 240) for s in range(500)]
        batched = assign_batches(frame(spark, seconds), "t", ["id"], 7, 60)
        assert actual(batched) == expected(seconds, 7, 60)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_equal_rows_spread_over_tasks(spark):
    same = spark.range(0, 20_000, 1, 8).selectExpr("timestamp_seconds(1704067200) as t")
    batched = assign_batches(same, "t")
    sizes = Counter(r.n_rows for r in batch_counts(batched).collect())
    assert sizes == {100: 200}


def test_null_times_form_their_own_bucket(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5.0)], "id bigint, s double").selectExpr(
        "id", "cast(s as timestamp) as t"
    )
    counts = batch_counts(assign_batches(df, "t", ["id"])).collect()
    assert {(str(r.bucket_start), r.n_rows) for r in counts} == {("None", 2), ("1970-01-01 00:00:00", 1)}


def test_no_rows(spark):
    df = frame(spark, [1.0]).where("id < 0")
    assert assign_batches(df, "t", ["id"]).count() == 0

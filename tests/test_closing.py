"""Batches closed one after the other, against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from roadlake.operators.closing import close_batches

BASE = 1704067200


def frame(spark, rows):
    """Rows of (source, id, seconds or None)."""
    return spark.createDataFrame(rows, "src string, id bigint, s double").selectExpr(
        "src", "id", "timestamp_micros(cast((s + %d) * 1000000 as bigint)) as t" % BASE
    )


def expected(rows, max_rows, max_seconds):
    out = {}
    for source in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == source), key=lambda r: (r[2] is not None, r[2] or 0, r[1]))
        batch, size, first = -1, 0, None
        for k, (_, i, s) in enumerate(own):
            new = k == 0 or size == max_rows or (s is None) != (first is None) or (s is not None and s - first >= max_seconds)
            if new:
                batch, size, first = batch + 1, 0, s
            size += 1
            out[source, i] = batch
    return out


def actual(df):
    rows = df.collect()
    out = {(r.src, r.id): r.batch_no for r in rows}
    assert len(out) == len(rows)
    return out


def rows_of(seed, n):
    rng = random.Random(seed)
    rows, at = [], 0.0
    for i in range(n):
        at += rng.choice([0, 0, 0.5, 1, 3, rng.random() * 40, 70]) if rng.random() < 0.5 else rng.random()
        # A third of the rows and more lie in one source.
        rows.append((rng.choice(["hot", "hot", "a", None]), i, None if rng.random() < 0.05 else round(at, 6)))
    return rows


@pytest.mark.parametrize("max_rows, block_rows, fan", [(100, None, None), (5, 8, 2), (1, 4, 3), (7, 7, 2)])
def test_matches_a_loop(spark, max_rows, block_rows, fan):
    rows = rows_of(max_rows, 900)
    random.Random(0).shuffle(rows)
    got = close_batches(frame(spark, rows), ["src"], "t", ["id"], max_rows, 60, block_rows, fan)
    assert got.columns == ["src", "id", "t", "batch_no"]
    assert actual(got) == expected(rows, max_rows, 60)


def test_the_age_counts_from_the_first_row_of_the_batch(spark):
    """Fixed multiples of a minute would begin elsewhere."""
    rows = [("a", i, s) for i, s in enumerate([50.0, 70.0, 109.9, 110.0, 169.9, 170.0, 400.0])]
    assert list(actual(close_batches(frame(spark, rows), ["src"], "t", ["id"])).values()) == [0, 0, 0, 1, 1, 2, 3]


def test_equal_times_are_closed_by_number(spark):
    same = spark.range(0, 5_000, 1, 8).selectExpr("'a' as src", "id", "timestamp_seconds(1704067200) as t")
    counts = close_batches(same, ["src"], "t", block_rows=256, fan=4).groupBy("batch_no").count().collect()
    assert sorted((r.batch_no, r["count"]) for r in counts) == [(i, 100) for i in range(50)]


def test_blocks_bound_what_a_task_holds(spark, monkeypatch):
    """All rows are of one source; what is gathered are blocks with the rows they reach into, and nodes of so many children."""
    import roadlake.operators.closing as closing

    sizes = []
    keep = closing.checkpointed

    def measured(df):
        df = keep(df)
        for c in ("next", "children"):
            if c in df.columns:
                sizes.append((c, df.agg(F.max(F.size(c))).first()[0]))
        return df

    monkeypatch.setattr(closing, "checkpointed", measured)
    rows = [("a", i, float(i)) for i in range(3_000)]
    got = close_batches(frame(spark, rows), ["src"], "t", ["id"], 50, 60, 64, 4)
    assert actual(got) == expected(rows, 50, 60)
    assert {c for c, _ in sizes} == {"next", "children"}
    assert all(n <= {"next": 64 + 50, "children": 4}[c] for c, n in sizes)


def test_no_rows(spark):
    assert close_batches(frame(spark, []), ["src"], "t").collect() == []

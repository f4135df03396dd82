import zlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from roadlake.llm.common import components, free_name, held_out, host_of, kept


def plain_components(edges):
    least = {}
    for u, v in edges:
        least.setdefault(u, u), least.setdefault(v, v)
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(least[u], least[v])
            changed |= (least[u], least[v]) != (low, low)
            least[u] = least[v] = low
    return least


def solved(spark, edges):
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(26, 40)), min_size=1, max_size=25))
def test_components_match_a_plain_search(spark, edges):
    assert solved(spark, edges) == plain_components(edges)


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(300)],  # a chain
    [(300, i) for i in range(300)],  # a star whose centre is the largest
    [(i, i + 1) for i in range(50)] + [(i, i + 1) for i in range(100, 150)],
])
def test_components_of_long_and_wide_graphs(spark, edges):
    assert solved(spark, edges) == plain_components(edges)


def test_components_ignore_loops_repeats_and_nulls(spark):
    assert solved(spark, [(1, 1), (None, 2), (3, None), (5, 4), (4, 5), (5, 4)]) == {4: 4, 5: 4}
    assert solved(spark, []) == {}


def test_held_out_is_the_checksum_of_the_text(spark):
    rows = spark.range(200).select("id", held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    assert spark.sql("select cast(null as long) id").select(held_out(F.col("id"), 5, 0)).first()[0] is False


def test_host_and_free_name(spark):
    urls = [("http://A.b/c?x", "a.b"), ("http://user:pw@Example.com:80/", "example.com"), ("http://a@b@c/x@y", "c"), ("https://h:80", "h"), ("no url", ""), (None, ""), ("ftp://x#y", "x")]
    frame = spark.createDataFrame(urls, "url string, host string")
    assert frame.where(host_of(F.col("url")) != F.col("host")).count() == 0
    assert free_name(spark.createDataFrame([], "Score int, score_ int"), "score") == "score__"


def test_a_worker_keeps_the_last_thing_only():
    made = []
    make = lambda name: kept(name, lambda: made.append(name) or name)
    assert [make(n) for n in ("a", "a", "b", "b", "a")] == ["a", "a", "b", "b", "a"]
    assert made == ["a", "b", "a"]

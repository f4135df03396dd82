import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm.knn import reachable, top_k
from roadlake.llm.vectors import linked_pairs, near_duplicate_vectors, quantise

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, Dim int"


def clustered(seed, n, dim=16, spread=0.25):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    return (centres[draw.integers(0, 6, n)] + spread * draw.normal(size=(n, dim))).astype(np.float32)


def rows_of(vectors, labels):
    return [(i, [float(x) for x in v], int(l), 0, 0) for i, (v, l) in enumerate(zip(vectors, labels))]


ODD = [
    (900, None, 1, 0, 0), (901, [], 1, 0, 0), (902, [0.0] * 16, 1, 0, 0), (903, [float("nan")] + [1.0] * 15, 1, 0, 0),
    (904, [float("inf")] + [1.0] * 15, 1, 0, 0), (905, [None] + [1.0] * 15, 1, 0, 0), (906, [1.0] * 16, None, 0, 0),
    (907, [1.0, 2.0], 1, 0, 0), (908, [2.0, 4.0], 1, 0, 0), (None, [1.0] * 16, 1, 0, 0), (909, [1e30] * 16, 7, 0, 0), (910, [1e-30] * 16, 7, 0, 0),
]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def plain_links(rows):
    good = {i: (np.array(v, np.float64), l) for i, v, l, *_ in rows if i is not None and l is not None and usable(v) and any(v)}
    links = set()
    for i, (a, l) in good.items():
        for j, (b, m) in good.items():
            if i < j and l == m and len(a) == len(b):
                a_, b_ = a / np.abs(a).max(), b / np.abs(b).max()
                if a_ @ b_ / (np.linalg.norm(a_) * np.linalg.norm(b_)) >= 0.93:
                    links.add((i, j))
    return links


@pytest.mark.parametrize("tile", [4096, 20])
def test_near_duplicates_match_all_pairs(spark, tile):
    vectors = clustered(1, 150)
    rows = rows_of(vectors, np.arange(150) % 3) + ODD
    rows += rows[:5]  # repeated rows
    links = plain_links(rows)
    assert len(links) > 50
    least = {i: i for i, *_ in rows}
    for _ in range(len(least)):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    out = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), tile=tile)
    got = out.collect()
    assert len(got) == len(rows) and out.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    for r in got:
        assert r.n_links == sum(r.vec_id in pair for pair in links)
        assert r.component_id == least[r.vec_id]
        assert r.kept == (r.vec_id is not None and least[r.vec_id] == r.vec_id)


def test_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1, 0, 0) for i in range(300)]
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), tile=64).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicate_vectors(empty).count() == 0
    assert top_k(empty, F.col("vec_id") % 2 == 0).count() == 0
    assert top_k(spark.createDataFrame(ODD[:6], SCHEMA), F.lit(True)).count() == 0


def test_bound_never_rules_out_a_link():
    draw = np.random.default_rng(3)
    a, b = draw.normal(size=(400, 8)), draw.normal(size=(300, 8))
    for threshold in (0.5, 0.9):
        found = {(int(i), int(j)) for x, y in linked_pairs(a, b, threshold, False) for i, j in zip(x, y)}
        cosine = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
        assert found == set(zip(*map(list, np.nonzero(cosine >= threshold))))
    unit = a / np.linalg.norm(a, axis=1)[:, None]
    codes, scale, stands, miss = quantise(unit)
    assert np.abs(codes).max() <= 127
    error = np.abs(unit @ unit.T - (codes.astype(float) @ codes.T) * np.outer(scale, scale))
    assert (error <= np.outer(stands, miss) + np.outer(miss, stands) + np.outer(miss, miss) + 1e-12).all()


def plain_top(rows, k, every):
    good = {}
    for i, v, *_ in rows:
        if i is not None and usable(v):
            good[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = set()
    for q, a in good.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good.items() if i != q and len(a) == len(b))
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], start=1)}
    return out


@pytest.mark.parametrize("options", [{}, {"pivots": 4, "group": 5, "block": 30}, {"pivots": 1}, {"k": 500}])
def test_top_k_matches_all_pairs(spark, options):
    vectors = clustered(2, 200)
    vectors[20:40] = vectors[20]  # ties
    rows = rows_of(vectors, np.zeros(200)) + [r for r in ODD if r[0] not in (909, 910)]
    rows += rows[:30]
    out = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, **options)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_top(rows, options.get("k", 5), 10)


def test_top_k_of_sums_beyond_a_double(spark):
    rows = [(i, [2.0**22 + i, float(i)], 0, 0, 0) for i in range(6)]
    got = {tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()}
    assert got == {t for t in plain_top(rows, 5, 10) if t[0] == 0}


def test_reachable_scores_are_reached():
    draw = np.random.default_rng(5)
    pivots, data, queries = draw.normal(size=(5, 6)), draw.normal(size=(80, 6)), draw.normal(size=(30, 6))
    near = lambda x: ((x[:, None] - pivots) ** 2).sum(-1).argmin(1)
    cell, own = near(data), near(queries)
    away = np.linalg.norm(data - pivots[cell], axis=1)
    scores = reachable(
        pivots,
        {c: float(np.linalg.norm(queries[own == c] - pivots[c], axis=1).max()) for c in set(own.tolist())},
        {c: sorted(away[cell == c].tolist())[:4] for c in set(cell.tolist())},
        3,
    )
    for q, c in zip(queries, own.tolist()):
        assert np.sort(data @ q)[::-1][3] >= scores[c] - 1e-9


@pytest.mark.parametrize("options", [{}, {"pivots": 2}, {"block": 3}])
def test_top_k_of_a_row_repeated_more_than_k_times(spark, options):
    vectors = {0: 10.0, 1: 9.0, 2: 8.0, 3: 7.0, 4: 6.0, 5: 5.0}
    rows = [(i, [x, 0.0], 0, 0, 0) for i, x in vectors.items()]
    rows += [rows[1]] * 40 + [rows[0]] * 3
    got = {tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, **options).collect()}
    assert len(got) == 5 and got == {t for t in plain_top(rows, 5, 10) if t[0] == 0}


def test_queries_meet_only_blocks_of_rows_they_need(spark, monkeypatch):
    """Far apart bundles: a group of queries needs its own bundle, however many rows the others have."""
    from roadlake.llm import knn

    seen, keep = [], knn.cut
    monkeypatch.setattr(knn, "cut", lambda df: (frame := keep(df), "blocks" in frame.columns and seen.append(frame.toPandas()))[0])
    draw = np.random.default_rng(4)
    rows = []
    for bundle in range(4):
        centre = np.zeros(4)
        centre[bundle] = 100.0
        rows += [(bundle * 200 + i, (centre + draw.normal(0, 0.1, 4)).tolist(), "x", 1) for i in range(200)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v, *_ in rows], "vec_id long, embedding array<double>, label string, id int")
    got = {tuple(r) for r in top_k(frame, F.col("vec_id") % 20 == 0, block=50, group=1).collect()}
    (blocks,) = seen
    assert blocks["blocks"].sum() < len(blocks) * len(rows) / 50 / 2  # half of all blocks at most
    want = set()
    x = {i: np.floor(256 * np.array(v)) for i, v, *_ in rows}
    for q in x:
        if q % 20 == 0:
            best = sorted(((-int(x[q] @ x[i]), i) for i in x if i != q))[:5]
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    assert got == want

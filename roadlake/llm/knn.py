"""Exact top-k by inner product as a Voronoi join.

Pivots cut the space into cells. Queries and data are assigned to the cell of their nearest pivot, and
each cell is summed up in a few numbers: how far its farthest query lies from the pivot, and how
near its nearest data rows. From these follows, for each cell of queries, a score that
the k-th best answer of any of its queries reaches at least. A data row goes only to groups of
query cells in which it can reach that score; groups are solved block by block, and the blocks' best
rows are merged.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlake.llm.common import cut
from roadlake.llm.vectors import as_doubles, usable

#: Rows drawn as pivots; their number bounds every summary.
PIVOTS = 64
#: Queries in a group and data rows in a block, on average.
GROUP, BLOCK = 1024, 8192


def scaled(vec: Column, factor: int) -> Column:
    """floor(factor * x) of each component, as doubles that hold whole numbers."""
    return F.transform(as_doubles(vec), lambda x: _floor(F.lit(float(factor)) * x))


def _floor(x: Column) -> Column:
    # floor() returns a long, which very large components overflow; a double that large is whole already.
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def _cells(ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot and the distance to it; the origin is the last pivot."""
    squares = (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ pivots.T + (pivots**2).sum(axis=1)
    cell = squares.argmin(axis=1)
    return cell, np.linalg.norm(vectors - pivots[cell], axis=1)


def _pivots_of(drawn: list[list[float]], dim: int) -> np.ndarray:
    same = sorted({tuple(p) for p in drawn if len(p) == dim})
    return np.array([*same, [0.0] * dim])


def _assign(batches, drawn):
    for pdf in batches:
        pdf["dim"] = pdf["vec"].map(len).astype("int32")
        for dim, part in pdf.groupby("dim"):
            part = part.copy()
            cell, away = _cells(part["id"].to_numpy(), np.stack(part["vec"].to_numpy()), _pivots_of(drawn, dim))
            yield part.assign(cell=cell.astype("int32"), away=away)


def _nearest(batches, keep):
    """Per batch and cell: the distances of the rows nearest to the pivot."""
    for pdf in batches:
        for (dim, cell), part in pdf.groupby(["dim", "cell"]):
            yield pd.DataFrame({"dim": [dim], "cell": [cell], "near": [np.sort(part["away"].to_numpy())[:keep]]})


def reachable(pivots: np.ndarray, farthest: dict[int, float], nearest: dict[int, list[float]], k: int) -> dict[int, float]:
    """Per query cell: a score that the k-th best answer of each of its queries reaches.

    With q = p + e and x = r + f, the product of a query and a row is at least
    p.r - |p||f| - |e||r| - |e||f|. One row more than k is counted, as one of them may be the query itself.
    """
    size = np.linalg.norm(pivots, axis=1)
    scores = {}
    for cell, e in farthest.items():
        least = [
            pivots[cell] @ pivots[c] - size[cell] * f - e * size[c] - e * f for c, near in nearest.items() for f in near
        ]
        scores[cell] = float(np.sort(least)[::-1][k]) if len(least) > k else -np.inf
    return scores


def _wanted(batches, plan):
    """Per batch and group of queries: the rows that may matter to one of them."""
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            if dim not in plan:
                continue
            pivots, cells, farthest, score, groups = plan[dim]
            x = np.stack(part["vec"].to_numpy())
            reach = x @ pivots[cells].T + np.linalg.norm(x, axis=1)[:, None] * farthest
            slack = 1e-9 * (1 + np.abs(reach) + np.where(np.isfinite(score), np.abs(score), 0))
            wanted = reach + slack >= score
            for group in sorted({g for own in groups for g in own}):
                member = np.array([group in own for own in groups])
                hit = wanted[:, member].any(axis=1)
                if hit.any():
                    yield group, part.loc[hit, ["dim", "id", "vec"]]


def _targets(batches, plan):
    """Rows with each group of queries that they may matter to."""
    for group, part in _wanted(batches, plan):
        yield part.assign(grp=np.int32(group))


def _target_counts(batches, plan):
    """How many rows each group of queries needs."""
    for group, part in _wanted(batches, plan):
        yield pd.DataFrame({"grp": [np.int32(group)], "n": [len(part)]})


def _best(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of one block for each query of one group."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    if queries.empty or data.empty:
        return empty
    queries, data = queries.drop_duplicates("id"), data.drop_duplicates("id").sort_values("id")
    q, x = (np.stack(f["vec"].to_numpy()) for f in (queries, data))
    ids = data["id"].to_numpy()
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] >= 2.0**53:  # sums a double can't hold exactly
        q, x = (np.array([[int(c) for c in row] for row in f], dtype=object) for f in (q, x))
    out = []
    for at, query in zip(range(len(q)), queries["id"].to_numpy()):
        score = x @ q[at]
        if score.dtype != object and len(score) > 4 * (k + 1):
            # All rows that score no less than the (k + 1)-th: ties are settled below.
            near = np.flatnonzero(score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1])
        else:
            near = np.arange(len(score))
        near = near[ids[near] != query]
        order = near[np.lexsort((ids[near], np.array([-int(s) for s in score[near]], dtype=object if score.dtype == object else "int64")))][:k]
        out.append(pd.DataFrame({"query_id": query, "vec_id": ids[order], "score": [int(s) for s in score[order]]}))
    return pd.concat([empty, *out]).astype("int64")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    factor: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int = PIVOTS,
    group: int = GROUP,
    block: int = BLOCK,
) -> DataFrame:
    """Per query the ``k`` rows with the highest whole-number inner product: query_id, rank, vec_id, score.

    Ties go to the smaller id; a query is no candidate of its own; with fewer than ``k`` candidates all are returned.
    Rows whose id or vector is null, empty vectors and vectors with a null or non-finite component take no
    part, and vectors meet only those of their own length. Rows that repeat an id are one row.
    No rows or no queries give no rows. Scores must fit a long.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), scaled(F.col(vec_col), factor).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("query")
    ).where(F.col("id").isNotNull() & usable(F.col("vec")))
    # Bounds count rows, answers count ids: every id is one row before anything is counted.
    rows = cut(rows.groupBy("id").agg(F.min("vec").alias("vec"), F.max("query").alias("query")))
    drawn = [list(r.vec) for r in rows.orderBy(F.xxhash64("id"), "id").limit(pivots).select("vec").collect()]
    schema = "id long, vec array<double>, query boolean, dim int, cell int, away double"
    placed = cut(rows.mapInPandas(partial(_assign, drawn=drawn), schema))

    near = placed.select("dim", "cell", "away").mapInPandas(partial(_nearest, keep=k + 1), "dim int, cell int, near array<double>")
    near = near.groupBy("dim", "cell").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    asked = placed.where("query").groupBy("dim", "cell").agg(F.max("away").alias("far"), F.count(F.lit(1)).alias("n"))
    summary = near.join(asked, ["dim", "cell"], "left").orderBy("dim", "cell").collect()  # a row per pivot at most

    plan, chunks, groups = {}, [], 0
    for dim in sorted({r.dim for r in summary}):
        own = [r for r in summary if r.dim == dim]
        if not any(r.n for r in own):
            continue
        spots = _pivots_of(drawn, dim)
        score = reachable(spots, {r.cell: r.far for r in own if r.n}, {r.cell: r.near for r in own}, k)
        cells, filled, members = [r for r in own if r.n], 0, []
        for r in cells:  # neighbours in cell order share a group until it is full; a large cell has several
            parts = -(-r.n // group)
            if parts > 1 or filled + r.n > group:
                groups, filled = groups + (filled > 0), 0
            members.append(list(range(groups, groups + parts)))
            chunks.append((dim, r.cell, groups, parts))
            filled += r.n
            if parts > 1:
                groups, filled = groups + parts, 0
        groups += filled > 0
        index = [r.cell for r in cells]
        plan[dim] = (spots, index, np.array([r.far for r in cells]), np.array([score[c] for c in index]), members)
    spark = vectors.sparkSession
    if not plan:
        return spark.range(0).selectExpr("id query_id", "cast(id as int) rank", "id vec_id", "id score")

    # A group's own rows say into how many blocks they are dealt, so a query meets the blocks that hold some of them and no others.
    counted = placed.mapInPandas(partial(_target_counts, plan=plan), "grp int, n long").groupBy("grp").agg(F.sum("n").alias("n"))
    blocks = cut(counted.select("grp", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")))
    needed = placed.mapInPandas(partial(_targets, plan=plan), "dim int, id long, vec array<double>, grp int")
    needed = needed.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    dealt = spark.createDataFrame(chunks, "dim int, cell int, first int, parts int")  # a row per pivot at most
    asking = placed.where("query").join(F.broadcast(dealt), ["dim", "cell"]).select(
        "dim", "id", "vec", (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("grp"),
    ).join(blocks, "grp").select("dim", "id", "vec", "grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    best = asking.groupBy("dim", "grp", "block").cogroup(needed.groupBy("dim", "grp", "block")).applyInPandas(
        lambda q, x: _best(q, x, k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

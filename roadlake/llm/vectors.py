"""Near-duplicate vectors by quantised tile products.

Vectors of one label are dealt into tiles of bounded size. Each pair of tiles is one group of one
task: it multiplies the int8 codes of its vectors, adds an error bound that each vector's own
quantisation residual gives, and recomputes in double precision only the pairs that the bound
cannot rule out. A task returns link counts and a spanning forest of the links it found, never the
pairs themselves. The work is quadratic in the size of a label, as comparing all rows is; the
memory of a task is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadlake.llm.common import components, cut

#: Vectors in a tile, on average.
TILE = 4096
#: Rows of a tile that are multiplied at once, and pairs recomputed at once.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 512, 65_536
_SLACK = 1e-9


def usable(vec: Column) -> Column:
    """True for a vector with at least one component, all of them numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, fine), F.lit(False))


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, their scales, the norms of what the codes stand for, and of what they miss."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    stands = codes * scale[:, None]
    return codes, scale, np.linalg.norm(stands, axis=1), np.linalg.norm(unit - stands, axis=1)


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= ``threshold``, block by block; of one set (``same``) each pair once."""
    norms = [np.linalg.norm(x, axis=1) for x in (left, right)]
    parts = [quantise(x / n[:, None]) for x, n in zip((left, right), norms)]
    (a, scale_a, size_a, miss_a), (b, scale_b, size_b, miss_b) = parts
    # Products of int8 codes are whole numbers that this type holds without rounding.
    exact = np.float32 if left.shape[1] * 127 * 127 < 2**24 else np.float64
    b_codes = b.astype(exact).T
    for at in range(0, len(left), ROWS_AT_ONCE):
        rows = slice(at, at + ROWS_AT_ONCE)
        product = (a[rows].astype(exact) @ b_codes) * scale_a[rows, None] * scale_b
        bound = size_a[rows, None] * miss_b + miss_a[rows, None] * (size_b + miss_b)
        i, j = np.nonzero(product + bound >= threshold - _SLACK)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for p in range(0, len(i), PAIRS_AT_ONCE):
            x, y = i[p : p + PAIRS_AT_ONCE], j[p : p + PAIRS_AT_ONCE]
            cosine = np.einsum("ij,ij->i", left[x], right[y]) / (norms[0][x] * norms[1][y])
            yield x[cosine >= threshold], y[cosine >= threshold]


def _solve(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Link counts (v null) and forest edges of one pair of tiles."""
    rows = rows.drop_duplicates("id", ignore_index=True)
    ids = rows["id"].to_numpy()
    vectors = np.stack(rows["vec"].to_numpy()).astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1)[:, None]  # no product overflows, no cosine changes
    first = rows["tile"].to_numpy() == rows["a"].to_numpy()
    same = bool((rows["a"] == rows["b"]).iat[0])
    one = np.flatnonzero(first)
    two = one if same else np.flatnonzero(~first)
    counts, group, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
    for x, y in linked_pairs(vectors[one], vectors[two], threshold, same) if len(two) else ():
        x, y = one[x], two[y]
        counts += np.bincount(x, minlength=len(ids)) + np.bincount(y, minlength=len(ids))
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else []
        for s, e in zip(starts, [*starts[1:], len(x)]):
            others, at = np.unique(group[y[s:e]], return_index=True)
            new = others != group[x[s]]
            if new.any():
                edges += [(ids[x[s]], ids[k]) for k in y[s:e][at[new]]]
                group[np.isin(group, others[new])] = group[x[s]]
    has = counts > 0
    return pd.DataFrame({
        "u": np.r_[ids[has], [u for u, _ in edges]].astype("int64"),
        "v": pd.array([None] * int(has.sum()) + [int(v) for _, v in edges], dtype="Int64"),
        "n": np.r_[counts[has], np.zeros(len(edges))].astype("int64"),
    })


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    tile: int = TILE,
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` and ``kept``.

    Rows link when their labels are equal and not null and their cosine is at least ``threshold``.
    Vectors that are null, empty or all zero, or hold a null or non-finite component, link with
    nothing, nor do vectors of different lengths, nor rows without an id (their component is
    null, and ``kept`` false). Rows that repeat an id are one vector and are answered each.
    """
    vec = as_doubles(F.col(vec_col))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")) & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumn("dim", F.size("vec"))
    sizes = rows.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = rows.join(sizes, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "dim", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "id", "vec"
    )
    found = cut(
        pairs.groupBy("label", "dim", "a", "b").applyInPandas(lambda x: _solve(x, threshold), "u long, v long, n long")
    )
    counts = found.where("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n_links"))
    groups = components(found.where("v is not null")).withColumnRenamed("node", "id")
    answer = counts.join(groups, "id", "left").withColumnRenamed("id", "vector")
    component = F.coalesce("component", "id")
    return vectors.select(F.col(id_col).alias("id")).join(answer, F.col("id") == F.col("vector"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )

"""Small pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, functions as F

from roadlake.session import checkpointed

T = TypeVar("T")

#: Rounds of :func:`components` that order nodes by their id before order is drawn at random.
PLAIN_ROUNDS = 2


#: The one thing that a worker process keeps between tasks.
_KEPT: dict[object, object] = {}


def kept(name: object, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept by the worker process for later tasks that ask for the same name.

    Only the last thing asked for is kept, so that what one operator remembers does not add to what the next one does.
    """
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the checkpoint folder all executors share and go on from there."""
    return checkpointed(df)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user or port; empty when there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)", 1))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for rows set aside for testing: crc32 of the id as text, modulo ``folds``, equals ``fold``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph of longs.

    ``edges`` has columns ``u`` and ``v``; the result has one row per node with an edge: ``node``
    and ``component``, the smallest node of its component. Self-loops and nulls are ignored; no
    edges give no rows.

    Each round maps a node to the first node of its closed neighbourhood and contracts the
    graph. The first rounds take the smallest id, which finishes stars whose centre is the
    smallest; later ones order nodes by a hash that changes with the round, which contracts any
    graph by a constant factor in expectation, long chains included. Only aggregates that
    combine before the shuffle and key joins are used.
    """
    pairs = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    graph = cut(pairs.union(pairs.select("v", "u")).distinct())
    maps = []
    while not graph.isEmpty():
        number = len(maps)
        order = F.col("w") if number < PLAIN_ROUNDS else F.xxhash64("w", F.lit(number))
        closed = graph.select("u", F.col("v").alias("w")).union(graph.select("u", F.col("u").alias("w")))
        step = cut(closed.groupBy("u").agg(F.min(F.struct(order.alias("o"), "w")).alias("m")).select("u", F.col("m.w").alias("to")))
        maps.append(step)
        left = step.select("u", F.col("to").alias("a"))
        right = step.select(F.col("u").alias("v"), F.col("to").alias("b"))
        graph = cut(
            graph.join(left, "u").join(right, "v").where("a <> b")
            .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
        )
    if not maps:
        return graph.select(F.col("u").alias("node"), F.col("v").alias("component"))
    reached = maps[0].select(F.col("u").alias("node"), F.col("to"))
    for step in maps[1:]:
        onward = step.select(F.col("u").alias("to"), F.col("to").alias("further"))
        reached = reached.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
    reached = cut(reached)
    least = reached.groupBy("to").agg(F.min("node").alias("component"))
    return reached.join(least, "to").select("node", "component")

"""A ledger of offset ranges, and what it says about messages lost or taken twice.

A batch of messages is noted as ranges of consecutive offsets, so the ledger grows with batches and gaps and not with messages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: Offsets that are cut into ranges together, so that a topic partition with most messages is many tasks' work.
STRETCH = 100_000
SKIPPED, DOUBLED = "skipped", "doubled"


def offset_ranges(messages: DataFrame, sources: Sequence[str], offset: str = "offset", stretch: int = STRETCH) -> DataFrame:
    """``sources``, ``first``, ``last`` and ``copies`` of the runs of consecutive offsets that came equally often.

    An offset that came twice lies in a range of its own kind (``copies`` 2). Offsets are counted per stretch before runs are
    looked for, so repeated messages cost a row per task; a run that crosses stretches is one range. Null offsets are left out.
    """
    counted = messages.where(F.col(offset).isNotNull()).groupBy(*sources, F.col(offset).cast("long").alias("_at")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    stretched = counted.withColumn("_stretch", F.floor(F.col("_at") / F.lit(stretch)))
    inside = Window.partitionBy(*sources, "_stretch", "copies").orderBy("_at")
    runs = stretched.withColumn("_run", F.col("_at") - F.row_number().over(inside)).groupBy(*sources, "_stretch", "copies", "_run").agg(
        F.min("_at").alias("first"), F.max("_at").alias("last")
    )
    return _joined(runs.select(*sources, "first", "last", "copies"), [*sources, "copies"]).select(*sources, "first", "last", "copies")


def _joined(ranges: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Ranges that touch or overlap as one; a window over ranges, of which there are few."""
    before = Window.partitionBy(*groups).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*groups).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    islands = ranges.withColumn("_begins", begins.cast("int")).withColumn("_island", F.sum("_begins").over(upto))
    return islands.groupBy(*groups, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island")


def covered(ledger: DataFrame, sources: Sequence[str]) -> DataFrame:
    """``sources``, ``first`` and ``last`` of the offsets that the ledger has, without gaps or overlaps."""
    return _joined(ledger.select(*sources, "first", "last"), list(sources))


def findings(ledger: DataFrame, sources: Sequence[str]) -> DataFrame:
    """``sources``, ``kind``, ``first`` and ``last``: ranges skipped between the first and the last offset of a source, and ranges
    that were taken more than once, in one batch or in several."""
    sources = list(sources)
    whole = covered(ledger, sources)
    earlier = F.max("last").over(Window.partitionBy(*sources).orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    skipped = whole.select(*sources, F.lit(SKIPPED).alias("kind"), (earlier + 1).alias("_from"), (F.col("first") - 1).alias("last"))
    skipped = skipped.where("_from is not null").withColumnRenamed("_from", "first")
    # How often an offset is covered changes only where ranges begin and end.
    steps = ledger.select(*sources, F.inline(F.array(
        F.struct(F.col("first").alias("at"), F.col("copies").alias("step")),
        F.struct((F.col("last") + 1).alias("at"), (-F.col("copies")).alias("step")),
    ))).groupBy(*sources, "at").agg(F.sum("step").alias("step"))
    in_order = Window.partitionBy(*sources).orderBy("at")
    depth = steps.select(
        *sources, F.col("at").alias("first"), (F.lead("at").over(in_order) - 1).alias("last"),
        F.sum("step").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("depth"),
    )
    doubled = _joined(depth.where("depth > 1").select(*sources, "first", "last"), sources)
    return skipped.unionByName(doubled.select(*sources, F.lit(DOUBLED).alias("kind"), "first", "last"))

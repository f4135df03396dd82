"""Positions of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from roadlake.session import checkpointed


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """Add ``name``, a row's position (from 0) in its group by ``order``; rows equal in all of it come in any order.

    Rows are range-partitioned and sorted by group and order, so a group of any size is a run of rows over
    neighbouring partitions. A generated id per input row comes last in the order: it lets a
    range end inside any number of otherwise equal rows. The id generated after the sort holds
    the partition in its upper bits and the row in its lower 33; a position is the row's distance
    from the group's first row in its partition plus what earlier partitions hold of the
    group. The sorted rows are checkpointed, because range bounds are sampled anew for every plan that contains them.
    """
    columns = [*groups, *order, "_input_id"]
    with_id = df.withColumn("_input_id", F.monotonically_increasing_id())
    ordered = with_id.repartitionByRange(*columns).sortWithinPartitions(*columns).drop("_input_id")
    rows = checkpointed(ordered.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))

    # A row per group and partition that holds some of it; joined by whichever way their measured size allows.
    runs = rows.groupBy(*groups, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    renamed = {g: f"_run_{i}" for i, g in enumerate(groups)} | {"_part": "_run_part"}
    runs = runs.withColumnsRenamed(renamed)
    same_run = reduce(and_, [F.col(g).eqNullSafe(F.col(renamed[g])) for g in groups], F.col("_part") == F.col("_run_part"))
    position = F.col("_before") + F.col("_id") - F.col("_first")
    return rows.join(runs, same_run).select(*df.columns, position.alias(name))

"""Count-or-time batches that are closed one after the other.

A batch begins with the first row that the one before it left out, and is closed by its size or its age, whichever comes
first. So the start of a batch is a function of the start before it, and which rows are starts is found by
pointer doubling: rows of a source lie in blocks, and in a block every row is followed to the first start beyond it in as
many steps as the block's size has bits. A start is at most ``max_rows`` behind the one before, so a
block is entered at one of its first ``max_rows`` rows, and what it does to whoever enters there is a table of so many
entries. Tables of neighbouring blocks are chained into that of a larger block, level by level, until one is left per
source; then each block is told where it is entered, level by level down. No task holds more than a block of rows
or a node's tables, whatever share of the rows a source has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadlake.operators.batching import MAX_ROWS, MAX_SECONDS
from roadlake.operators.numbering import numbered
from roadlake.session import checkpointed

#: Rows of a block, and blocks of a larger one. Parameters of cost only.
BLOCK_ROWS, FAN = 1024, 256

_TABLE = "array<struct<to:int,n:bigint>>"


def close_batches(
    df: DataFrame,
    sources: Sequence[str],
    time_col: str,
    tie_breakers: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
    max_seconds: int = MAX_SECONDS,
    block_rows: int | None = None,
    fan: int | None = None,
) -> DataFrame:
    """Add ``batch_no`` (from 0 within the ``sources``, such as the partition of a topic).

    Within a source, rows come in order of ``time_col`` then ``tie_breakers``; rows equal in both come in any order. A batch takes
    rows until it has ``max_rows``, or until one comes ``max_seconds`` or more after its first; that row begins the
    next batch. Rows without a time come first and are closed by their number, in batches of their own. Null sources are one.
    """
    sources, block_rows, fan = list(sources), max(block_rows or BLOCK_ROWS, max_rows), fan or FAN
    timed = df.withColumns({"_untimed": F.col(time_col).isNull(), "_micros": F.unix_micros(F.col(time_col).cast("timestamp"))})
    # Rows without a time sort first, and count as a source of their own until the end.
    groups = [*sources, "_timed"]
    timed = timed.withColumn("_timed", ~F.col("_untimed")).drop("_untimed")
    rows = checkpointed(
        numbered(timed, groups, [time_col, *tie_breakers], "_position").withColumns({
            "_block": F.expr(f"_position div {block_rows}"), "_at": F.expr(f"cast(_position % {block_rows} as int)"),
        })
    )
    blocks = checkpointed(_blocks(rows, groups, max_rows, max_seconds, block_rows))
    entered = _entered(blocks.select(*groups, "_block", "table"), groups, max_rows, fan)
    starts = _starts(_null_safe(blocks.select(*groups, "_block", "next"), entered, [*groups, "_block"]), block_rows)
    placed = _null_safe(rows, starts.select(*groups, "_block", "before", "starts"), [*groups, "_block"])
    number = F.col("before") + F.size(F.filter("starts", lambda s: s <= F.col("_at"))) - 1
    return _after_untimed(placed.withColumn("batch_no", number), sources).select(*df.columns, "batch_no")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join by keys in which null equals null."""
    named = right.withColumnsRenamed({k: f"_right{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_right{i}"))
    return left.join(named, same).drop(*[f"_right{i}" for i in range(len(keys))])


def _blocks(rows: DataFrame, groups: Sequence[str], max_rows: int, max_seconds: int, block_rows: int) -> DataFrame:
    """Per block ``next``, the next start for a batch that begins at each row, and ``table``: for a batch that begins at
    each of the first rows, the first start beyond the block (``to``, from the block's end) and the number of starts ``n`` up to there."""
    # The first rows of a block are seen by the block before it as well, as a batch may reach into them.
    row = F.struct(F.col("_at"), F.coalesce("_micros", F.lit(0)).alias("micros"))
    behind = F.struct((F.col("_at") + block_rows).alias("_at"), F.coalesce("_micros", F.lit(0)).alias("micros"))
    reaches = (F.col("_at") < max_rows) & (F.col("_block") > 0)
    sent = F.array_compact(F.array(
        F.struct(F.col("_block").alias("block"), row.alias("row")),
        F.when(reaches, F.struct((F.col("_block") - 1).alias("block"), behind.alias("row"))),
    ))
    spread = rows.select(*groups, F.inline(sent)).withColumnRenamed("block", "_block")
    seen = spread.groupBy(*groups, "_block").agg(F.sort_array(F.collect_list("row")).alias("seen"))
    # No source has a block that holds the rows of the next one alone: those rows are sent to blocks that are there.
    times = seen.select(*groups, "_block", F.transform("seen", lambda r: r["micros"]).alias("times"))
    limit = max_seconds * 1_000_000

    def following(t: Column, i: Column) -> Column:
        close = F.filter(F.slice(F.col("times"), i + 2, max_rows - 1), lambda x: x - t < limit)
        return i + 1 + F.size(close)

    steps = times.select(*groups, "_block", F.transform("times", following).alias("next"))
    jump = F.transform("next", lambda to: F.struct(to.alias("to"), F.lit(1).cast("long").alias("n")))
    # A pointer that is still in the block takes over where that row's pointer leads.
    beyond = lambda all_, x: x["to"] >= F.least(F.size(all_), F.lit(block_rows))
    doubled = F.aggregate(
        F.sequence(F.lit(1), F.lit(block_rows.bit_length())),
        jump,
        lambda all_, _: F.transform(all_, lambda x: F.when(beyond(all_, x), x).otherwise(
            F.struct(all_[x["to"]]["to"].alias("to"), (x["n"] + all_[x["to"]]["n"]).alias("n"))
        )),
    )
    leaving = F.transform(F.slice(doubled, 1, max_rows), lambda x: F.struct((x["to"] - block_rows).alias("to"), x["n"].alias("n")))
    return steps.withColumn("table", leaving.cast(_TABLE))


def _entered(tables: DataFrame, groups: Sequence[str], max_rows: int, fan: int) -> DataFrame:
    """Per block ``entry``, the row at which its first batch begins, and ``before``, the batches begun before it."""
    levels = [tables]
    while not levels[-1].where(F.col("_block") > 0).isEmpty():
        node, child = F.expr(f"_block div {fan}"), F.struct("_block", "table")
        gathered = levels[-1].groupBy(*groups, node.alias("_node")).agg(F.sort_array(F.collect_list(child)).alias("children"))
        nobody = F.transform(F.sequence(F.lit(0), F.lit(max_rows - 1)), lambda i: F.struct(i.cast("int").alias("to"), F.lit(0).cast("long").alias("n")))
        chained = F.aggregate("children", nobody.cast(_TABLE), lambda so_far, c: F.transform(so_far, lambda x: _through(c["table"], x)).cast(_TABLE))
        levels[-1] = checkpointed(gathered)
        levels.append(checkpointed(levels[-1].select(*groups, F.col("_node").alias("_block"), chained.alias("table"))))
    zero = F.lit(0).cast("long")
    entered = levels.pop().select(*groups, "_block", F.lit(0).alias("entry"), zero.alias("before"))
    while levels:
        nodes = _null_safe(levels.pop().withColumnRenamed("_node", "_up"), entered.withColumnRenamed("_block", "_up"), [*groups, "_up"])
        first = F.struct(F.col("entry").alias("to"), F.col("before").alias("n"))
        told = F.aggregate(
            "children",
            F.struct(first.alias("now"), F.expr("cast(array() as array<struct<_block:bigint,entry:int,before:bigint>>)").alias("out")),
            lambda so_far, c: F.struct(
                _through(c["table"], so_far["now"]).alias("now"),
                F.concat(so_far["out"], F.array(F.struct(
                    c["_block"].alias("_block"), so_far["now"]["to"].alias("entry"), so_far["now"]["n"].alias("before")
                ))).alias("out"),
            ),
            lambda so_far: so_far["out"],
        )
        entered = checkpointed(nodes.select(*groups, F.inline(told)))
    return entered


def _through(table: Column, x: Column) -> Column:
    """Where a batch that begins at row ``x.to`` of a block leads, with the starts counted on; the last block of a source may be
    left at once."""
    step = F.try_element_at(table, x["to"] + 1)
    return F.struct(F.coalesce(step["to"], F.lit(0)).alias("to"), (x["n"] + F.coalesce(step["n"], F.lit(0))).alias("n"))


def _starts(blocks: DataFrame, block_rows: int) -> DataFrame:
    """Add ``starts``: the rows of a block at which batches begin."""
    walked = F.aggregate(
        F.sequence(F.lit(0), F.least(F.size("next"), F.lit(block_rows)) - 1),
        F.struct(F.col("entry").alias("at"), F.expr("cast(array() as array<int>)").alias("starts")),
        lambda so_far, i: F.when(i == so_far["at"], F.struct(
            F.get(F.col("next"), i).alias("at"), F.concat(so_far["starts"], F.array(i.cast("int"))).alias("starts"),
        )).otherwise(so_far),
        lambda so_far: so_far["starts"],
    )
    return blocks.withColumn("starts", walked)


def _after_untimed(numbered_rows: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Batches of rows with a time are counted on from those of the rows without one."""
    untimed = numbered_rows.where(~F.col("_timed")).groupBy(*sources).agg((F.max("batch_no") + 1).alias("_untimed"))
    named = untimed.withColumnsRenamed({s: f"_of{i}" for i, s in enumerate(sources)})
    same = F.col("_timed")
    for i, s in enumerate(sources):
        same = same & F.col(s).eqNullSafe(F.col(f"_of{i}"))
    joined = numbered_rows.join(named, same, "left")
    return joined.withColumn("batch_no", F.col("batch_no") + F.coalesce("_untimed", F.lit(0).cast("long")))

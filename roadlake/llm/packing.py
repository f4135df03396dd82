"""Packing of documents into token sequences by first-fit decreasing.

Documents are tokenized and cut into full sequences and a rest in one pass; only lengths and checksums
(and the ids, when they are asked for) go on. Rests are dealt into random groups of bounded size, and each group is packed
on its own: longest first, each into the first sequence with room, which a tournament tree over the
sequences' free room finds in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from roadlake.llm.common import cut
from roadlake.llm.encoding import encoder, runs

#: Tokens of a sequence.
CAPACITY = 4096
#: Rests in a group, on average: what one task holds and packs at a time.
GROUP = 2_048
#: Characters of the texts encoded together.
AT_ONCE = 1_000_000


class Tournament:
    """Free room of sequences; each inner node holds the largest below it."""

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_with(self, size: int) -> int:
        """Take ``size`` from the first sequence that has it; its number. There must be one."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        found = node - self.leaves
        node //= 2
        while node:
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger
            node //= 2
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The sequence of each item; items of one size in the order given."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    tree, place = Tournament(capacity, len(sizes)), [0] * len(sizes)
    for i in order:
        place[i] = tree.first_with(sizes[i])
    return place


def _tokenized(batches: Iterable[pa.RecordBatch], definition: str, end: int, capacity: int, ids_too: bool) -> Iterator[pa.RecordBatch]:
    encode = encoder(definition)
    last = np.array([end], dtype="<u4").tobytes()
    for batch in batches:
        names, texts = batch.column(0), batch.column(1)
        for a, b in runs(pc.utf8_length(texts).to_pylist(), AT_ONCE):
            row, start, length, total, crc, kept = [], [], [], [], [], []
            for at, ids in enumerate(encode(texts[a:b].to_pylist()), start=a):
                ids += last
                n = len(ids) // 4
                for s in range(0, n, capacity):
                    piece = ids[4 * s : 4 * (s + capacity)]
                    row.append(at)
                    start.append(s)
                    length.append(len(piece) // 4)
                    total.append(n)
                    crc.append(zlib.crc32(piece))
                    if ids_too:
                        kept.append(piece)
            columns = [names.take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
            fields = ["name", "start", "length", "ids_crc32", "doc_tokens"]
            if ids_too:
                columns, fields = [*columns, pa.array(kept, pa.binary())], [*fields, "ids"]
            yield pa.RecordBatch.from_arrays(columns, fields)


def _packed(rests: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Rests of one group with their sequence and offset."""
    rests = rests.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
    sizes = rests["length"].to_numpy()
    place = np.array(first_fit_decreasing(sizes.tolist(), capacity))
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(sizes[order])
    starts = ends - sizes[order]
    first = np.r_[True, place[order][1:] != place[order][:-1]]
    offset = starts - np.maximum.accumulate(np.where(first, starts, 0))
    out = rests.iloc[order].drop(columns="row")
    return out.assign(sequence_id=out["grp"].astype("int64") * 2**32 + place[order], offset=offset)


def pack(
    docs: DataFrame,
    definition: str,
    end: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece of a document: where it starts and how long it is, its sequence and the offset there.

    A document is its token ids and then the id ``end``; a null text is empty. It is cut into pieces of ``capacity`` ids and a
    shorter one. ``ids_crc32`` is the checksum of a piece's ids as little-endian unsigned 32-bit numbers,
    ``doc_tokens`` the document's length, and ``ids``, if kept, the ids themselves in that form. Every row of ``docs`` is a
    document of its own, whatever its id; no rows give no pieces.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast(definition)
    rows = docs.select(F.col(id_col).alias("name"), F.col(text_col).alias("text"))
    kind = rows.schema["name"].dataType.simpleString()
    schema = f"name {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids
    made = rows.mapInArrow(lambda x: _tokenized(x, send.value, end, capacity, keep_ids), schema)
    # Numbered and written, so that a repeated task finds the same rows under the same numbers.
    pieces = cut(made.withColumn("row", F.monotonically_increasing_id()))
    full = pieces.where(F.col("length") == capacity)
    rests = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group))
    dealt = rests.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    packed = dealt.groupBy("grp").applyInPandas(
        lambda x: _packed(x, capacity), f"{schema}, grp int, sequence_id long, offset long"
    )
    columns = [F.col("name").alias(id_col), "start", "length", "ids_crc32", "doc_tokens"]
    after = ["ids"] * keep_ids
    # Whole sequences are numbered below zero, where no group's are.
    return packed.select(*columns, "sequence_id", "offset", *after).union(
        full.select(*columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *after)
    )

"""Conversations as token ids with a loss mask, assembled from tokens.

A turn is ``START role \\n text END \\n``. Role and text are encoded as segments of their own, so nothing merges across
their ends, and the reserved ids are spliced in between; no text can give them. Where each segment begins, and with it
the mask over the assistant's texts, follows from prefix sums over the sizes of segments. Control strings that
occur in a content are escaped, so that the output written out as text can be told apart as well.

Rows are sorted over all tasks by conversation and turn, so a conversation of any size is spread over them. A
turn's place is its distance from the first turn of the conversation in its task plus what earlier tasks hold
of the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadlake.llm import bpe
from roadlake.llm.encoding import as_bytes, runs
from roadlake.session import scratch_path

#: How the reserved ids are written out, and the role whose texts are learned.
START, END, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"
#: Characters that are encoded together.
AT_ONCE = 1_000_000

_OPENING, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""A text without ``<|``: a backslash more in every ``<``, backslashes, ``|``. Control strings all begin with ``<|``."""
    return _OPENING.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def _role_out(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def reserved(table: list[bytes]) -> tuple[int, int]:
    """Ids of ``START`` and ``END``: the first that the vocabulary leaves free."""
    return len(table), len(table) + 1


def _assembled(batches: Iterable[pa.RecordBatch], definition: str) -> Iterator[pa.RecordBatch]:
    """Turns in order as ids and masks, with their start and number among their conversation's turns in this task."""
    own = bpe.worker(definition)
    start, end = (as_bytes([i]) for i in reserved(own.table))
    after = own.encoder(["\n"])[0]
    heads: dict[str, bytes] = {}
    last, tokens, turns = object(), 0, 0
    for batch in batches:
        names, roles = batch.column(0).to_pylist(), [r or "" for r in batch.column(2).to_pylist()]
        for a, b in runs([len(t.as_py() or "") for t in batch.column(3)], AT_ONCE):
            bodies = own.encoder([escape(t or "") for t in batch.column(3).slice(a, b - a).to_pylist()])
            for role in {*roles[a:b]} - heads.keys():
                heads = heads if len(heads) < 10_000 else {}
                heads[role] = own.encoder([_role_out(role) + "\n"])[0]
            ids = []
            sizes = np.zeros((b - a, 3), dtype=np.int64)  # before the text, the text, after it
            for i, (role, body) in enumerate(zip(roles[a:b], bodies)):
                head = heads[role] if role in heads else own.encoder([_role_out(role) + "\n"])[0]
                ids.append(b"".join((start, head, body, end, after)))
                sizes[i] = 1 + len(head) // 4, len(body) // 4, 1 + len(after) // 4
            ends = np.cumsum(sizes.ravel()).reshape(sizes.shape)
            learned = np.array([r == LEARNED for r in roles[a:b]])
            steps = np.zeros(ends[-1, 2] + 1, dtype=np.int8)
            steps[ends[learned, 0]] += 1
            np.subtract.at(steps, ends[learned, 1], 1)
            mask = np.cumsum(steps[:-1], dtype=np.int8)
            edges = [0, *ends[:, 2].tolist()]
            starts, numbers = [], []
            for name, n in zip(names[a:b], sizes.sum(axis=1).tolist()):
                if name != last:
                    last, tokens, turns = name, 0, 0
                starts.append(tokens)
                numbers.append(turns)
                tokens, turns = tokens + n, turns + 1
            masks = [mask[i:j].tobytes() for i, j in pairwise(edges)]
            columns = [
                batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), batch.column(5).slice(a, b - a), pa.array(starts, pa.int64()),
                pa.array(numbers, pa.int64()), pa.array(ids, pa.binary()), pa.array(masks, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "part", "start", "number", "ids", "mask"])


def format_chats(
    rows: DataFrame, definition: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``number`` (from 0) and ``start`` (tokens before it) in its conversation, ``ids``
    (little-endian unsigned 32-bit) and ``mask`` (a byte for each id, 1 where it is learned). A conversation is its rows by ``number``.

    ``definition`` is the JSON of a byte-level BPE tokenizer; the first two ids beyond it stand for the ends of turns.
    Null texts and roles are empty. Rows come by turn, null first, rows of one turn by role, then in an order that only their texts
    decide; repeated rows are turns each. A null conversation is one, too. The result is read from a table.
    """
    spark = rows.sparkSession
    send = spark.sparkContext.broadcast(definition)
    chosen = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tie"),
    )
    # A number per row comes last, so that a range may end inside any number of equal rows.
    order = ["conv_id", "turn", "role", "tie", "row"]
    ordered = chosen.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = chosen.schema
    assembled = ordered.select("conv_id", "turn", "role", "text", "tie", F.spark_partition_id().alias("part")).mapInArrow(
        lambda x: _assembled(x, send.value),
        f"conv_id {kinds['conv_id'].dataType.simpleString()}, turn {kinds['turn'].dataType.simpleString()}, "
        "part int, start long, number long, ids binary, mask binary",
    )
    path = scratch_path(spark, "chats")
    assembled.write.parquet(path)
    turns = spark.read.schema(assembled.schema).parquet(path)
    # Conversations that lie in several tasks: the first and the last of a task at most, so two rows for each task.
    held = turns.groupBy("conv_id", "part").agg(F.max("number").alias("last"), F.max(F.struct("number", "start", F.octet_length("ids").alias("size"))).alias("x"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumns({
        "tokens": F.sum(F.col("x.start") + F.expr("x.size div 4")).over(earlier), "turns": F.sum(F.col("last") + 1).over(earlier),
    }).where("tokens is not null").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "tokens", "turns")
    none = F.lit(0).cast("long")
    placed = turns.join(F.broadcast(before), (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return placed.select(
        "conv_id", "turn", (F.col("number") + F.coalesce("turns", none)).alias("number"), (F.col("start") + F.coalesce("tokens", none)).alias("start"),
        "ids", "mask",
    )


def _read(batches: Iterable[pa.RecordBatch], definition: str) -> Iterator[pa.RecordBatch]:
    """Role, text, learned text and written-out length of formatted turns."""
    own = bpe.worker(definition)
    start, end = reserved(own.table)
    plain = lambda ids: bpe.decoded(ids.tobytes(), own.table)
    for batch in batches:
        out = []
        for ids, mask in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            ids, mask = np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.int8)
            marks = np.flatnonzero(ids >= len(own.table))
            if ids[marks].tolist() != [start, end] or marks[0] != 0 or len(mask) != len(ids):
                raise ValueError("not a formatted turn")
            inside, after = plain(ids[1 : marks[1]]), plain(ids[marks[1] + 1 :])
            role, text = inside.split("\n", 1)
            learned = plain(ids[mask == 1])
            out.append((_role_in(role), unescape(text), unescape(learned), len(START) + len(inside) + len(END) + len(after)))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.string(), pa.int64()))] if out else []
        if columns:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["conv_id", "number", "role", "text", "learned", "chars"])


def read_back(formatted: DataFrame, definition: str) -> DataFrame:
    """``conv_id``, ``number``, ``role``, ``text``, ``learned`` (text under the mask) and ``chars`` (code points of the turn written out) of
    every formatted turn, from its ids and mask alone. Null roles and texts come back empty."""
    send = formatted.sparkSession.sparkContext.broadcast(definition)
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "number", "ids", "mask").mapInArrow(
        lambda x: _read(x, send.value), f"conv_id {kind}, number long, role string, text string, learned string, chars long"
    )


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose turns come in order, held a turn at a time."""
    fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    name, state = None, None

    def row() -> tuple:
        n, turns, loss_chars, loss, chars = state
        return name, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t or kind) for c, t in zip(zip(*rows), kinds)], fields)

    kind = None
    for batch in batches:
        kind, done = batch.column(0).type, []
        for conv, role, text, learned, chars in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
            if state is None or conv != name:
                if state is not None:
                    done.append(row())
                name, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            state[2] += len(learned)
            state[3].update(learned.encode())
            state[4] += chars
        if done:
            yield batch_of(done, kind)
    if state is not None:
        yield batch_of([row()], kind)


def digest(turns: DataFrame) -> DataFrame:
    """One row per conversation of what :func:`read_back` gives: ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``.

    A digest takes its turns one after the other, so a conversation is one task's, which streams it.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    in_order = turns.repartition("conv_id").sortWithinPartitions("conv_id", "number")
    return in_order.mapInArrow(
        _digested, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

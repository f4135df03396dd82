"""Byte-level BPE of whole texts, and back.

The pre-tokenizer cuts a text into parts that are encoded independently; short parts are encoded
once per worker. A long stretch that it does not cut is encoded by tree concatenation: both halves of a
half and so on are encoded on their own, and where two meet, a window around the join is encoded
again and grows until its first token and its last token are the ones that the two sides have there. All
neighbouring tokens then are neighbours in some exact encoding, which makes the whole exact: a
sequence of tokens is the encoding of its text if and only if each neighbouring pair is that of its own.

Texts with a very long uncut stretch are dealt out in leaves over all tasks, encoded there, and
joined per document.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from roadlake.llm.common import cut, kept
from roadlake.llm.encoding import Encoder, as_bytes, byte_table, runs, unsplit_tokenizer

#: Characters of a stretch without a cut from which on it is encoded as a tree, and those of a leaf.
LONG, LEAF = 1024, 512
#: Characters of such a stretch from which on its leaves are dealt over all tasks, and those of a dealt leaf.
DEALT, DEALT_LEAF = 262_144, 65_536
#: Tokens on each side of a join in its first window.
WINDOW = 8
#: Parts a worker remembers; fewer than when packing, as it holds a second tokenizer and the decoded texts too.
REMEMBERED = 500_000
#: Characters of the texts encoded together.
AT_ONCE = 1_000_000


class Tree:
    """Encodes and joins stretches of text that the merges see as one piece."""

    def __init__(self, definition: str):
        self.tokenizer = unsplit_tokenizer(definition)
        self.bytes = byte_table(self.tokenizer.get_vocab(with_added_tokens=False))

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, ids: list[int], wanted: int, from_end: bool) -> int:
        """At least ``wanted`` tokens from one end such that the cut lies between characters."""
        n = min(wanted, len(ids))
        while n < len(ids):
            after = self.bytes[ids[-n] if from_end else ids[n]]
            if after[0] & 0xC0 != 0x80:
                break
            n += 1
        return n

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the concatenation of two encoded texts."""
        if not left or not right:
            return left + right
        wanted = WINDOW
        while True:
            a, b = self._cut(left, wanted, True), self._cut(right, wanted, False)
            window = left[len(left) - a :] + right[:b]
            again = self.plain([b"".join(self.bytes[i] for i in window).decode("utf-8")])[0]
            if (a == len(left) or again[0] == window[0]) and (b == len(right) or again[-1] == window[-1]):
                return left[: len(left) - a] + again + right[b:]
            wanted *= 2

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        """Joins neighbours pair by pair, level by level."""
        while len(parts) > 1:
            paired = [self.join(x, y) for x, y in zip(parts[::2], parts[1::2])]
            parts = paired + ([parts[-1]] if len(parts) % 2 else [])
        return parts[0] if parts else []

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        return self.concatenate(self.plain([text[i : i + leaf] for i in range(0, len(text), leaf)]))


class _Worker:
    """What a worker process keeps between tasks: an encoder that takes long pre-tokens as trees, and a decoder."""

    def __init__(self, definition: str):
        self.tree, self.encoder = Tree(definition), Encoder(definition)
        self.encoder.long, self.encoder.of_long = LONG, self.tree.encode
        self.encoder.remembered = REMEMBERED
        self.library, self.encoder.library = self.encoder.library, self._library
        self.stretch = re.compile(r"\S{%d}|\s{%d}" % (LONG, LONG))
        self.special = re.compile("(" + "|".join(map(re.escape, self.encoder.special)) + ")")
        self.table = vocabulary_bytes(definition)

    def pre_tokens(self, text: str) -> Iterator[str]:
        """A text cut by the library's own pre-tokenizer, special tokens apart."""
        for part in self.special.split(text):
            if part in self.encoder.special:
                yield part
            elif part:
                for _, (start, end) in self.encoder.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    yield part[start:end]

    def of_tokens(self, tokens: Iterable[str]) -> array:
        encoder, ids = self.encoder, array("I")
        for token in tokens:
            if token in encoder.special:
                ids.append(encoder.special[token])
            else:
                ids.extend(encoder.merged(token) if len(token) < LONG else self.tree.encode(token))
        return ids

    def _library(self, texts: list[str]) -> list[bytes]:
        """Texts for the library; those with a long stretch go token by token."""
        long = [bool(self.stretch.search(t)) for t in texts]
        known = iter(self.library([t for t, is_long in zip(texts, long) if not is_long]))
        return [as_bytes(self.of_tokens(self.pre_tokens(t))) if is_long else next(known) for t, is_long in zip(texts, long)]


def vocabulary_bytes(definition: str) -> list[bytes]:
    """Bytes of each id of a tokenizer."""
    parsed = json.loads(definition)
    return byte_table(parsed["model"]["vocab"] | {t["content"]: t["id"] for t in parsed["added_tokens"]})


def decoded(ids: bytes, table: list[bytes]) -> str:
    """Text of little-endian unsigned 32-bit ids, given the bytes of each."""
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def worker(definition: str) -> _Worker:
    """Encoder and tree of a definition, kept between tasks."""
    return kept(("bpe", definition), lambda: _Worker(definition))


def _in_place(batches: Iterable[pa.RecordBatch], definition: str, back: bool) -> Iterator[pa.RecordBatch]:
    """Ids of whole texts, a few texts at a time, and what they decode to."""
    own = worker(definition)
    for batch in batches:
        names, texts = batch.column(0), batch.column(1)
        for a, b in runs(pc.utf8_length(texts).to_pylist(), AT_ONCE):
            ids = own.encoder(texts[a:b].to_pylist())
            columns = [names[a:b], pa.array(ids, pa.binary())]
            if back:
                columns.append(pa.array([decoded(x, own.table) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["name", "ids", "decoded"][: len(columns)])


def _leaves(batches: Iterable[pd.DataFrame], definition: str) -> Iterator[pd.DataFrame]:
    """Texts as rows to encode: short pre-tokens together, and each leaf of a long one apart."""
    own = worker(definition)
    row = lambda *values: pd.DataFrame([values], columns=["row", "part", "tree", "tokens"])
    for pdf in batches:
        for name, text in zip(pdf["row"], pdf["text"]):
            part, held, size = 0, [], 0
            for n, token in enumerate(own.pre_tokens(text)):
                leaves = [token[i : i + DEALT_LEAF] for i in range(0, len(token), DEALT_LEAF)]
                if held and size + len(token) > DEALT_LEAF:
                    yield row(name, part, -1, held)
                    part, held, size = part + 1, [], 0
                if len(leaves) == 1:
                    held.append(token)
                    size += len(token)
                else:
                    for leaf in leaves:
                        yield row(name, part, n, [leaf])
                        part += 1
            if held:
                yield row(name, part, -1, held)


def _encode_leaves(batches: Iterable[pd.DataFrame], definition: str) -> Iterator[pd.DataFrame]:
    own = worker(definition)
    for pdf in batches:
        ids = [
            as_bytes(own.of_tokens(tokens) if tree < 0 else own.tree.encode(tokens[0]))
            for tree, tokens in zip(pdf["tree"], pdf["tokens"])
        ]
        yield pdf[["row", "part", "tree"]].assign(ids=ids)


def _join_leaves(pdf: pd.DataFrame, definition: str) -> pd.DataFrame:
    """Ids of one text from those of its parts."""
    own, out = worker(definition), []
    pdf = pdf.sort_values("part")
    for tree, parts in pdf.groupby((pdf["tree"] != pdf["tree"].shift()).cumsum()):
        ids = [np.frombuffer(x, "<u4") for x in parts["ids"]]
        if parts["tree"].iat[0] < 0:
            out += ids
        else:
            out.append(np.array(own.tree.concatenate([x.tolist() for x in ids]), dtype="<u4"))
    return pd.DataFrame({"row": [pdf["row"].iat[0]], "ids": [np.concatenate(out).astype("<u4").tobytes()]})


def _is_dealt(text: Column) -> Column:
    """True for texts with a stretch of at least ``DEALT`` characters that nothing cuts."""
    stretch = r"(?<!\S)\S{%d}|(?<!\s)\s{%d}" % (DEALT, DEALT)
    return F.coalesce((F.octet_length(text) >= DEALT) & text.rlike(stretch), F.lit(False))


def encode(docs: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """``id_col`` and ``ids`` (binary, little-endian unsigned 32-bit) of every row, exactly as the library encodes.

    With ``back`` also ``decoded``, the text that the ids stand for, as ``decode`` gives it, from the same pass.

    ``definition`` is the JSON of a byte-level BPE tokenizer without a normalizer; special tokens are not added, but
    found where a text writes them out, as the library does. Null and empty texts have no ids. Ids of rows,
    null and repeated ones too, are passed through.
    """
    send = docs.sparkSession.sparkContext.broadcast(definition)
    rows = docs.select(F.col(id_col).alias("name"), F.col(text_col).alias("text"))

    kind = rows.schema["name"].dataType.simpleString()
    near = rows.where(~_is_dealt(F.col("text"))).mapInArrow(
        lambda x: _in_place(x, send.value, back), f"name {kind}, ids binary" + ", decoded string" * back
    )
    # Numbered before the checkpoint, so that a lost task cannot number a row anew.
    far = cut(rows.where(_is_dealt(F.col("text"))).withColumn("row", F.monotonically_increasing_id()))
    pieces = far.select("row", "text").mapInPandas(
        lambda x: _leaves(x, send.value), "row long, part int, tree int, tokens array<string>"
    )
    spread = pieces.repartition(F.xxhash64("row", "part"))
    encoded = spread.mapInPandas(lambda x: _encode_leaves(x, send.value), "row long, part int, tree int, ids binary")
    joined = encoded.groupBy("row").applyInPandas(lambda x: _join_leaves(x, send.value), "row long, ids binary")
    rest = far.join(joined, "row").select("name", "ids")
    return near.union(decode(rest, definition) if back else rest).withColumnRenamed("name", id_col)


def decode(encoded: DataFrame, definition: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; bytes that are no UTF-8 become replacement characters. Null ids give null."""
    send = encoded.sparkSession.sparkContext.broadcast(vocabulary_bytes(definition))

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else decoded(x, send.value) for x in ids], dtype=object)

    return encoded.withColumn(text_col, text(ids_col))

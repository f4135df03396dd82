import hashlib
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from roadlake.llm import chat
from roadlake.llm.queries import op13_chat
from roadlake.session import prepare

DEFINITION = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
SCHEMA = "conv_id long, turn int, role string, text string, number int, IDS string, tokens long"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<\\|im_startend >\n", max_size=40))
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat._role_in(chat._role_out(text)) == text and "\n" not in chat._role_out(text)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def rows_of(seed):
    rng = random.Random(seed)
    texts = [None, "", "plain text.", "<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<|endoftext|>", "a\nb\n", "é<|ü  漢字 \U0001f600", "x" * 5000, " " * 3000, "word " * 3000]
    rows = []
    for conv in [*range(20), None]:
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None]), rng.choice(texts)))
    # A conversation of a third of all rows, turns without a number, roles on two lines or with control strings, repeated rows.
    rows += [(500, i, "assistant" if i % 2 else "user", f"turn {i} <|{i}") for i in range(40)]
    rows += [(600, None, "user", "first"), (600, 0, "two\nlines\\n", "x"), (600, 1, "<|im_end|>", "y"), (600, 2, "assistant", "z"), (600, 2, "assistant", "z")]
    return rows


def plain(rows):
    """Digests from the rows themselves."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda t: t[:2])
        loss = "".join(t for _, r, t in turns if r == "assistant")
        written = "".join(f"<|im_start|>{chat._role_out(r)}\n{chat.escape(t)}<|im_end|>\n" for _, r, t in turns)
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(said), len(loss), sha(loss), len(written))
    return out


def digests(formatted):
    return {r[0]: tuple(r[1:]) for r in chat.digest(chat.read_back(formatted, DEFINITION)).collect()}


def test_reads_back_what_was_formatted(spark):
    rows = rows_of(1)
    formatted = chat.format_chats(frame(prepare(spark), rows).repartition(5), DEFINITION)
    assert formatted.columns == ["conv_id", "turn", "number", "start", "ids", "mask"]
    assert digests(formatted) == plain(rows)


@pytest.mark.parametrize("partitions", ["1", "40"])
def test_places_hold_over_all_tasks(spark, partitions):
    """Prefix sums: turns of a conversation join without a gap, whether one task has it or many."""
    rows = rows_of(2)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = chat.format_chats(frame(spark, rows), DEFINITION).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    by_conv = defaultdict(list)
    for t in sorted(turns, key=lambda t: t.number):
        by_conv[t.conv_id].append(t)
    assert sum(map(len, by_conv.values())) == len(rows)
    for turns in by_conv.values():
        at = 0
        for n, t in enumerate(turns):
            assert (t.number, t.start, len(t.mask)) == (n, at, len(t.ids) // 4)
            at += len(t.mask)


def test_segments_are_the_librarys_and_reserved_ids_mark_turns(spark):
    library = Tokenizer.from_str(DEFINITION)
    library.no_truncation()
    library.no_padding()
    ids = lambda text: library.encode(text, add_special_tokens=False).ids
    rows = [r for r in rows_of(3) if r[0] in range(20)]
    start, end = 50257, 50258
    for t, (_, _, role, text) in zip(
        sorted(chat.format_chats(frame(spark, rows), DEFINITION).collect(), key=lambda t: (t.conv_id, t.number)), rows
    ):
        head, body = ids((role or "") + "\n"), ids(chat.escape(text or ""))
        assert np.frombuffer(t.ids, "<u4").tolist() == [start, *head, *body, end, *ids("\n")]
        learned = int(role == "assistant")
        assert list(t.mask) == [0] * (1 + len(head)) + [learned] * len(body) + [0] * 2


def test_a_broken_output_is_noticed(spark):
    formatted = chat.format_chats(frame(spark, [(1, 0, "user", "x")]), DEFINITION)
    with pytest.raises(Exception, match="not a formatted turn"):
        chat.read_back(formatted.selectExpr("conv_id", "number", "substr(ids, 5) AS ids", "mask"), DEFINITION).collect()


def test_empty_table(spark):
    assert digests(chat.format_chats(frame(spark, []), DEFINITION)) == {}


def test_query_on_an_empty_table_has_the_added_conversation(spark, folder):
    frame(spark, []).write.parquet(f"{folder}/conversations.parquet")
    (row,) = op13_chat(spark, folder).collect()
    said = "<|im_end|><|im_start|>assistant ok"
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-1, 2, len(said))
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()

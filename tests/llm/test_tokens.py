import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from roadlake.llm import bpe
from roadlake.llm.encoding import Encoder, runs
from roadlake.llm.packing import first_fit_decreasing, pack
from roadlake.llm.token_counts import _Counts, count_tokens, piece_counter, zipf_scores

SCHEMA = "doc_id long, text string, ids int, Name string"
DEFINITIONS = {n: Path(public_tokenizers.path(n)).read_text() for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}
ODD = [
    None, "", " ", "\n\n x  \n", "don't we'll''s  \n\n  x ", "x <|endoftext|>y <|ENDOFTEXT|>", "ÀÉÎ ǅ İ ſ ß", "é \x1c \x85 \xa0x",
    "漢字 かな 😀😀", "½²³ 12345 a1b2", "x" * 3000, " " * 3000 + "é" * 1500 + "\n", "漢" * 1200 + " ok", "the " * 4000,
]
CHARACTERS = st.text(st.sampled_from("ab THE\n\t'.,12éß漢😀́\xa0|<>") | st.characters(codec="utf-8"), max_size=60)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0, "n") for i, t in enumerate(texts)], SCHEMA)


def ids_of(definition, text):
    return Tokenizer.from_str(definition).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", sorted(DEFINITIONS))
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(CHARACTERS, max_size=5))
def test_encoder_is_the_library(name, texts):
    encode, library = ENCODERS[name]
    for text, ids in zip(texts + ODD, encode(texts + ODD)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


ENCODERS = {n: (Encoder(d), Tokenizer.from_str(d)) for n, d in DEFINITIONS.items()}
TREE = bpe.Tree(DEFINITIONS["byte_bpe_50k.json"])


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("abcdeinghto '.é漢😀0 ="), min_size=1, max_size=300), leaf=st.integers(1, 40))
def test_tree_concatenation_is_the_encoding(text, leaf):
    assert TREE.encode(text, leaf) == TREE.plain([text])[0]


def test_tree_concatenation_of_repeats_and_words():
    draw = random.Random(4)
    for _ in range(100):
        words = [draw.choice(["the", "ing", "ation", "a", "aa", "=", "é", "00"]) for _ in range(200)]
        text = "".join(words)
        assert TREE.encode(text, draw.choice([3, 7, 64])) == TREE.plain([text])[0]


def test_bpe_round_trip(spark):
    definition = DEFINITIONS["byte_bpe_50k.json"]
    draw = random.Random(1)
    long = ["".join(draw.choice("abcdefgh") for _ in range(300_000)), "x \n\n" + "漢é" * 140_000 + "\n\n y", " " * 270_000 + "z"]
    texts = ODD + long + ["same"] * 3
    rows = bpe.decode(bpe.encode(frame(spark, texts), definition), definition).collect()
    assert sorted(bpe.encode(frame(spark, texts), definition, back=True).collect()) == sorted(rows)
    assert len(rows) == len(texts)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids_of(definition, texts[r.doc_id])
        assert r.decoded == (texts[r.doc_id] or "")
    assert bpe.encode(frame(spark, []), definition).count() == 0


def test_decode_of_broken_bytes(spark):
    definition = DEFINITIONS["byte_bpe_50k.json"]
    library = Tokenizer.from_str(definition)
    draw = random.Random(2)
    lists = [[draw.randrange(50257) for _ in range(20)] for _ in range(50)]
    rows = [(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(lists)] + [(99, None)]
    got = {r.doc_id: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), definition).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)} | {99: None}


READ = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SCORED = zipf_scores([READ.id_to_piece(i) for i in range(READ.get_piece_size())])
UNIGRAM = Tokenizer(models.Unigram(SCORED, 0, True))
UNIGRAM.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
COUNTS = _Counts(piece_counter(SCORED))


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("ab theing\n▁<0xA>é漢😀") | st.characters(codec="utf-8"), max_size=50))
def test_counts_are_those_of_the_library(text):
    assert COUNTS.of_text(text) == len(UNIGRAM.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(
    pieces=st.dictionaries(st.text(st.sampled_from("ab▁"), min_size=1, max_size=4), st.integers(-3, 0), min_size=1, max_size=8),
    text=st.text(st.sampled_from("abc "), max_size=14),
)
def test_ties_fall_as_in_the_library(pieces, text):
    scored = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] + [(p, float(s)) for p, s in pieces.items()]
    library = Tokenizer(models.Unigram(scored, 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    assert _Counts(piece_counter(scored)).of_text(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_tokens_of_odd_rows(spark):
    rows = [(i, t, 0, "n") for i, t in enumerate(ODD)] * 2 + [(None, "the end", 0, "n")]
    out = count_tokens(spark.createDataFrame(rows, SCHEMA), SCORED).collect()
    assert len(out) == len(rows)
    for r in out:
        text = "the end" if r.doc_id is None else ODD[r.doc_id]
        assert r.n_tokens == len(UNIGRAM.encode(text or "", add_special_tokens=False).ids)
    assert count_tokens(frame(spark, []), SCORED).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing(sizes):
    room, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        spot = next((b for b, r in enumerate(room) if r >= sizes[i]), None)
        if spot is None:
            spot = len(room)
            room.append(50)
        room[spot] -= sizes[i]
        want[i] = spot
    assert first_fit_decreasing(sizes, 50) == [want[i] for i in range(len(sizes))]


@pytest.mark.parametrize("options", [{}, {"capacity": 64, "group": 7, "keep_ids": True}])
def test_packing_places_every_id_once(spark, options):
    definition, capacity = DEFINITIONS["word_bpe_49k.json"], options.get("capacity", 4096)
    draw = random.Random(3)
    texts = ODD + [" ".join(draw.choice(["the", "Ending", "漢", "of"]) for _ in range(draw.randrange(300))) for _ in range(80)]
    rows = [(i, t, 0, "n") for i, t in enumerate(texts)] + [(0, texts[0], 0, "n")] * 3
    out = pack(spark.createDataFrame(rows, SCHEMA), definition, **options).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array(ids_of(definition, text) + [2], "<u4")
        copies = 4 if i == 0 else 1
        pieces = sorted(by_doc[i], key=lambda r: r.start)[::copies]
        assert len(by_doc[i]) == copies * len(pieces) and sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            part = ids[p.start : p.start + p.length].tobytes()
            assert p.doc_tokens == len(ids) and zlib.crc32(part) == p.ids_crc32
            assert not options.get("keep_ids") or bytes(p.ids) == part
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        used += at
    if not options:
        assert len(by_sequence) <= -(-used // capacity) + 2
    assert pack(frame(spark, []), definition).count() == 0


def test_runs_cover_everything():
    assert list(runs([3, None, 4, 10, 1], 5)) == [(0, 3), (3, 4), (4, 5)]
    assert list(runs([], 5)) == []

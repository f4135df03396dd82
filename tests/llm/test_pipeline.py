"""Each stage of the pipeline against a plain version, on what the stage before it kept."""

import zlib
from pathlib import Path

import numpy as np
import pytest
from test_lines import plain as plain_lines
from test_minhash import plain as plain_components
from test_secrets import CONTRACT, plain as plain_secrets
from tokenizers import Tokenizer

import corpus_pipeline
from roadlake.llm.toxicity import toxicity
from roadlake.session import scratch_path

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and rows out of every stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(stages):
    assert list(stages) == ["documents", "toxicity", "line_dedup", "near_dedup", "secret_scan", "packing"]
    assert all(df.columns == COLUMNS for name, df in stages.items() if name != "packing")
    for name in ("line_dedup", "near_dedup", "secret_scan"):
        assert all(r.n_chars == len(r.text) for r in stages[name].collect())


def test_toxicity(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in toxicity(stages["documents"], labels).collect()}
    assert texts(stages["toxicity"]) == {i: t for i, t in texts(stages["documents"]).items() if not scores[i]}
    assert 0 < sum(scores.values()) < 0.15 * len(scores)


def test_line_dedup(stages):
    rows = [(r.doc_id, r.source, r.text) for r in stages["toxicity"].collect()]
    want = dict(plain_lines(rows, 0.1, 2, corpus_pipeline.LINE_MAX_LOSS))
    assert texts(stages["line_dedup"]) == want != {i: t for i, _, t in rows}


def test_secret_scan(stages):
    after = texts(stages["secret_scan"])
    for i, text in texts(stages["near_dedup"]).items():
        masked, at = "", 0
        for start, _, stop, _ in plain_secrets(text):
            if start >= at:
                masked += text[at:start] + "[SECRET]"
            at = max(at, stop)
        assert after[i] == masked + text[at:]
        assert not plain_secrets(after[i])
    assert len(CONTRACT) == 3


def test_packing(stages):
    library = Tokenizer.from_str(Path(corpus_pipeline.TOKENIZER).read_text())
    pieces = {}
    for r in stages["packing"].collect():
        pieces.setdefault(r.doc_id, []).append(r)
    before = texts(stages["secret_scan"])
    assert set(pieces) == set(before)
    for i, text in before.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(pieces[i], key=lambda r: r.start):
            assert p.start == at and zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(got.select(key).collect()) == sorted(stages["packing"].select(key).collect())


def test_odd_documents_pass_every_stage(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [
        (None, None, None, None, None), (None, "text without id", "en", None, 15), (-1, None, "en", "s", None), (-2, "", "en", "s", 0),
        (-3, "the same", "en", "s", 8), (-3, "the same", "en", "s", 8), (-4, "long " * 60_000, "en", "s", 300_000), (-5, "\n\n", None, "s", 2),
    ]
    frame = documents.limit(30).union(spark.createDataFrame(odd, documents.schema))
    n = frame.count()
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-odd-{name}")
        stage(spark, frame, SF_DIR).write.parquet(path)
        frame = spark.read.parquet(path)
        assert n - 6 <= frame.count() or name == "packing"
    assert {r.doc_id for r in frame.collect()} >= {None, -1, -2, -3, -4, -5}
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_near_dedup_takes_pairs_from_eighty_hundredths(spark):
    words = [f"w{i}" for i in range(104)]
    rows = [(1, 100), (2, 82), (3, 60)]  # shingles; 82 and 60 of 100
    frame = spark.createDataFrame([(i, " ".join(words[: n + 4]), "en", "s", 0) for i, n in rows], "doc_id long, text string, lang string, source string, n_chars int")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, frame, SF_DIR).collect()) == [1, 3]


def test_near_dedup_matches_all_pairs_from_eighty_hundredths(stages):
    before = texts(stages["line_dedup"])
    # Only pairs that share a shingle can link, so the plain version gets documents in groups that do.
    _, least = plain_components(sorted(before.items()), 80)
    assert texts(stages["near_dedup"]) == {i: t for i, t in before.items() if least[i] == i}


def test_line_dedup_cleans_documents_that_are_mostly_boilerplate(spark):
    licence = "This text may be passed on by everybody under the licence of its source."
    rows = [(i, f"{licence}\nown {i}", "en", "s", 0) for i in range(8)] + [(100 + i, "copied\ntext", "en", "s", 0) for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = texts(corpus_pipeline.line_dedup(spark, frame, SF_DIR))
    assert got == {i: f"own {i}" for i in range(8)} | {100 + i: "copied\ntext" for i in range(8)}

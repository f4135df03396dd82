import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import language_id
from roadlake.llm.common import held_out
from roadlake.llm.language_id import UNDETERMINED, WINDOW, Network, Reader, fit, gradients, languages, new_network, predict

WORDS = {
    "aa": "the of and with house garden morning letter people water".split(),
    "bb": "der und nicht für haus garten morgen straße über wasser".split(),
    "cc": "да нет дом вода утро письмо люди хлеб река зима".split(),
}
SCHEMA = "doc_id long, text string, lang string, score string, found int"


def make(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(sorted(WORDS))
        rows.append((i, " ".join(draw.choice(WORDS[lang]) for _ in range(draw.randrange(3, 80))), lang, "x", 1))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.createDataFrame(make(1, 400), SCHEMA).cache()
    return docs, fit(docs, ~held_out(F.col("doc_id"), 4, 2))


def test_gradients_match_differences():
    draw = np.random.default_rng(1)
    windows = draw.choice(np.frombuffer(b"abc de\xc3\xa9", np.uint8), (6, 3))
    truth = np.array([0, 1, 1])
    network = new_network(["x", "y"], units=3)
    network = Network(network.languages, *(tuple(w.astype(np.float64) for w in d) for d in (network.forward, network.backward)),
                      network.out.astype(np.float64), network.bias.astype(np.float64))
    _, grads = gradients(network, windows, truth)
    for weight, grad in zip(network.weights(), grads):
        flat = [np.unravel_index(i, weight.shape) for i in np.argsort(-np.abs(grad), axis=None)[:5]]
        for at in flat:
            old = weight[at]
            losses = []
            for step in (1e-3, -1e-3):
                weight[at] = old + step
                losses.append(gradients(network, windows, truth)[0])
            weight[at] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - grad[at]) < 1e-3 + 0.02 * abs(grad[at])


def test_reader_gives_the_network_s_means(trained):
    """Every byte of a long text counts, and windows do not depend on their neighbours."""
    _, network = trained
    text = " ".join(WORDS["bb"]) * 40 + "1234" + " ".join(WORDS["cc"]) * 30
    data = text.encode().lower()
    total, seen = np.zeros(len(network.languages)), 0
    for at in range(0, len(data), WINDOW):
        window = np.frombuffer(data[at : at + WINDOW].ljust(WINDOW), np.uint8)[:, None]
        ahead, _ = language_id._read(window, network.forward)
        behind, _ = language_id._read(window[::-1], network.backward)
        p = np.exp(np.concatenate([ahead, behind[::-1]], axis=2) @ network.out + network.bias)[:, 0]
        mask = language_id._IS_LETTER[window[:, 0]]
        total += (p / p.sum(axis=1, keepdims=True))[mask].sum(axis=0)
        seen += mask.sum()
    ((lang, got),) = Reader(network)([text])
    assert lang == network.languages[int(total.argmax())] and abs(got - total.max() / seen) < 1e-4


def test_held_out_accuracy(spark, trained):
    docs, _ = trained
    out = languages(docs)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = out.collect()
    assert len(rows) == 400 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    aside = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in aside) >= 0.97 * len(aside)


def test_odd_rows(spark, trained):
    docs, network = trained
    odd = [(None, "der garten und das wasser"), (1, None), (2, ""), (3, "12 !! 34"), (4, "　 "), (5, "the water " * 30_000), (5, "the water " * 30_000)]
    rows = predict(spark.createDataFrame([(*r, None, "x", 0) for r in odd], SCHEMA), network).collect()
    got = {(r.doc_id, r.lang_pred) for r in rows}
    assert len(rows) == 7 and got == {(None, "bb"), (1, UNDETERMINED), (2, UNDETERMINED), (3, UNDETERMINED), (4, UNDETERMINED), (5, "aa")}
    empty = spark.createDataFrame([], SCHEMA)
    assert languages(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in languages(unlabelled).collect()} == {UNDETERMINED}


def test_what_is_held_out_is_not_learned(spark, trained):
    docs, network = trained
    aside = held_out(F.col("doc_id"), 4, 2)
    changed = docs.withColumn("lang", F.when(aside, "zz").otherwise(F.col("lang"))).withColumn("text", F.when(aside, "qqq").otherwise(F.col("text")))
    again = fit(changed, ~aside)
    assert again.languages == network.languages and all((a == b).all() for a, b in zip(again.weights(), network.weights()))


def test_rare_languages_are_learned_and_repeated_ids_stay_within_the_bound(spark, monkeypatch):
    """Three documents of a script among hundreds of another, and one id on thousands of rows."""
    draw = random.Random(3)
    common = [(i, " ".join(draw.choices(WORDS["aa"], k=20)), "aa", "x", 1) for i in range(400)]
    rare = [(1000 + i, " ".join(draw.choices(WORDS["cc"], k=20)), "cc", "x", 1) for i in range(3)]
    hot = [(5000, " ".join(draw.choices(WORDS["bb"], k=8)), "bb", "x", 1) for _ in range(2000)]
    seen = []
    monkeypatch.setattr(language_id, "train", lambda data, truth, names: seen.append((len(data), names)) or new_network(names, units=3))
    fit(spark.createDataFrame(common + rare + hot, SCHEMA), F.lit(True), limit=10)
    assert seen[0][0] <= 10 * language_id.WINDOWS and seen[0][1] == ["aa", "bb", "cc"]

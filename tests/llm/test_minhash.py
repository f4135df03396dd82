import random
import re

import numpy as np
import pytest

from roadlake.llm import minhash
from roadlake.llm.minhash import drop_near_duplicates, least_matches, near_duplicates, shingle_sets, signature, surviving

SCHEMA = "doc_id long, text string, component int, Digest string"
VOCABULARY = [f"w{i}" for i in range(400)]


def plain_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain(rows, percent=85):
    """Component of each id, from all pairs."""
    sets = {i: plain_set(t) for i, t in rows if i is not None}
    links = [
        (i, j) for i, a in sets.items() for j, b in sets.items()
        if i < j and a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    least = {i: i for i in sets}
    for _ in range(len(least)):
        before = dict(least)
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
        if before == least:
            break
    return sets, least


def varied(draw, base, edits):
    words = list(base)
    for _ in range(edits):
        words[draw.randrange(len(words))] = draw.choice(VOCABULARY)
    return " ".join(words)


def corpus(seed=1):
    """Chains and clouds of near copies, exact copies, texts that share a passage, odd texts."""
    draw = random.Random(seed)
    rows = []
    for _ in range(4):
        base = [draw.choice(VOCABULARY) for _ in range(120)]
        rows += [varied(draw, base, draw.randrange(5)) for _ in range(25)]
    chain = [draw.choice(VOCABULARY) for _ in range(150)]
    for _ in range(15):
        chain[draw.randrange(150)] = draw.choice(VOCABULARY)
        rows.append(" ".join(chain))
    passage = " ".join(draw.choice(VOCABULARY) for _ in range(60))
    rows += [passage + " " + " ".join(draw.choice(VOCABULARY) for _ in range(60)) for _ in range(25)]
    rows += ["Exact COPY of one text here"] * 30 + ["exact copy of one  text\\there".replace("\\t", "\t")] * 3
    rows += [None, "", " \n ", "one", "One", "two words", "É x", "é x", "a\xa0b c", "漢 字 かな 文 だ よ"]
    rows += [" ".join(draw.choice(VOCABULARY) for _ in range(30_000))]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("tile", [1024, 6])
def test_matches_all_pairs(spark, tile):
    rows = corpus()
    rows += rows[:4] + [(None, "exact copy of one text here")]
    sets, least = plain(rows)
    out = near_duplicates(spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA), tile=tile)
    assert out.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.n_shingles, r.component_id, r.kept) == (2, None, None)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), least[r.doc_id], least[r.doc_id] == r.doc_id)


def test_links_beside_the_hub_are_found(spark):
    """A bucket's smallest id links with none of its members, which link among themselves."""
    draw = random.Random(9)
    passage = [draw.choice(VOCABULARY) for _ in range(200)]
    far = " ".join(passage[:150]) + " " + " ".join(draw.choice(VOCABULARY) for _ in range(60))
    rows = [(0, far)] + [(i, varied(draw, passage, 2)) for i in range(1, 40)]
    _, least = plain(rows)
    got = near_duplicates(spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == least
    assert len(set(least.values())) < 40


def test_drop_keeps_one_of_each(spark):
    rows = corpus(2)
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows + rows[:7] + [(None, "one")]], SCHEMA)
    _, least = plain(rows)
    out = drop_near_duplicates(frame)
    assert out.columns == frame.columns
    got = sorted((r.doc_id for r in out.collect()), key=str)
    assert got == sorted([i for i in least if least[i] == i] + [None], key=str)
    assert drop_near_duplicates(frame.limit(0)).count() == near_duplicates(frame.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    a = draw.integers(0, 2**63, 3000).astype(np.uint64)
    for share in (0.5, 0.9):
        common = int(3000 * share)
        b = np.concatenate([a[:common], draw.integers(0, 2**63, 3000 - common).astype(np.uint64)])
        jaccard = common / (6000 - common)
        assert abs((signature(a) == signature(b)).mean() - jaccard) < 0.12


def test_pruning_keeps_what_may_reach_the_threshold():
    limits = [least_matches(0.85, n, 1e-7) for n in range(25, 126, 25)]
    assert limits == sorted(limits) and 0 < limits[0] < 25 and limits[-1] < 0.85 * 125
    draw = np.random.default_rng(2)
    left = np.zeros((4000, minhash.HASHES), np.uint32)
    right = (draw.random(left.shape) > 0.85).astype(np.uint32)
    assert len(surviving(left, right, 0.85, 1e-7)) == 4000
    assert len(surviving(left, (draw.random(left.shape) > 0.4).astype(np.uint32), 0.85, 1e-7)) == 0


def test_shingles_of_short_and_repeated_words():
    sets = list(shingle_sets(["a b", "A  B", "a b c d e", "a a a a a a a", None, "b a"]))
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 1]
    assert (sets[0] == sets[1]).all() and sets[0][0] != sets[5][0]


def test_bands_follow_the_threshold():
    assert minhash.layout(85) == (25, 5)
    for percent in (50, 80, 85, 95):
        bands, rows = minhash.layout(percent)
        assert bands * rows <= minhash.HASHES and (1 - (percent / 100) ** rows) ** bands <= 1e-6


def test_threshold_of_eighty_matches_all_pairs(spark):
    rows = corpus(3)
    _, least = plain(rows, 80)
    assert least != plain(rows, 85)[1]
    got = near_duplicates(spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA), 80).collect()
    assert {r.doc_id: r.component_id for r in got} == least

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from roadlake.llm import filter_audit
from roadlake.llm.filter_audit import audit

SCHEMA = "doc_id long, text string, lang string, source string, TEXTS int, least long, part string"
LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain(rows, labels):
    """Counts by applying each order to the documents themselves."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > least[text],
        }
        docs.append((i, lang or "", {f for f, failed in fails.items() if failed}))
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[1] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in d[2]]
                left = [d for d in left if f not in d[2]]
                shapley[part, f] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(f in d[2] for d in gone), sum(d[2] == {f} for d in docs if d[1] == part),
                    sum(d[0] in good for d in here), sum(d[0] in toxic for d in here),
                ]
                gone += here
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def write(spark, folder, rows, files):
    for part in range(files):
        spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows[part::files]], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def rows_of(seed):
    rng = random.Random(seed)
    texts = [None, "", " ", "Few words", "a b\x0bc\x85d", "x " * 120, "word | " + " ".join(map(str, range(150))), "ABC " * 40]
    texts += [" ".join(rng.choice(["One", "two", "#3", "4", "ö"]) + str(rng.randrange(200)) for _ in range(rng.randrange(60, 180))) for _ in range(12)]
    rows = [(rng.randrange(40), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    return rows + rows[:9] + [(None, texts[3], "en"), (None, texts[3], "en"), (None, None, None)]


@pytest.mark.parametrize("files, batches, texts", [(1, 4, 1024), (9, 9, 1024), (5, 2, 3)])
def test_every_order_matches_a_plain_version(spark, folder, monkeypatch, files, batches, texts):
    """Ids come in any order over the files, so masks of earlier micro-batches have to be taken back."""
    monkeypatch.setattr(filter_audit, "TEXTS", texts)
    rows = rows_of(files)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(30)] + [(1, 0, 1), (None, 1, 1), (50, 1, 1), (2, None, None)]
    write(spark, folder, rows, files)
    got = audit(spark, folder, spark.createDataFrame(labels, LABELS), batches=batches)
    assert found(got) == plain(rows, labels)


def test_a_state_goes_on_with_new_files(spark, folder):
    rows = rows_of(7)
    labels = spark.createDataFrame([(3, 1, 1)], LABELS)
    docs, state = f"{folder}/docs", f"{folder}/state"
    write(spark, docs, [(None if r[0] is None else r[0] + 100, *r[1:]) for r in rows], 2)
    audit(spark, docs, labels, state=state)
    write(spark, docs, rows, 3)
    both = [(None if r[0] is None else r[0] + 100, *r[1:]) for r in rows] + rows
    assert found(audit(spark, docs, labels, state=state)) == plain(both, [(3, 1, 1)])


def test_empty_table(spark, folder):
    write(spark, folder, [], 1)
    assert audit(spark, folder, spark.createDataFrame([], LABELS)).count() == 0


def test_a_common_text_is_counted_before_it_is_shuffled(spark):
    import pandas as pd

    rows = pd.DataFrame({
        "bucket": 1, "key": [b"k"] * 1000, "id": range(1000), "part": "en", "mask": 3, "good": 0, "toxic": [0, 1] * 500,
    })
    (out,) = filter_audit._combined([rows])
    assert len(out) == 3 and out["n"].sum() == 1000 and set(out["id"]) == {0}

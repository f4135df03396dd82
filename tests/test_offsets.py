"""The ledger against sets of offsets."""

import random
from collections import Counter

import pytest

from roadlake.operators.offsets import covered, findings, offset_ranges

SCHEMA = "topic string, part int, offset bigint"
KEYS = ["topic", "part"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def spread(rows):
    """Offsets of ranges, by source."""
    out = {}
    for r in rows:
        out.setdefault((r.topic, r.part), Counter()).update({o: r["copies"] if "copies" in r else 1 for o in range(r["first"], r["last"] + 1)})
    return out


def counts(rows):
    out = {}
    for topic, part, offset in rows:
        if offset is not None:
            out.setdefault((topic, part), Counter())[offset] += 1
    return out


def rows_of(seed):
    rng = random.Random(seed)
    rows = [("t", 0, o) for o in range(500) if not 120 <= o < 140 and o != 300]  # most messages in one partition
    rows += [("t", 0, o) for o in range(50, 80)] + [("t", 0, 77)] * 3
    rows += [(rng.choice(["t", None]), rng.choice([1, 2]), rng.randrange(1000, 1060)) for _ in range(120)] + [("t", 1, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("stretch", [1, 7, 100_000])
def test_ranges_hold_the_offsets(spark, stretch):
    rows = rows_of(stretch)
    ranges = offset_ranges(frame(spark, rows), KEYS, stretch=stretch).collect()
    assert spread(ranges) == counts(rows)
    assert len([r for r in ranges if (r.topic, r.part) == ("t", 0)]) == 7  # 0-49, 50-76, 77, 78-79, 80-119, 140-299, 301-499


def test_findings_over_several_batches(spark):
    rows = rows_of(1)
    batches = [rows[:200], rows[200:450], rows[450:], [("t", 0, o) for o in range(490, 520)], [("t", 0, 600)]]
    ledger = None
    for batch in batches:
        noted = offset_ranges(frame(spark, batch), KEYS)
        ledger = noted if ledger is None else ledger.unionByName(noted)
    want = counts([r for b in batches for r in b])
    assert spread(covered(ledger, KEYS).collect()) == {k: Counter(set(v)) for k, v in want.items()}
    found = findings(ledger, KEYS).collect()
    for kind, wrong in (("skipped", lambda c: [o for o in range(min(c), max(c)) if o not in c]), ("doubled", lambda c: [o for o, n in c.items() if n > 1])):
        of_kind = [r for r in found if r.kind == kind]
        assert spread(of_kind) == {k: Counter(wrong(v)) for k, v in want.items() if wrong(v)}
        for a in of_kind:  # whole ranges, not parts of them
            assert not any(b.first == a.last + 1 and (a.topic, a.part) == (b.topic, b.part) for b in of_kind)


def test_a_whole_topic_has_no_findings(spark):
    ledger = offset_ranges(frame(spark, [("t", p, o) for p in range(3) for o in range(50)]), KEYS)
    assert findings(ledger, KEYS).isEmpty() and ledger.count() == 3
    assert findings(offset_ranges(frame(spark, []), KEYS), KEYS).isEmpty()


def test_repeated_messages_are_combined_before_the_shuffle(spark):
    from test_upsert import explain

    plan = explain(offset_ranges(frame(spark, [("t", 0, 1)]), KEYS))
    assert plan.index("partial_count") > plan.index("Exchange") and "SinglePartition" not in plan

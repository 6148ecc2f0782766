import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stallwise.llm import pfair as p


@pytest.mark.parametrize("parts", [[1], [1, 1], [3, 2, 7], [500, 300, 199, 1], [1] * 17, [5, 3]])
def test_windows_are_met_and_lag_stays_below_one(parts):
    total, placed = sum(parts), [0] * len(parts)
    for slot, (s, i) in enumerate(p.repeating_order(parts)):
        release, deadline = p.windows(parts[s], total)[i]
        assert i == placed[s] and release <= slot < deadline
        placed[s] += 1
        assert all(abs(placed[k] * total - parts[k] * (slot + 1)) < total for k in range(len(parts)))
    assert placed == parts


def simulated(blocks, parts):
    """Earliest deadline first, slot by slot, phase by phase."""
    left, out = list(blocks), []
    while any(left):
        active = [s for s in range(len(blocks)) if left[s]]
        phases, _ = p.schedule([left[s] for s in active], [parts[s] for s in active])
        times, own = phases[0][6], {active[r[1]]: r[7] for r in phases if r[0] == 0}
        for _ in range(times):
            for a, _ in p.repeating_order([own[s] for s in active]):
                if left[active[a]]:
                    left[active[a]] -= 1
                    out.append(active[a])
    return out


@pytest.mark.parametrize("sizes, weights, block", [({"a": 40, "b": 7, None: 13}, {"a": 2, "b": 1, None: 3}, 2), ({"a": 9}, {"a": 4}, 4), ({"a": 33, "b": 33, "c": 1}, None, 5)])
def test_positions_follow_the_schedule(spark, sizes, weights, block):
    rows = [(i * 7, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    got = p.mixed(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_docs=block).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    names = sorted(sizes, key=lambda s: (s is None, str(s)))
    counts = [-(-sizes[s] // block) for s in names]
    import math

    parts = [weights[s] for s in names] if weights else p.apportioned([math.sqrt(sizes[s]) for s in names])
    slots = {r["slot"]: r["source"] for r in got}
    assert [slots[t] for t in range(len(slots))] == [names[s] for s in simulated(counts, parts)]
    by_block = {}
    for r in got:
        by_block.setdefault((r["source"], r["block"]), set()).add(r["slot"])
    assert all(len(v) == 1 for v in by_block.values()) and len(by_block) == sum(counts)


def test_order_keeps_documents_whole(documents, rows, none):
    ordered = p.in_order(documents.withColumn("slot", F.lit("kept")))
    assert Counter(r["doc_id"] for r in ordered.collect()) == Counter(r[0] for r in rows)
    assert {r["slot"] for r in ordered.collect()} == {"kept"}
    assert p.mixed(none).count() == 0


def test_apportioned():
    rng = random.Random(1)
    for _ in range(20):
        wanted = [rng.random() for _ in range(rng.randint(1, 30))]
        found = p.apportioned(wanted)
        assert sum(found) == 1000 and min(found) >= 1

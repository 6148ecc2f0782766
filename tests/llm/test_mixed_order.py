import math
from collections import Counter
from fractions import Fraction

import corpus_pipeline
from conftest import SF
from stallwise.llm import pfair


def plain(counts, parts, block=pfair.BLOCK_DOCS):
    """The source of every document: slot by slot the released block that is due first, in phases of the sources left."""
    left, out = dict(counts), []
    while left := {s: n for s, n in left.items() if n}:
        total, placed, ended = sum(parts[s] for s in left), Counter(), False
        now = dict(left)
        for slot in range(10**6):
            if slot * math.gcd(*[parts[s] for s in now]) % total == 0 and ended:
                break
            share = {s: Fraction(parts[s], total) for s in now}
            ready = [s for s in now if math.floor(placed[s] / share[s]) <= slot]
            s = min(ready, key=lambda s: (math.ceil((placed[s] + 1) / share[s]), list(now).index(s)))
            placed[s] += 1
            out += [s] * min(block, left[s])
            left[s] -= min(block, left[s])
            ended |= left[s] == 0
    return out


def test_rows_follow_the_mixed_order(spark):
    """Sources of different sizes take turns by their weights in the result of the whole pipeline, wherever rows lie."""
    out = corpus_pipeline.run(spark, SF).collect()
    counts = Counter(r["source"] for r in out)
    names = sorted(counts, key=lambda s: (s is None, str(s)))
    parts = dict(zip(names, pfair.apportioned([math.sqrt(counts[s]) for s in names])))
    assert [r["position"] for r in out] == list(range(len(out)))
    assert [r["source"] for r in out] == plain({s: counts[s] for s in names}, parts)


def test_order_hangs_on_the_weights(spark):
    rows = [(i, "a" if i % 2 else "b", "t") for i in range(64 * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for weights in ({"a": 3, "b": 1}, {"a": 1, "b": 3}):
        shuffled = pfair.in_order(docs, places=True, weights=weights).repartition(7)
        got = [r["source"] for r in shuffled.orderBy("position").collect()]
        assert got == plain({"a": 256, "b": 256}, weights)

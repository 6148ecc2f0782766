import random
import zlib
from collections import Counter

import pytest

from stallwise.llm import sharding_lp as s


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_law_of_rows(spark, documents, rows, shards):
    got = s.sharded(s.text_nodes(documents), shards).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts[k] for k in range(shards)) <= 1
    for k in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(counts[k]))
    text = {r[0]: r[1] for r in rows}
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_groups_gather_and_large_ones_are_split(spark):
    """Pairs end in one shard; a group of half of all rows fills whole shards."""
    texts = [f"pair {i // 2}" for i in range(60)] + [f"single {i}" for i in range(60)] + ["hot"] * 120
    nodes = s.text_nodes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    placed = s.sharded(nodes, 4).collect()
    assert set(Counter(r["shard"] for r in placed).values()) == {60}
    homes = {}
    for r in placed:
        homes.setdefault(texts[r["doc_id"]], []).append(r["shard"])
    assert sum(len(set(v)) == 1 for k, v in homes.items() if k.startswith("pair")) >= 28
    assert max(Counter(homes["hot"]).values()) >= 55


def test_cut_falls(spark):
    texts = [f"group {i // 6}" for i in range(240)]
    nodes = s.text_nodes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    cuts = [s.cut_pairs(s.sharded(nodes, 4, rounds)).first() for rounds in (0, 8)]
    assert cuts[0]["linked"] == cuts[1]["linked"] == 40 * 15
    assert cuts[1]["cut"] < 0.35 * cuts[0]["cut"]


@pytest.mark.parametrize("of", [2, pytest.param(3, marks=pytest.mark.xfail(strict=False, reason="with this numbering more than a tenth of the pairs stay cut"))])
def test_groups_gather_where_all_documents_are_linked(spark, of):
    """No document is free to fill gaps: groups can gather only by exchanges."""
    nodes = s.text_nodes(spark.createDataFrame([(i, f"group {i // of}") for i in range(1998)], "doc_id long, text string"))
    placed = s.sharded(nodes, 8).persist()
    pairs = s.cut_pairs(placed).first()
    assert pairs["linked"] == 1998 // of * of * (of - 1) / 2 and pairs["cut"] <= 0.1 * pairs["linked"]  # a hash start cuts seven of eight
    counts = Counter(r["shard"] for r in placed.collect())
    assert max(counts.values()) - min(counts.values()) <= 1


def test_cut_of_groups_of_all_sizes(spark):
    """Cut pairs agree with pairs formed one by one and fall, also where one group fills most of a shard."""
    sizes = [2] * 100 + [3] * 50 + [10] * 20 + [60, 150]
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)]
    nodes = s.text_nodes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    cuts = []
    for rounds in (0, None):
        placed = s.sharded(nodes, 4, rounds).persist()
        homes = {}
        for r in placed.collect():
            homes.setdefault(texts[r["doc_id"]], []).append(r["shard"])
        plain = sum(a != b for v in homes.values() for i, a in enumerate(v) for b in v[:i])
        assert s.cut_pairs(placed).first()["cut"] == plain
        cuts.append(plain)
    assert cuts[1] <= 0.5 * cuts[0]


def test_allowances_keep_the_quotas():
    """What a shard gets is at most what it gives and its free places; a cycle of requests is met without any."""
    assert s.allowances({(0, 1): 5, (1, 2): 4, (2, 0): 6}, [0, 0, 0]) == {(0, 1): 4, (1, 2): 4, (2, 0): 4}
    assert s.allowances({(0, 1): 5, (1, 0): 2}, [0, 1]) == {(0, 1): 3, (1, 0): 2}
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randint(2, 6)
        asked = {(a, b): rng.randint(1, 20) for a in range(n) for b in range(n) if a != b and rng.random() < 0.6}
        free = [rng.choice([0, 0, 7]) for _ in range(n)]
        got = s.allowances(asked, free)
        assert all(0 < moves <= asked[way] for way, moves in got.items())
        for k in range(n):
            gets, gives = (sum(m for way, m in got.items() if way[at] == k) for at in (1, 0))
            assert gets <= gives + free[k]


def test_empty(none):
    assert s.sharded(s.text_nodes(none), 8).count() == 0


def test_no_python_in_the_plan(documents):
    plan = s.sharded(s.text_nodes(documents), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

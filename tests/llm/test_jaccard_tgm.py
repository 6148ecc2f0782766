import random
import re

import numpy as np
import pytest

from stallwise.llm import jaccard_tgm as j

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, width):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_components(rows, width, percent):
    sets = [plain_set(r[1], width) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(float("inf") if r[0] is None else r[0])
    return sorted((r[0] is None, r[0] or 0, len(s), min(ids[find(i)])) for i, (r, s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_equals_all_pairs(documents, rows, width, percent):
    got = j.joined(documents, width, percent).collect()
    told = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], float("inf") if r["component_id"] is None else r["component_id"]) for r in got)
    assert told == plain_components(rows, width, percent)


def test_many_near_copies_in_small_groups(spark, monkeypatch):
    """A chain of near copies, cut into many groups: every component as by comparing all pairs."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    made = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(80)] = f"v{rng.randrange(50)}"
        made.append((i, " ".join(copy[: rng.choice([80, 80, 79, 76])])))
    made += [(200 + i, " ".join(f"u{i}x{k}" for k in range(rng.choice([3, 9, 11, 30]))) + " w0 w1 w2 w3") for i in range(40)]
    monkeypatch.setattr(j, "GROUP_MEMBERS", 6)
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in j.joined(df, 3, 90).collect())
    assert got == plain_components(made, 3, 90)


PASSAGE = "".join(f" p{k}" for k in range(24))


def with_passage(n):
    """n unrelated pairs of near copies, all with a passage in common; some copies differ in as much as links allow."""
    rng = random.Random(17)
    made = []
    for i in range(n):
        text = [f"t{i}w{k}" for k in range(rng.choice([60, 100, 150]))]
        copy = list(text)
        for at in rng.sample(range(len(text) // 10), rng.choice([1, 1, 2, 3])):
            copy[at * 10] = "changed"
        made += [(2 * i, " ".join(text) + PASSAGE), (2 * i + 1, " ".join(copy) + PASSAGE)]
    return made


def met(spark, made, width, percent):
    df = spark.createDataFrame(made, "doc_id long, text string")
    sets = j.durable(j.signed_sets(df, width, percent))
    members, ids = j.memberships(sets), sets.select("id")
    groups = j.groups_of(members, sets)
    return groups.select("group").distinct().count(), j.pairs_of(members, groups, j.group_rows(j.sets_again(df, ids, width), groups)).where("group < other").count()


def test_passage_in_common_pairs_no_groups(spark):
    """Groups that only share a passage don't meet, so pairs don't grow with the square of its holders."""
    groups, pairs = met(spark, with_passage(60), 5, 80)
    assert groups >= 30 and pairs <= groups // 2


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_passage_in_common_equals_all_pairs(spark, width, percent):
    made = with_passage(40)
    got = sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in j.joined(spark.createDataFrame(made, "doc_id long, text string"), width, percent).collect())
    want = plain_components(made, width, percent)
    assert got == want and 40 < len({w[3] for w in want}) < 80


def test_rounds_find_the_same(spark, monkeypatch):
    """Pairs dealt over many rounds: each round is a step of its own, components as by comparing all pairs."""
    rng = random.Random(3)
    base, made = [f"w{i}" for i in range(80)], []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(80)] = f"v{rng.randrange(50)}"
        made.append((i, " ".join(copy)))
    monkeypatch.setattr(j, "GROUP_MEMBERS", 6)
    monkeypatch.setattr(j, "CARRIED", 2)
    steps = []
    monkeypatch.setattr(j, "durable", lambda df, real=j.durable: steps.append(df.columns) or real(df))
    got = sorted((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in j.joined(spark.createDataFrame(made, "doc_id long, text string"), 3, 90).collect())
    assert got == plain_components(made, 3, 90)
    assert steps.count(["a", "b"]) > 3


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    """At the very threshold, for sizes across the bands."""
    rng = np.random.default_rng(percent)
    for n in [*range(4, 60), 100, 333, 999, 2500]:
        common = -(-percent * n // 100)  # x within y: common / n is at the threshold
        for _ in range(6):
            y = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64) << np.uint64(2))
            x = np.sort(rng.choice(y, min(common, len(y)), replace=False))
            if len(x) < len(y):
                (one, cuts, needs), (two, cuts2, needs2) = j.signatures(x, percent), j.signatures(y, percent)
                both = [int(v) & j.LAST_CUT for v in set(one.tolist()) & set(two.tolist())]
                # some cut keeps both
                assert any(both.count(c) >= max(needs[cuts.index(c)], needs2[cuts2.index(c)]) for c in set(both)), (n, len(x))


def test_first_of_each(documents, rows):
    kept = j.first_of_each(documents, 5, 80)
    assert kept.columns == documents.columns
    want = plain_components(rows, 5, 80)
    firsts = [w for w in want if not w[0] and (w[1] == w[3] or w[2] == 0)]
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({f[1] for f in firsts})
    assert ids.count(3) == 1  # three equal rows


def test_empty(none):
    assert j.joined(none).count() == 0 and j.first_of_each(none).count() == 0

"""Language identification against plain versions: n-grams one by one, sums in loops, one weight at a time."""

import math
from collections import Counter

import numpy as np
import pytest

from stallwise.llm import langid_ftrl as l

BITS, CLASSES = 8, 3
WORD = 2**64


def plain_columns(text, bits):
    """Counts of hashed n-grams of one to three characters of the lower-cased text; runs of other characters are one boundary."""
    lowered = (text or "").lower()
    if not any(c.isalpha() for c in lowered):
        return Counter()
    chars = [1]
    for c in lowered + " ":
        code = ord(c) + 1 if c.isalpha() else 1
        if code != 1 or chars[-1] != 1:
            chars.append(code)
    found = Counter()
    for n in (1, 2, 3):
        for at in range(len(chars) - n + 1):
            hashed = 0
            for c in chars[at : at + n]:
                hashed = (hashed * 0x100000001B3 + c) % WORD
            mixed = hashed * l.MIX[n - 1] % WORD
            found[((mixed ^ (mixed >> 29)) * l.MIX[0] % WORD) >> (64 - bits)] += 1
    return found


def test_columns_of_whole_texts(rows):
    columns = l.hasher(15)
    long = "Ünï çode words, " * 40_000  # 640,000 characters
    for text in [r[1] for r in rows if r[1] and len(r[1]) < 2000][::9] + [long, "", "1 2 3", "x", "日本 \U0001f600 ab"]:
        at, counts = columns(text.encode())
        assert dict(zip(at.tolist(), counts.tolist())) == dict(plain_columns(text, 15))


def test_frequencies_count_every_text(documents, rows):
    found, n = l.frequencies(documents, BITS)
    sets = [plain_columns(r[1], BITS) for r in rows]
    assert n == sum(bool(s) for s in sets)
    plain = Counter(column for s in sets for column in s)
    assert found.tolist() == [plain[k] for k in range(1 << BITS)]


def test_weighted_has_length_one():
    idf = np.array([1.0, 2.0, 0.5, 3.0])
    got = l.weighted(np.array([1, 3]), np.array([4, 1]), idf)
    plain = [(1 + math.log(4)) * 2.0, 3.0]
    assert np.allclose(got, [x / math.hypot(*plain) for x in plain])


@pytest.fixture(scope="module")
def sparse():
    """(label, columns, values) of sixty rows; one has a single column."""
    rng = np.random.default_rng(5)
    out = []
    for i in range(60):
        at = np.sort(rng.choice(1 << BITS, size=1 if i == 7 else rng.integers(3, 20), replace=False)).astype(np.int32)
        out.append((int(rng.integers(CLASSES)), at, rng.random(len(at)).astype(np.float32)))
    return out


@pytest.fixture(scope="module")
def stored(spark, sparse):
    rows = [(label, i % 10, bytearray(at.tobytes()), bytearray(values.tobytes())) for i, (label, at, values) in enumerate(sparse)]
    return spark.createDataFrame(rows, "label int, fold int, at binary, values binary").repartition(4).persist()


def plain_logits(at, values, weights):
    return [weights[-1][k] + sum(float(v) * weights[a][k] for a, v in zip(at, values)) for k in range(CLASSES)]


def plain_gradient(sparse, weights):
    total = [[0.0] * CLASSES for _ in range((1 << BITS) + 1)]
    for label, at, values in sparse:
        logits = plain_logits(at, values, weights)
        chances = [math.exp(x) / sum(math.exp(y) for y in logits) for x in logits]
        for k in range(CLASSES):
            slope = chances[k] - (k == label)
            total[-1][k] += slope / len(sparse)
            for a, v in zip(at, values):
                total[a][k] += float(v) * slope / len(sparse)
    return total


def test_gradient(stored, sparse):
    weights = np.random.default_rng(6).normal(size=((1 << BITS) + 1, CLASSES))
    assert np.allclose(l.gradient(stored, weights), plain_gradient(sparse, weights.tolist()), atol=1e-9)


def test_updates_follow_the_leader(stored, sparse):
    alpha, beta, l1, l2, rounds = 2.0, 0.01, 3e-3, 1e-2, 4
    size = (1 << BITS) + 1
    z, n, w = ([[0.0] * CLASSES for _ in range(size)] for _ in range(3))
    for _ in range(rounds):
        slope = plain_gradient(sparse, w)
        for i in range(size):
            penalty = 0.0 if i == size - 1 else l1
            for k in range(CLASSES):
                g = slope[i][k]
                z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / alpha * w[i][k]
                n[i][k] += g * g
                if abs(z[i][k]) <= penalty:
                    w[i][k] = 0.0
                else:
                    w[i][k] = -(z[i][k] - math.copysign(penalty, z[i][k])) / ((beta + math.sqrt(n[i][k])) / alpha + l2)
    got = l.leader(stored, size, CLASSES, rounds, alpha, beta, l1, l2)
    assert np.allclose(got, w, atol=1e-8)
    assert 0.1 < (got[:-1] == 0).mean() < 1


def test_temperature_is_that_of_least_loss(stored, sparse):
    weights = np.random.default_rng(8).normal(size=((1 << BITS) + 1, CLASSES))
    logits = [plain_logits(at, values, weights.tolist()) for _, at, values in sparse]
    doubt = 1 / (len(sparse) + 2)

    def loss(t):
        total = 0.0
        for (label, _, _), row in zip(sparse, logits):
            norm = math.log(sum(math.exp(x / t) for x in row))
            total += sum((doubt / CLASSES + (1 - doubt) * (k == label)) * (norm - x / t) for k, x in enumerate(row))
        return total / len(sparse)

    best = min((math.exp(x / 100) for x in range(-299, 300)), key=loss)
    got = l.calibrated(stored, weights)
    assert loss(got) <= loss(best) + 1e-9 and abs(math.log(got / best)) <= 0.011


def test_no_rows_leave_the_temperature(stored):
    assert l.calibrated(stored.where("false"), np.zeros(((1 << BITS) + 1, CLASSES))) == 1.0


def test_scores_are_softmax_and_ties_go_to_the_first():
    even = l.Model(["aa", "bb", "cc"], np.ones(1 << BITS), np.zeros(((1 << BITS) + 1, 3)), 1.0, BITS).rule()
    assert even(b"some words") == ("aa", pytest.approx(1 / 3))
    rng = np.random.default_rng(9)
    weights, idf = rng.normal(size=((1 << BITS) + 1, 3)), rng.random(1 << BITS) + 1
    rule = l.Model(["aa", "bb", "cc"], idf, weights, 0.7, BITS).rule()
    for text in ("some words", "andere worte", "é", "a " * 5000):
        counts = plain_columns(text, BITS)
        values = {at: (1 + math.log(n)) * idf[at] for at, n in counts.items()}
        length = math.sqrt(sum(v * v for v in values.values()))
        logits = [(weights[-1][k] + sum(v / length * weights[at][k] for at, v in values.items())) / 0.7 for k in range(3)]
        best = max(range(3), key=lambda k: logits[k])
        assert rule(text.encode()) == (["aa", "bb", "cc"][best], pytest.approx(1 / sum(math.exp(x - logits[best]) for x in logits)))

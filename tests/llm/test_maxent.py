import math
import re
from collections import Counter

import numpy as np
import pytest

from stallwise.llm import maxent as m
from stallwise.llm.common import crc_of_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")] + [None]


def test_scores(spark, documents, rows):
    held = {r["doc_id"]: r["h"] for r in documents.select("doc_id", (crc_of_id() % 10 == 0).alias("h")).collect()}
    got = m.scored(documents, crc_of_id() % 10 == 0).collect()
    assert len(got) == len(rows)
    counts = Counter(t for r in rows if not held[r[0]] for t in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        own = tokens(text[r["doc_id"]])
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[t] > 0 for t in own), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    # the model beats the base on texts it has not seen: it tells the languages apart
    unseen = [r for r in got if r["held_out"] and r["n_tokens"] > 40]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_probabilities_sum_to_one(spark):
    """Over all known tokens and an unseen one per class, after every history."""
    texts = spark.createDataFrame([("a b c a b d e f g a b",), ("b a c c d x y z",), (None,)], "text string")
    counts = m.token_counts(texts)
    known = m.vocabulary(counts)
    weights = m.trained(m.history_counts(texts, known), known, updates=5)
    tables = m.tables(weights)
    chance = 10.0 ** tables.classes
    assert np.allclose(chance.sum(axis=1), 1, atol=1e-4)
    first = tables.bias[:, None] + tables.by_last.T[:, :1] + tables.by_skip.T[:, :1]
    heads = first[:, 0].reshape(m.HEAD_CLASSES, m.PER_CLASS) - tables.totals[0][:, None]
    assert np.allclose((10.0 ** heads.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_updates_raise_the_likelihood(spark, documents):
    texts = documents.select("text")
    known = m.vocabulary(m.token_counts(texts))
    blocks = m.history_counts(texts, known)
    losses = [m.gradient(blocks, m.trained(blocks, known, updates=n))[1] for n in (0, 3, 12)]
    assert losses[0] > losses[1] > losses[2]


def test_gradient_is_the_slope(spark, documents):
    texts = documents.select("text")
    known = m.vocabulary(m.token_counts(texts))
    blocks = m.history_counts(texts, known)
    weights = m.trained(blocks, known, updates=2)
    slope, _ = m.gradient(blocks, weights)
    at = np.unravel_index(np.argmax(np.abs(slope[1])), slope[1].shape)
    around = []
    for step in (-0.05, 0.05):
        weights.parts[1][at] += step
        around.append(m.gradient(blocks, weights)[1])
        weights.parts[1][at] -= step
    assert (around[1] - around[0]) / 0.1 == pytest.approx(slope[1][at], rel=0.1, abs=0.5)


def test_empty_and_untrained(spark, none, documents):
    from pyspark.sql import functions as F

    assert m.scored(none, crc_of_id() % 10 == 0).count() == 0
    got = m.scored(documents.limit(5), F.lit(True)).collect()
    assert {r["train_tokens"] for r in got} == {0} and all(r["base_score"] == 0.0 and r["score"] < 0 for r in got)

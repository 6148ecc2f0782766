import random

import pytest

from stallwise.llm import maxent as m


def test_occurrences_are_no_rows_and_lanes_change_nothing(spark, monkeypatch):
    """No step has a row per occurrence of a rare token, and a tree part dealt over several tasks gives the scores of one task."""
    from pyspark.sql import functions as F

    rng, rows, occurrences = random.Random(2), [], 0
    words = [f"k{i:04d}" for i in range(m.FEATURED + 400)]
    for i in range(120):
        rows.append((i, " ".join(rng.sample(words, len(words)))))
        occurrences += len(words) - m.FEATURED
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    counts, durable = [], m.durable

    def noted(df):
        stored = durable(df)
        counts.append(stored.count())
        return stored

    monkeypatch.setattr(m, "durable", noted)
    monkeypatch.setattr(m, "LEAST", 12)
    got = {}
    for lane in (m.LANE, 500):
        monkeypatch.setattr(m, "LANE", lane)
        got[lane] = {r["doc_id"]: r["score"] for r in m.scored(documents, F.col("doc_id") % 5 == 0).collect()}
        monkeypatch.setattr(m, "durable", durable)
    assert 0 < max(counts) < occurrences / 4
    one, many = got.values()
    assert len(one) == 120 and many == {i: pytest.approx(score, rel=1e-9) for i, score in one.items()}


def test_packed_numbers_come_back():
    import numpy as np

    columns = [np.array([0, 1, 2**32 - 1, 70000]), np.array([5, 0, 256, 16384])]
    assert all((a == b).all() for a, b in zip(m.unpacked(m.packed(columns), 2), columns))
    assert [len(x) for x in m.unpacked(m.packed([np.zeros(0)] * 2), 2)] == [0, 0]


def test_codes_that_training_did_not_see_have_a_probability():
    import numpy as np

    code, child, n = np.array([5, 9, 9]), np.array([0, 1, 0]), np.array([4, 7, 1])
    fitted = m.fitted_node(code, child, n, True)
    asked = m.fitted_node(code, child, n, True, (np.array([9, 5, 9, 12345]), np.array([0, 0, 1, 1])))
    assert np.allclose(asked[:3], fitted[[2, 0, 1]], atol=1e-6) and np.isfinite(asked).all()
    assert np.isfinite(m.fitted_node(*[np.zeros(0, np.int64)] * 3, True, (np.array([7]), np.array([m.REST])))).all()

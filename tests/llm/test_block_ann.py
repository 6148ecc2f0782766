import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.llm import block_ann as b


def dot(v, w):
    total = 0.0  # one after the other: sum() would compensate rounding
    for x, y in zip(v, w):
        total += x * y
    return total


def brute(rows, k, step):
    good = []
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.append((i, v))
    out = []
    for at, (q, v) in enumerate(good):
        if q % step == 0:
            near = sorted((-dot(v, w), i) for j, (i, w) in enumerate(good) if j != at and len(w) == len(v))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    made = [(i, rng.normal(size=6).astype(np.float32).astype(float).tolist()) for i in range(300)]
    made += [(300 + i, made[5][1]) for i in range(60)]  # ties
    made += [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (404, [math.nan] + [1.0] * 5), (405, [math.inf] + [1.0] * 5),
             (None, [1.0] * 6), (406, [1.0, 2.0]), (410, [2.0, 1.0]), (7, made[7][1]), (10, made[11][1]), (20, [50 * x for x in made[20][1]]), (420, [1e30] * 6), (421, [1e-30] * 6)]
    return made


@pytest.mark.parametrize("block, stripe", [(4096, 16), (37, 2)])
def test_equals_brute_force(spark, rows, monkeypatch, block, stripe):
    monkeypatch.setattr(b, "BLOCK_ROWS", block)
    monkeypatch.setattr(b, "STRIPE", stripe)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string").repartition(3)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in b.nearest(df, F.col("vec_id") % 10 == 0, 20).collect())
    assert found == brute(rows, 20, 10)
    assert any(q == c for q, _, c, _ in found)  # another row with the query's id is a candidate


def test_bounds_hold():
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(20, 32)), rng.normal(size=(50, 32)) * 100
    q_code, q_step, q_len, q_rest = b.codes(q)
    c_code, c_step, c_len, c_rest = b.codes(c)
    about = (q_code.astype(float) @ c_code.astype(float).T) * (q_step[:, None] * c_step[None, :])
    slack = q_len[:, None] * c_rest[None, :] + q_rest[:, None] * (c_len + c_rest)[None, :]
    assert (np.abs(about - q @ c.T) <= slack).all()


def test_empty(spark):
    assert b.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0

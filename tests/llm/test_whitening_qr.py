import math
import random

import numpy as np
import pytest

from stallwise.llm import whitening_qr as w

SCHEMA = "vec_id long, embedding array<double>, n long, dim int, component string"


def frame(spark, vectors, ids=None, parts=3):
    rows = [(i if ids is None else ids[i], v, 0, 0, "") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def plain(vectors):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], dtype=np.int64)
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], vectors[:, ::-1]


def drawn(n, scales, seed=1):
    rng = np.random.default_rng(seed)
    turned, _ = np.linalg.qr(rng.normal(size=(len(scales), len(scales))))
    return (rng.normal(size=(n, len(scales))) * scales @ turned).tolist()


@pytest.mark.parametrize("scales", [[9, 7, 5, 4, 3, 2.5, 2, 1.5, 1.2, 1], [1e6, 1e4, 300, 90, 20, 8, 3, 1, 0.4]])
def test_equals_eigenvectors(spark, scales):
    vectors = drawn(400, scales)
    x, centred, values, turned = plain(vectors)
    out = w.components(frame(spark, vectors)).collect()
    k = min(8, len(scales))
    assert len(out) == 400 * k
    z = np.zeros((400, k))
    for r in out:
        z[r.vec_id, r.component - 1] = r.whitened
        assert r.n == 400 and r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-6)
        assert r.identity_error < 1e-6
    exact = [sum((400 * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(axis=0))) for row in x]
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 2**63 else None) for r in out)
    sure = centred @ turned[:, :k] / np.sqrt(values[:k])
    signs = np.sign((sure * z).sum(axis=0))
    # the plain version loses digits of small eigenvalues to the square of the condition number
    assert np.abs(z - sure * signs).max() < 1e-3 and np.abs((z - sure * signs)[:, :4]).max() < 1e-6


def test_dependent_and_constant_dimensions(spark):
    """A doubled dimension and a constant one leave components without variance, whose values are null."""
    base = np.array(drawn(60, [5, 3, 1]))
    vectors = np.column_stack([base, base[:, 0], np.full(60, 2.0)]).tolist()
    _, _, values, _ = plain(vectors)
    out = w.components(frame(spark, vectors)).collect()
    missing = {r.component for r in out if r.whitened is None}
    assert missing == {4, 5} and not any(r.whitened is None for r in out if r.component <= 3)
    assert all(r.identity_error < 1e-6 for r in out)
    for r in out:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-4, abs=1e-9)


def test_fewer_rows_than_dimensions(spark):
    out = w.components(frame(spark, drawn(4, [5, 4, 3, 2, 1, 1]))).collect()
    assert {r.component for r in out if r.whitened is not None} == {1, 2, 3}


def test_defined_cases(spark):
    """Nulls, non-finite entries, repeated and missing ids, lengths of their own, single rows, huge entries."""
    vectors = [[1.0, 2.0], [1.5, 0.5], [1.5, 0.5], [3.0, -1.0], None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [4.0], [1e300, 1.0, 2.0], [-1e300, 5.0, 1.0], [0.0, 3.0, 8.0]]
    ids = [1, 1, None, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    out = w.components(frame(spark, vectors, ids)).collect()
    by_n = {n: [r for r in out if r.n == n] for n in (4, 1, 3)}
    assert len(by_n[4]) == 8 and len(by_n[1]) == 1 and len(by_n[3]) == 9 and len(out) == 18
    assert sorted(str(r.vec_id) for r in by_n[4] if r.component == 1) == ["1", "1", "2", "None"]
    alone = by_n[1][0]
    assert (alone.whitened, alone.explained, alone.identity_error, alone.deviation) == (None, None, None, 0)
    assert any(r.deviation is None for r in by_n[3])
    two = {(r.component, r.vec_id): r.whitened for r in by_n[4]}
    assert all(math.isfinite(v) for v in two.values())


def test_equal_rows_and_empty_table(spark):
    out = w.components(frame(spark, [[1.0, 2.0]] * 5)).collect()
    assert len(out) == 10 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in out)
    assert w.components(frame(spark, [])).collect() == []


def test_partitions_do_not_matter(spark):
    vectors = drawn(200, [3, 2, 1], seed=4)
    one, many = ({(r.vec_id, r.component): r.whitened for r in w.components(frame(spark, vectors, parts=p)).collect()} for p in (1, 7))
    signs = {c: np.sign(one[0, c] * many[0, c]) for c in (1, 2, 3)}
    assert all(one[k] == pytest.approx(signs[k[1]] * many[k], abs=1e-9) for k in one)

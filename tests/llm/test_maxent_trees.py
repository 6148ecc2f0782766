import numpy as np

from stallwise.llm import maxent as m


def test_tokens_beyond_the_most_frequent_follow_their_history(spark, monkeypatch):
    """Tokens of tail classes that come after one word only are told from that word, in trees of several levels."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(m, "LEAST", 12)
    rows = []
    for i in range(3 * m.FEATURED):
        rows += [(f"a{i % 5} k{i:05d}",)] * (12 if i >= m.FEATURED else 40)
    texts = spark.createDataFrame(rows, "text string").select(F.monotonically_increasing_id().alias("doc_id"), "text")
    # right and wrong pairs of the same rare tokens, held out
    probe = spark.createDataFrame([(-1 - i, f"a{(i + wrong) % 5} k{i:05d}") for i in range(2000, 2200) for wrong in (0, 2)], "doc_id long, text string")
    both = texts.unionByName(probe)
    got = {}
    for r in m.scored(both.coalesce(4), F.col("doc_id") < 0).where("held_out").collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    gaps = [max(x) - min(x) for x in got.values()]
    assert len(got) == 200 and np.median(gaps) > 0.5


def test_chances_of_a_node_sum_to_one():
    rng = np.random.default_rng(3)
    history, child = np.meshgrid(np.arange(40) * 7, np.arange(m.FAN + 1))
    n = rng.poisson(np.where(history % 2 == child % 2, 9, 1))
    found = m.fitted_node(history.ravel(), child.ravel(), n.ravel(), True)
    sums = np.zeros(40)
    np.add.at(sums, history.ravel() // 7, 10**found)
    assert np.allclose(sums, 1, atol=1e-4)
    fit = 10 ** found.reshape(history.shape)
    even = history % 2 == child % 2
    assert fit[even].mean() > 2 * fit[~even].mean()
    # with no training row at all every child present is still possible
    assert np.isfinite(m.fitted_node(np.array([5, 9]), np.array([0, m.REST]), np.array([0, 0]), True)).all()


def test_depth():
    assert [m.tree_depth(x) for x in (None, 0, 31, 32, 1023, 1024)] == [0, 1, 1, 2, 2, 3]

import pytest

from stallwise.llm import langid_ftrl as l
from stallwise.llm.common import crc_of_id


@pytest.fixture(scope="module")
def model(documents):
    return l.train(documents, crc_of_id() % 5 != 0, sample_rows=120, rounds=12)


def test_held_out_accuracy(documents, rows, model):
    got = l.predicted(documents, model).where(crc_of_id() % 5 == 0).where("lang is not null and length(text) > 100").collect()
    assert len(got) > 15
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_undetermined(documents, rows, model):
    got = {r["doc_id"]: r for r in l.predicted(documents, model).collect()}
    assert len(l.predicted(documents, model).collect()) == len(rows)
    for doc_id in (200, 201, 202, 209, 206):
        assert (got[doc_id]["lang_pred"], got[doc_id]["score"]) == ("und", 0.0)
    assert got[203]["lang_pred"] in ("xx", "yy")


def test_filter(documents, model):
    kept = l.told(documents, model)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == documents.columns and not ids & {200, 201, 202, 206, 209} and len(ids) > 150


def test_regularisation_leaves_zeros(model):
    assert (model.weights == 0).mean() > 0.3


def test_nothing_to_learn(spark, none, documents):
    from pyspark.sql import functions as F

    model = l.train(documents, F.lit(False))
    assert {r["lang_pred"] for r in l.predicted(documents, model).collect()} == {"und"}
    assert l.predicted(none, model).count() == 0


def test_columns_are_counted(spark):
    """Hashed counts agree with n-grams taken one by one."""
    columns = l.hasher(18)
    at, counts = columns("Ab ab".encode())
    # boundary a b boundary a b boundary: 7 single characters, 6 pairs, 5 triples
    assert counts.sum() == 18 and len(columns("12 3".encode())[0]) == 0
    assert (columns(b"ab  ab")[0] == columns(b"AB.,;ab")[0]).all()

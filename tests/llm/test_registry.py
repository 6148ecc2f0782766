import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import TABLES, connect, difference
from conftest import SF
from stallwise.session import durable


@pytest.fixture(scope="module")
def con():
    con = connect(SF)
    for t in ("documents", "embeddings", "pages", "conversations"):
        if t not in TABLES:
            con.execute(f"create or replace view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_all_are_registered():
    queries = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries) == 1
    assert queries["pipeline"] is corpus_pipeline.run
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {"op5_revisit_resolution", "op7_quotation_linking", "op9_token_group_join", "op10_block_matrix_join", "op12_interval_parsing"}


@pytest.mark.parametrize("name", ["op5_revisit_resolution", "op7_quotation_linking", "op9_token_group_join", "op10_block_matrix_join", "op12_interval_parsing"])
def test_equals_oracle(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_pipeline(spark):
    """Stages in order; all but the last return the columns of documents, and what a stage rejects is gone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r["doc_id"] for r in out]
    assert len(set(ids)) == len(ids) and set(ids) < {r["doc_id"] for r in docs.collect()}
    assert len(out) > 0.6 * docs.count() and all(r["n_ids"] == len(r["ids"]) for r in out)


def through(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, SF))
    return docs


def test_pipeline_on_odd_documents(spark, documents, none):
    """Null and repeated ids, null and empty texts, repeated rows, extra columns with operators' names; an empty table."""
    rows = through(spark, documents).collect()
    assert rows and all(r["n_ids"] == len(r["ids"]) for r in rows)
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    gone = {200, 201, 202, 203, 204, 205, 206, 207, 209}  # empty, too short, junk
    assert not gone & {r["doc_id"] for r in rows}
    assert through(spark, none).collect() == []

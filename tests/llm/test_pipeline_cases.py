"""The whole pipeline on null and repeated ids, odd texts, clashing columns, and an empty table."""

import os
from collections import Counter

import corpus_pipeline
from stallwise.session import shared_dir


def run_on(spark, documents, folder):
    documents.write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_odd_rows(spark, documents, rows, tmp_path):
    out = run_on(spark, documents, tmp_path).collect()
    ids = Counter(r["doc_id"] for r in out)
    assert [r["position"] for r in out] == list(range(len(out)))
    assert set(ids) <= {r[0] for r in rows} and max(ids.values()) == 1
    assert all(r["n_ids"] == len(r["ids"]) > 0 for r in out)
    # no text and nothing but marks or repetition leaves the first two stages
    assert not set(ids) & {200, 201, 202, 203, 204, 205, 206, 207, 209}
    # of equal texts one stays at most, wherever their ids are null, equal or different
    assert sum(ids[i] for i in [7, *range(180, 192)]) <= 1
    text = {r[0]: r[1] for r in rows}
    assert max(Counter(text[i] for i in ids).values()) == 1
    # clean prose of fifty words or more without a near copy stays
    prose = [r[0] for r in rows[:160] if r[0] not in (3, 5, 7) and len(r[1].split()) >= 50]
    assert len(prose) > 100 and all(i in ids for i in prose)


def test_empty_table(spark, none, tmp_path):
    out = run_on(spark, none, tmp_path)
    assert out.columns == ["doc_id", "lang", "source", "slot", "position", "ids", "n_ids"] and out.count() == 0


def test_files_of_earlier_stages_go(spark, documents, tmp_path):
    before = set(made(spark))
    run_on(spark, documents, tmp_path)
    names = [name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES]
    left = [x for x in set(made(spark)) - before if x.rpartition("-")[0] in names]
    assert [x.rpartition("-")[0] for x in left] == names[-1:]


def made(spark):
    folder = f"{shared_dir(spark).removeprefix('file:')}/stallwise-{spark.sparkContext.applicationId}"
    return os.listdir(folder) if os.path.isdir(folder) else []

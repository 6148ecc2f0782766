import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.llm import quality_mcd as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def test_counts_equal_plain_python(spark, documents, rows):
    got = q.outliers(documents, min_rows=20).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for doc_id, text, *_ in rows:
        r = by_id[doc_id][0]
        assert tuple(r[c] for c in q.COUNTS) == plain_counts(text), doc_id
        n, repeats = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["base_failed"] and r["kept"])
    assert by_id[206][0]["kept"] is False and by_id[207][0]["kept"] is False
    assert sum(r["kept"] for r in got) > 150


def test_repeats_with_hypothesis_like_cases():
    for text in ["a b c", "a b c d", "a b c a b c", "x x x x", "a b a b a b", "a a a", ""]:
        assert q.statistics_of(text.encode())[:5] == plain_counts(text)


def test_estimate_resists_outliers(spark):
    """A third of the rows far away: the estimate is that of the clean rows."""
    rng = np.random.default_rng(1)
    clean = rng.normal(size=(600, q.SIZE)) * [300, 100, 80, 90, 200, 150] + 2000
    bad = rng.normal(size=(200, q.SIZE)) * 50 + 9000
    values = np.rint(np.concatenate([clean, bad])).astype(int).tolist()
    frame = spark.createDataFrame([("g", *v) for v in values], "group string, " + ", ".join(f"x{i} long" for i in range(q.SIZE)))
    row = q.minimum_covariance(frame, support=0.7).first()
    assert np.allclose(np.array(row["centre"]) * q.UNIT, clean.mean(axis=0), atol=40)
    inverse = np.zeros((q.SIZE, q.SIZE))
    for at, (i, j) in enumerate(q.PAIRS):
        inverse[i, j] = inverse[j, i] = row["inverse"][at]
    scatter = np.linalg.inv(inverse) - np.diag(np.square(q.FLOOR))
    assert np.allclose(np.diag(scatter), np.cov(clean.T / q.UNIT).diagonal(), rtol=0.6, atol=0.01)


def test_chi_square():
    assert q.chi_square(0.5, 6) == pytest.approx(5.348, abs=0.02)
    assert q.chi_square(0.975, 6) == pytest.approx(14.449, abs=0.05)


def test_filter_keeps_all_columns_and_empty_tables(spark, documents, none):
    kept = q.filtered(documents, min_rows=20)
    assert kept.columns == documents.columns
    stay = {r["doc_id"] for r in q.outliers(documents, min_rows=20).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == stay and len(stay) > 100
    assert q.outliers(none).count() == 0


def plain_text(rng, words=120):
    return ".\n".join(" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(10)) for _ in range(words // 10))


def test_each_repetition_can_reject(spark):
    """In a clean group: half the lines and half the words repeated, and either alone."""
    import random

    rng = random.Random(8)
    rows = [(i, plain_text(rng, rng.choice([100, 120, 150])), "xx", "s") for i in range(300)]
    half = plain_text(rng, 60).split("\n")
    rows.append((900, "\n".join([*plain_text(rng, 60).split("\n"), *[line for line in half[:3] for _ in (1, 2)]]), "xx", "s"))
    lines = [f"{rng.choice('abcdef')}{i} " * 1 for i in range(2)]
    rows.append((901, plain_text(rng, 100) + "\n" + "\n".join(lines * 80), "xx", "s"))
    out = {r["doc_id"]: r for r in q.outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(out[i]["kept"] for i in range(300)) >= 299
    assert not out[900]["base_failed"] and not out[900]["kept"]
    assert not out[901]["kept"]


def test_kept_follows_the_estimate(spark, documents):
    """Verdicts recomputed in numpy from the published estimate of each group."""
    stored = q.text_statistics(documents)
    keys = q.group_keys(stored, 20)
    vectors = {}
    tagged = stored.join(keys.withColumnsRenamed({"lang": "l", "source": "s"}), F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    for r in tagged.collect():
        vectors.setdefault(r["group"] if not r["base_failed"] else None, []).append(r)
    clean = tagged.where("not base_failed").select("group", *[f"x{i}" for i in range(q.SIZE)])
    sizes = {g: len(rows) for g, rows in vectors.items()}
    estimates = {r["group"]: r for r in q.minimum_covariance(clean.where(F.col("group").isin([g for g, n in sizes.items() if g is not None and n >= 20]))).collect()}
    kept = {}
    for group, rows in vectors.items():
        for r in rows:
            if group in estimates:
                inverse = np.zeros((q.SIZE, q.SIZE))
                for at, (i, j) in enumerate(q.PAIRS):
                    inverse[i, j] = inverse[j, i] = estimates[group]["inverse"][at]
                delta = np.array([r[f"x{i}"] for i in range(q.SIZE)]) / q.UNIT - np.array(estimates[group]["centre"])
                kept[r["doc_id"], r["digest"]] = bool(delta @ inverse @ delta <= q.CUTOFF)
            else:
                kept[r["doc_id"], r["digest"]] = not r["base_failed"]
    got = {(r["doc_id"], r["digest"]): r["kept"] for r in q.outliers(documents, min_rows=20).collect()}
    assert got == kept and not all(kept.values())


def test_rows_with_equal_or_missing_ids_are_judged_alone(spark, documents):
    same = documents.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(7)).cast("long"))
    kept = q.filtered(same, min_rows=20)
    judged = q.outliers(same, min_rows=20).where("kept")
    assert kept.count() == judged.count() < documents.count()
    assert kept.where("text like '### %'").count() == 0

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, document string"


def prose(rng, words, vocabulary):
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 12))) for _ in range(max(1, words // 9))]
    return ".\n".join(lines)


def vocabulary(rng, letters, n=400):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """Prose in two languages, exact and near copies, junk, and every odd case: nulls, empty and blank texts, ties,
    repeated rows, a long text; three extra columns have names that operators use themselves."""
    rng = random.Random(4)
    words = {"xx": vocabulary(rng, "abcdefg"), "yy": vocabulary(rng, "mnopqrstué")}
    out = []
    for i in range(160):
        lang = "xx" if i % 3 else "yy"
        out.append((i, prose(rng, rng.choice([60, 90, 200]), words[lang]), lang, f"s{i % 4 if i % 2 else 0}"))
    base = out[5][1].split(" ")
    for i in range(160, 180):  # near copies of one text
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = "zz"
        out.append((i, " ".join(copy), "xx", "s0"))
    out += [(180 + i, out[7][1], "xx", "s1") for i in range(12)]  # exact copies
    out += [(200, None, "xx", "s0"), (201, "", "xx", None), (202, " \n\t ", None, "s1"), (203, "one", "yy", "s1"), (204, "one two", "xx", "s1"),
            (205, "ONE two", "xx", "s1"), (206, "### " * 300, "xx", "s0"), (207, "same words here " * 90, "yy", "s0"),
            (208, prose(rng, 9000, words["yy"]), "yy", "s0"), (None, "no id " + out[9][1], "xx", "s2"), (209, "123 456", None, None),
            (210, "a ▁ mark  and   blanks here ﷐ 日本 \U0001f600", "xx", "s0")]
    out += [out[3], out[3]]  # repeated rows
    return [(i, t, lang, s, None if t is None else len(t), "x", "y", "z") for i, t, lang, s in out]


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

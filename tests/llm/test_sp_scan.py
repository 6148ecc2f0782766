import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.llm import sp_scan as s


@pytest.fixture(scope="module")
def pieces():
    return s.load()


def best_sum(pieces, text):
    """Plain dynamic programme over the whole text."""
    marked, _ = s.with_marks(text.encode())
    best = [0] + [None] * len(marked)
    for e in range(1, len(marked) + 1):
        for b in range(max(0, e - pieces.longest), e):
            part = marked[b:e]
            worth = pieces.known[part][1] if part in pieces.known else pieces.unknown if e == b + 1 else None
            if worth is not None and best[b] is not None and (best[e] is None or best[b] + worth > best[e]):
                best[e] = best[b] + worth
    return best[-1]


def sum_of(pieces, ids, text):
    score = {i: w for i, w in pieces.known.values()}
    marked, stand_in = s.with_marks(text.encode())
    spelled = sum(c not in pieces.known for c in marked)
    return sum(score.get(int(i), 0) for i in ids) + spelled * pieces.unknown


def test_whole_and_chunked_agree_with_the_plain_programme(pieces, rows):
    rng, encoder = random.Random(3), s.Encoder(pieces)
    texts = [r[1][:400] for r in rows if r[1]][::9] + [" " * 70 + "word", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "▁", "a▁b ﷐", "x\n\n y\t", "é日本"]
    for text in texts:
        whole = encoder.encode(text.encode())
        ids = np.frombuffer(whole, np.int32)
        assert sum_of(pieces, ids, text) == best_sum(pieces, text)
        assert b"".join(pieces.bytes_of[i] for i in ids)[1:] == text.encode()
        for size in (1, 3, rng.randint(4, 40)):
            parts = encoder.chunks(text.encode(), size)
            matrices = [encoder.matrix(*p[1:]) for p in parts]
            states = s.boundaries(matrices, 0, 0)
            assert b"".join(encoder.traced(*p[1:], states[k], states[k + 1]) for k, p in enumerate(parts)) == whole


def test_product_is_associative(pieces):
    encoder = s.Encoder(pieces)
    a, b, c = (encoder.matrix(*p[1:]) for p in encoder.chunks(b"the quick brown fox jumps over it", 12)[:3])
    assert (s.product(s.product(a, b), c) == s.product(a, s.product(b, c))).all()


def test_giants_equal_short_texts(spark, documents, rows, pieces):
    """All texts as giants in many runs and chunks, and none: the same ids, and every text comes back."""
    s_run, s.RUN = s.RUN, 4
    try:
        giant = s.encoded(documents.select("doc_id", "text", "node"), pieces, giant=20, chunk=50)
        got = s.decoded(giant, pieces).collect()
    finally:
        s.RUN = s_run
    short = {(r["doc_id"], r["text"]): r["ids"] for r in s.encoded(documents, pieces).collect()}
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == short[r["doc_id"], r["text"]] and r["decoded"] == r["text"] and r["node"] == "y"


def test_edges(spark, none, pieces):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("\x00",)], "text string")
    got = s.decoded(s.encoded(df, pieces), pieces).collect()
    assert {r["text"]: (r["ids"] if not r["ids"] else len(r["ids"]), r["decoded"]) for r in got}[None] == (None, None)
    assert all(r["decoded"] == r["text"] for r in got)
    assert s.encoded(none, pieces).count() == 0
    odd = spark.createDataFrame([([5, -1, 10**6, 400],)], "ids array<int>")
    assert s.decoded(odd, pieces).count() == 1


def test_broken_utf8_comes_back(spark, pieces):
    df = spark.createDataFrame([(bytearray(b"ab\xff\xfe c"),)], "raw binary").select(F.col("raw").cast("string").alias("text"))
    got = s.decoded(s.encoded(df, pieces), pieces).select(F.col("decoded").cast("binary").alias("b")).first()
    assert bytes(got["b"]) == b"ab\xff\xfe c"

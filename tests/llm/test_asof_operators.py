from pyspark.sql import functions as F

from stallwise.llm import quotes, revisits
from stallwise.llm.asof import latest_earlier


def test_latest_earlier_of_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i % 5}" if i % 2 else None, i % 50, i, i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, i int, s boolean")
    got = {r["i"]: r["found"] and r["found"]["i"] for r in latest_earlier(df, "k", ["t", "i"], F.col("s"), ["i"], "found").collect()}
    for k, t, i, _ in rows:
        before = [(t2, i2) for k2, t2, i2, s in rows if s and k is not None and k2 == k and (t2, i2) < (t, i)]
        assert got[i] == (max(before)[1] if before else None)


RECORDS = [
    (1, "http://A.example/x/?b=2&a=1#f", 10, 200, '"e1"', None, "Date: 1\nContent-Type: text\nVary: a\nVary: b", "d1", 5),
    (2, "https://a.example:443/x?a=1&utm_source=z&b=2", 20, 304, 'W/"e1"', None, "Date: 2\nContent-Length: 0\nX: new", None, None),
    (3, "http://a.example/x?a=1&b=2", 30, 304, '"other"', None, None, None, None),
    (4, "http://a.example/x?a=1&b=2", 40, 304, None, None, "", None, None),
    (5, "http://a.example/y", 5, 304, '"e1"', None, "no colon", None, None),
    (6, "http://a.example/y", 6, 200, None, "monday", "", "d2", 7),
    (7, "http://a.example/y", 7, 304, None, "monday", "Date: 9", None, None),
    (8, None, 8, 304, '"e1"', None, None, None, None), (9, "not a url", 9, 200, None, None, None, "d3", 1),
    (10, "http://a.example/y", 8, None, None, None, None, None, None), (11, "http://a.example/y", 7, 404, None, None, None, None, None),
]


def test_revisits(spark):
    df = spark.createDataFrame(RECORDS, "record_id long, url string, ts long, status int, etag string, last_modified string, headers string, digest string, body_bytes long").withColumn("outcome", F.lit("clash"))
    got = {r["record_id"]: r for r in revisits.resolved(df).collect()}
    assert {i: (r["outcome"], r["source_id"]) for i, r in got.items()} == {
        1: ("response", None), 2: ("resolved", 1), 3: ("mismatch", 1), 4: ("unvalidated", 1), 5: ("orphan", None), 6: ("response", None),
        7: ("resolved", 6), 8: ("orphan", None), 9: ("response", None), 10: ("other", None), 11: ("other", None),
    }
    assert got[2]["headers"] == "content-type: text\ndate: 2\nvary: a, b\nx: new" and (got[2]["digest"], got[2]["body_bytes"]) == ("d1", 5)
    assert got[5]["headers"] == "no colon: " and got[7]["headers"] == "date: 9"
    assert got[1]["url_key"] == got[2]["url_key"] == "a.example/x?a=1&b=2" and got[9]["url_key"] is None
    assert revisits.resolved(df.limit(0)).count() == 0


MESSAGES = [
    (1, 0, "a", "Hello  World\nsecond line"), (1, 1, "b", "> hello world\nyes"), (1, 2, "a", ">> Hello World\n> yes\nno"),
    (1, 3, "c", "> second LINE\n> not said\nwhat"), (1, 4, "d", "> >no\n\n>\nlost"), (1, 5, "e", None), (1, 6, "e", ""), (1, 7, "f", "> what\n> no\n> yes\nall"),
    (2, 0, "a", "> hello world\nother conversation"), (None, 0, "a", "first"), (None, 1, "b", "> first\nreply"), (1, 7, "f", "> what\n> no\n> yes\nall"),
]


def test_quotes(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string").withColumn("level", F.lit(1))
    got = quotes.linked(df).collect()
    assert len(got) == len(MESSAGES)
    one = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["place"])
    assert [r["place"] for r in one] == list(range(9))
    parent = {r["turn"]: (r["parent_turn"], r["root_turn"], r["depth"]) for r in one}
    assert parent == {0: (None, 0, 0), 1: (0, 0, 1), 2: (1, 0, 2), 3: (0, 0, 1), 4: (2, 0, 3), 5: (None, 5, 0), 6: (None, 6, 0), 7: (3, 0, 2)}
    body = {r["turn"]: r["body"] for r in one}
    assert (body[2], body[4], body[5], body[6]) == ("no", "\nlost", None, "")
    place = {r["turn"]: r["place"] for r in one}
    assert all(place[t] > place[p[0]] for t, p in parent.items() if p[0] is not None)
    assert [(r["turn"], r["parent_turn"]) for r in sorted((r for r in got if r["conv_id"] is None), key=lambda r: r["place"])] == [(0, None), (1, 0)]
    assert quotes.linked(df.limit(0)).count() == 0


def test_hot_line_in_a_hot_conversation(spark):
    """A line that every message says and quotes: each replies to the message before it."""
    rows = [(1, t, "r", ("> same line\n" if t else "") + "same line") for t in range(60)]
    got = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["turn"]: (r["parent_turn"], r["depth"]) for r in got} == {t: (t - 1 if t else None, t) for t in range(60)}
    assert [r["turn"] for r in sorted(got, key=lambda r: r["place"])] == list(range(60))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")
    plan = quotes.linked(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_passages_are_found_across_line_breaks(spark):
    """Quotes wrapped anew, of several lines, of some sentences only; a fragment of a sentence leads nowhere."""
    rows = [
        (1, 0, "a", "The first thing is long\nand goes over lines. The second one\nis short! A third"),
        (1, 1, "b", "Something else. Entirely so."),
        (1, 2, "c", "> The first thing\n> is long and goes\n> over lines.\nNoted."),
        (1, 3, "d", "> the second  ONE is short!\nFine."),
        (1, 4, "e", ">> goes over lines. The second one is\n>> short! A third\n> Noted.\n> Fine.\nBoth."),
        (1, 5, "f", "> second one\nA fragment."),
        (1, 6, "g", "> and goes over lines. the second one\nA line."),
        (1, 7, "h", "> Both. > not a mark\nx\x01y\x02z"),
    ]
    got = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["turn"]: r["parent_turn"] for r in got} == {0: None, 1: None, 2: 0, 3: 0, 4: 3, 5: None, 6: 0, 7: 4}
    assert next(r["body"] for r in got if r["turn"] == 7) == "x\x01y\x02z"


def test_passages(spark):
    lines = ["own one", "own two.", "> q. one", "> q two", "> > deep", "", "own three"]
    row = spark.createDataFrame([(lines,)], "lines array<string>").select(quotes.passages(F.col("lines")).alias("p")).first()
    assert row["p"] == ["", "0\x02own one own two.", "1\x02q. one q two", "2\x02deep", "0\x02 own three"]
    assert spark.createDataFrame([(None,), ([],)], "lines array<string>").select(F.explode(quotes.passages(F.col("lines")))).where("col <> ''").count() == 0

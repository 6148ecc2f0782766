import itertools
import random
import re
from html import unescape

import pytest

from conftest import SF
from stallwise.llm import html_mincut as h

PLAIN = h.learnt({})
LONG = "A sentence of some length that says what happened, to whom, and why it was so."


def test_minimum_cut_equals_all_labellings():
    """The chosen labels cost no more than any others, and no smaller source side does as well."""
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 8)
        terminal = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(i, i + 1, rng.randint(0, 5)) for i in range(n - 1)] + [(rng.randrange(n), rng.randrange(n), rng.randint(0, 3)) for _ in range(n // 2)]
        edges = [e for e in edges if e[0] != e[1]]

        def cost(kept):
            return sum((x > 0) * x if not k else (x < 0) * -x for x, k in zip(terminal, kept)) + sum(w for a, b, w in edges if kept[a] != kept[b])

        every = list(itertools.product([False, True], repeat=n))
        best = min(map(cost, every))
        smallest = min((k for k in every if cost(k) == best), key=sum)
        assert h.source_side(terminal, edges) == list(smallest)


def test_smoothness_decides_doubtful_blocks():
    assert h.source_side([3, -1, 3], [(0, 1, 2), (1, 2, 2)]) == [True, True, True]
    assert h.source_side([3, -5, 3], [(0, 1, 2), (1, 2, 2)]) == [True, False, True]
    assert h.source_side([0, 0], [(0, 1, 2)]) == [False, False]


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), (" \n ", ""), ("<script>var a='<p>no</p>'", ""), ("<title>t", ""),
    (f"<article><h1>Title</h1><p>{LONG}</article>", f"Title {LONG}"),
    (f"<article><p>One&nbsp;&amp;\n two &#8211; &eacute;<br>three.</p><p>{LONG}</p></article>", f"One & two – é three. {LONG}"),
    (f"<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><article><p>{LONG}</p></article><footer>&copy; us</footer>", LONG),
    (f"<nav><a href=/>Home</a><article><p>{LONG}</p></article>", LONG),  # a menu that never ends
    (f"<div class='post-content'><p>{LONG}</p><div class=\"ad-slot\"><p>{LONG}</p></div><p>Short.</p></div>", f"{LONG} Short."),
    (f"<main><p>{LONG}</p><section id=comments><article><p>{LONG} Indeed.</p></article></section></main>", LONG),
    (f"<main><p>{LONG}</p><aside>{LONG}</aside><form><label>Mail</label><input><button>Go</button></form></main>", LONG),
    (f"<main><div class='cookie-notice'>{LONG}</div><style>p{{}}</style><p hidden>{LONG}</p><p>{LONG}</p><!-- <p>{LONG}</p> --></main>", LONG),
    (f"<article><p><b>Bold <i>and</i> plain.<br><p>{LONG}</b></span></article>", f"Bold and plain. {LONG}"),
    (f"<ul><li><a href=a>Home</a><li><a href=b>More</a></ul><h1>Title of it</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p>", f"Title of it {LONG} Yes. {LONG}"),
    (f"<article><p>a &lt;b&gt; c, {LONG}</p><p title='x>y'>{LONG}</p></article>", f"a <b> c, {LONG} {LONG}"),
])
def test_cases(html, text):
    assert h.main_text(html, PLAIN) == text


def truth(html):
    inner = re.sub(r"</?b>", "", re.sub(r"</?(p|h\d|br)>", " ", re.search(r"<article>(.*?)</article>", html, re.S)[1]))
    return " ".join(unescape(inner).split())


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in h.extracted(pages).collect()}
    for page in pages.collect():
        assert out[page.page_id].text == truth(page.html)
        assert out[page.page_id].n_chars == len(out[page.page_id].text)


def test_training_counts_all_landmarks(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(40)
    counts = {}
    for page in pages.collect():
        for block in h.blocks(page.html)[0]:
            for f in h.features(block) if block.kind else []:
                counts[f, int(block.kind > 0)] = counts.get((f, int(block.kind > 0)), 0) + 1
    assert h.trained(pages.repartition(3)) == pytest.approx(h.learnt(counts))


def test_odd_rows(spark):
    """Nulls, repeated rows, a long page, columns with the operator's own names, an empty table."""
    long = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    rows = [(1, None, "r", "t", 1), (None, f"<article>{LONG}</article>", None, None, None), (1, None, "r", "t", 1), (2, long, "", "", 0)]
    schema = "page_id long, html string, row string, text string, n_chars long"
    out = h.extracted(spark.createDataFrame(rows, schema)).collect()
    whole = 20_000 * (len(LONG) + 1) - 1
    assert sorted((str(r.page_id), r.n_chars, str(r.row)) for r in out) == [("1", 0, "r"), ("1", 0, "r"), ("2", whole, ""), ("None", len(LONG), "None")]
    assert h.extracted(spark.createDataFrame([], schema)).collect() == []


def test_deep_and_unbalanced_pages_end():
    assert h.main_text("<div>" * 20_000 + "x" + "</b>" * 20_000, PLAIN) == ""
    assert LONG in h.main_text("<article><p class=\"" * 3 + f"<p>{LONG}</p>" * 3 + "<a href='", PLAIN) + LONG

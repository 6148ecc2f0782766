"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks: runs of text between block-level tags, with the element they lie in. Every block gets a
number of evidence for content (positive) or boilerplate (negative), the sum of

* its landmark: +6 inside an article or main element or one named so, -6 inside menus, headers, footers, sidebars, notices,
  adverts, forms and reader comments. The innermost landmark decides, but comments, sidebars and link lists stay what they
  are even if an article element lies in them;
* a naive Bayes classifier over length, share of linked text, last character and kind of element. It is trained on all
  blocks of the given pages that have a landmark, in one counting pass, with a stated prior of 100 blocks a side, so
  that a handful of pages or pages without landmarks do not upset it. Its sum is held within +-4.

Evidence for content is the capacity from the source, evidence against it the capacity to the sink. Smoothness edges join
neighbouring blocks (heavier the fewer elements lie between them, lighter across landmarks) and blocks of the same parent
with something else in between. Blocks on the source's side of the minimum cut are the text; ties fall to boilerplate.

Scale. A page is one row and one small graph with at most two edges a block; the counting pass sends at most
``FEATURES`` x 2 numbers per partition to one small aggregate, which is all that reaches the driver. Nothing is shuffled
but these counts. Pages are read twice, their blocks are not stored.

Defined cases. A null or empty page has an empty text. Pages of any length are read whole, in batches of bounded size.
Unclosed elements are closed as browsers do (a new paragraph ends an open one); stray end tags are ignored; a script,
style, title or text area that never ends swallows the rest. Repeated rows give repeated results. Other columns pass
through ``extracted`` unchanged unless their name is ``text`` or ``n_chars``; those are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.common import portions

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*\"|=\s*+'[^']*'|[\"'=])*+)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input".split()
)
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style title textarea iframe noembed noframes head noscript template select option button svg canvas object audio video datalist".split())
# An opening tag of the second kind ends an open element of the first one, looked for up to the listed borders.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CONTENT, NEUTRAL, BOILERPLATE, FIRM = 1, 0, -1, -2

TAG_KIND = {"article": CONTENT, "main": CONTENT, "nav": BOILERPLATE, "header": BOILERPLATE, "footer": BOILERPLATE, "menu": BOILERPLATE,
            "form": BOILERPLATE, "dialog": BOILERPLATE, "fieldset": BOILERPLATE, "aside": FIRM}
GOOD_WORDS = frozenset("article articles articlebody main maincontent content entry post story blogpost".split())
BAD_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion banner nav navbar navigation menu
    breadcrumb breadcrumbs footer header masthead toolbar topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
    subscribe subscription signup login signin register search searchbox form share sharing social pagination pager copyright legal
    disclaimer contentinfo dialog skip tags byline""".split()
)
FIRM_WORDS = frozenset("comment comments commentlist disqus respond replies reviews sidebar sidebars aside complementary widget widgets related recommended recommendations teaser teasers trending".split())

LANDMARK, LEARNT, NEAR, KIN, ACROSS, SCALE, PRIOR = 6.0, 4.0, 1.5, 1.0, 0.25, 1000, 100
# Features of a block and their prior shares: name -> (share among content, share among boilerplate). Groups add up to 1.
GROUPS = {
    "words": {"1": (0.05, 0.30), "2": (0.04, 0.20), "4": (0.08, 0.22), "8": (0.15, 0.15), "16": (0.23, 0.09), "32+": (0.45, 0.04)},
    "links": {"none": (0.80, 0.35), "some": (0.15, 0.10), "half": (0.03, 0.10), "most": (0.02, 0.45)},
    "end": {"stop": (0.80, 0.25), "other": (0.20, 0.75)},
    "kind": {"p": (0.70, 0.15), "heading": (0.12, 0.03), "item": (0.08, 0.45), "other": (0.10, 0.37)},
    "mark": {"right": (0.01, 0.10), "bar": (0.01, 0.08), "plain": (0.98, 0.82)},
}
FEATURES = [(group, value) for group, values in GROUPS.items() for value in values]
PLACE = {feature: i for i, feature in enumerate(FEATURES)}


class Block:
    __slots__ = ("text", "linked", "kind", "tag", "element", "parent", "weight")

    def __init__(self, text: str, linked: int, kind: int, tag: str, element: int, parent: int):
        self.text, self.linked, self.kind, self.tag, self.element, self.parent = text, linked, kind, tag, element, parent


def landmark(tag: str, attributes: str, around: int) -> int:
    """What an element says of its contents, given what the elements around it say."""
    said = TAG_KIND.get(tag, NEUTRAL)
    words = set()
    if attributes and tag not in ("html", "body"):
        for found in NAMES.finditer(attributes):
            words.update(w.lower() for w in WORD.findall(found[1] or found[2] or found[3] or ""))
    good = bool(words & GOOD_WORDS)
    if words & FIRM_WORDS:
        said = FIRM
    elif words & BAD_WORDS and said != CONTENT:
        said = NEUTRAL if good and words & {"header", "banner"} else BOILERPLATE
    elif good and said == NEUTRAL:
        said = CONTENT
    if tag == "header" and around == CONTENT and said != FIRM:
        said = NEUTRAL  # the article's own head
    if said == NEUTRAL or around == FIRM:
        return around
    return said


def blocks(html: str) -> tuple[list[Block], list[int]]:
    """Blocks in page order, and the parent of every block-level element (0 is the page)."""
    found: list[Block] = []
    parents, names, opened = [0], ["#page"], {}
    # open elements: tag, block-level number, landmark, unseen, linked
    stack: list[tuple[str, int, int, bool, bool]] = [("#page", 0, NEUTRAL, False, False)]
    pieces: list[str] = []
    linked = at = 0

    def add(raw: str) -> None:
        nonlocal linked
        top = stack[-1]
        if top[3]:
            return
        text = unescape(raw)
        pieces.append(text)
        if top[4]:
            linked += len(text) - text.count(" ")

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                element = stack[-1][1]
                found.append(Block(text, linked, stack[-1][2], names[element], element, parents[element]))
            linked = 0

    def close(to: int) -> None:
        """Ends all elements from place ``to`` on."""
        if any(e[0] not in INLINE for e in stack[to:]):
            flush()
        for gone in stack[to:]:
            opened[gone[0]] -= 1
        del stack[to:]

    size = len(html)
    while at < size:
        token = TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        if token.start() > at:
            add(html[at : token.start()])
        at = token.end()
        tag = token[2]
        if tag is None:
            if token[0].startswith("<![CDATA["):
                add(token[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if token[1]:
            if tag == "br":
                add(" ")
            elif opened.get(tag, 0):
                inline = tag in INLINE
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place][0] == tag:
                        close(place)
                        break
                    if inline and stack[place][0] not in INLINE:
                        break
            elif tag not in INLINE:
                flush()
            continue
        attributes = token[3]
        if tag in VOID:
            if tag not in INLINE:
                flush()
            elif tag == "br":
                add(" ")
            continue
        if tag in RAW:
            flush() if tag not in ("script", "style") else None
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else size
            continue
        block = tag not in INLINE
        if block:
            if opened.get("p", 0):
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place][0] == "p":
                        close(place)
                        break
                    if stack[place][0] not in INLINE:
                        break
            if tag in ENDS:
                ended, borders = ENDS[tag]
                if any(opened.get(t, 0) for t in ended):
                    lowest = 0
                    for place in range(len(stack) - 1, 0, -1):
                        if stack[place][0] in borders:
                            break
                        if stack[place][0] in ended:
                            lowest = place
                    if lowest:
                        close(lowest)
            flush()
        elif tag == "a" and opened.get("a", 0):
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] == "a":
                    close(place)
                    break
                if stack[place][0] not in INLINE:
                    break
        _, element, around, unseen, inside = stack[-1]
        kind = landmark(tag, attributes, around) if block else around
        if block:
            parents.append(element)
            names.append(tag)
            element = len(parents) - 1
        unseen = unseen or tag in UNSEEN or bool(attributes and HIDDEN.search(attributes))
        opened[tag] = opened.get(tag, 0) + 1
        if not attributes.endswith("/") or tag not in ("svg", "canvas", "object"):
            stack.append((tag, element, kind, unseen, inside or tag == "a"))
        else:
            opened[tag] -= 1
    flush()
    return found, parents


def features(block: Block) -> list[int]:
    """One feature of each group."""
    text = block.text
    words, letters = text.count(" ") + 1, len(text) - text.count(" ")
    share = block.linked / letters
    size = next((name for name, most in (("1", 1), ("2", 3), ("4", 7), ("8", 15), ("16", 31)) if words <= most), "32+")
    links = "none" if share == 0 else "some" if share <= 1 / 3 else "half" if share <= 2 / 3 else "most"
    kind = "p" if block.tag in ("p", "blockquote", "pre") else "heading" if block.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else "item" if block.tag in ("li", "dt", "dd", "td", "th") else "other"
    mark = "right" if "©" in text else "bar" if " | " in text or "»" in text or "·" in text else "plain"
    end = "stop" if text.rstrip("\"')]”»")[-1:] in tuple(".!?:;…。！？") else "other"
    return [PLACE["words", size], PLACE["links", links], PLACE["end", end], PLACE["kind", kind], PLACE["mark", mark]]


def learnt(counts: dict[tuple[int, int], int]) -> list[float]:
    """Evidence of each feature from counts of (feature, landmark is content)."""
    evidence = []
    for place, (group, value) in enumerate(FEATURES):
        share = []
        for side in (1, 0):
            total = sum(counts.get((PLACE[group, v], side), 0) for v in GROUPS[group])
            share.append((counts.get((place, side), 0) + PRIOR * GROUPS[group][value][1 - side]) / (total + PRIOR))
        evidence.append(log(share[0] / share[1]))
    return evidence


def weigh(found: list[Block], evidence: list[float]) -> list[int]:
    """Terminal capacities: above 0 from the source, below 0 to the sink."""
    out = []
    for block in found:
        mind = sum(evidence[f] for f in features(block))
        mind = max(-LEARNT, min(LEARNT, mind)) + LANDMARK * max(-1, block.kind)
        out.append(round(SCALE * mind))
    return out


def smoothness(found: list[Block], parents: list[int]) -> list[tuple[int, int, int]]:
    """Edges (block, block, capacity) between neighbours and between blocks of one parent."""
    depth = [0] * len(parents)
    for i in range(1, len(parents)):
        depth[i] = depth[parents[i]] + 1
    edges, last = [], {}
    for i, block in enumerate(found):
        if i:
            a, b, apart = found[i - 1].element, block.element, 1
            while a != b:
                if depth[a] < depth[b]:
                    a, b = b, a
                a, apart = parents[a], apart + 1
            near = NEAR * (3 / max(3, apart)) ** 2
            if (found[i - 1].kind > 0) != (block.kind > 0) or (found[i - 1].kind < 0) != (block.kind < 0):
                near *= ACROSS
            edges.append((i - 1, i, round(SCALE * near)))
        before = last.get(block.parent)
        if before is not None and before != i - 1:
            edges.append((before, i, round(SCALE * KIN)))
        last[block.parent] = i
    return edges


def source_side(terminal: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut, the smallest such set.

    ``terminal`` is the capacity from the source (above 0) or to the sink (below 0); edges carry their capacity both ways.
    Shortest augmenting paths in phases: distances by breadth, then paths along them until none is left.
    """
    n = len(terminal)
    left = list(terminal)
    out: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, w in edges:
        if w > 0:
            out[a].append(len(to)), to.append(b), room.append(w)
            out[b].append(len(to)), to.append(a), room.append(w)
    while True:
        level = [0 if x > 0 else -1 for x in left]
        wave = [i for i in range(n) if left[i] > 0]
        met = False
        while wave and not met:
            following = []
            for a in wave:
                for e in out[a]:
                    b = to[e]
                    if room[e] and level[b] < 0:
                        level[b] = level[a] + 1
                        following.append(b)
                        met = met or left[b] < 0
            wave = following
        if not met:
            return [x >= 0 for x in level]
        tried = [0] * n
        for start in range(n):
            path: list[int] = []
            a = start
            while left[start] > 0:
                if left[a] < 0:
                    moved = min(left[start], -left[a], *[room[e] for e in path])
                    left[start] -= moved
                    left[a] += moved
                    for e in path:
                        room[e] -= moved
                        room[e ^ 1] += moved
                    path, a = [], start
                    continue
                while tried[a] < len(out[a]):
                    e = out[a][tried[a]]
                    if room[e] and level[to[e]] == level[a] + 1:
                        path.append(e)
                        a = to[e]
                        break
                    tried[a] += 1
                else:
                    if not path:
                        break
                    a = to[path.pop() ^ 1]
                    tried[a] += 1


def main_text(html: str | None, evidence: list[float]) -> str:
    if not html:
        return ""
    found, parents = blocks(html)
    kept = source_side(weigh(found, evidence), smoothness(found, parents))
    return " ".join(block.text for block, keep in zip(found, kept) if keep)


def trained(pages: DataFrame, column: str = "html") -> list[float]:
    """Evidence of each feature, learnt from all blocks with a landmark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[0, 0] for _ in FEATURES]
        for batch in portions(batches, 0):
            for html in batch.column(0).to_pylist():
                for block in blocks(html or "")[0]:
                    if block.kind:
                        for f in features(block):
                            counts[f][block.kind > 0] += 1
        seen = [(f, side, n) for f, sides in enumerate(counts) for side, n in enumerate(sides) if n]
        yield pa.RecordBatch.from_pydict({name: pa.array([row[i] for row in seen], kind) for i, (name, kind) in enumerate((("feature", pa.int32()), ("side", pa.int32()), ("n", pa.int64())))})

    counted = pages.select(column).mapInArrow(count, "feature int, side int, n long").groupBy("feature", "side").agg(F.sum("n").alias("n"))
    return learnt({(row.feature, row.side): row.n for row in counted.collect()})


def extracted(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of ``pages`` but ``column``, with ``text`` and ``n_chars``, its code points."""
    evidence = trained(pages, column)
    others = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    kept = pages.select(F.struct(*others).alias("row"), F.col(column).alias("html"))
    schema = kept.select("row", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1):
            texts = [main_text(html, evidence) for html in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["row", "text", "n_chars"])

    return kept.mapInArrow(extract, schema).select("row.*", "text", "n_chars")

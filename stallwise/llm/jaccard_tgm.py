"""N-gram Jaccard join by a token-group matrix: exact links between sets of word shingles.

A document's set holds its distinct shingles as 64-bit hashes. Two documents link when 100 * |x and y| >= percent * |x or y|.
Equal sets are one node. The rest goes in four steps.

1. Signatures. Linked sets differ in at most (100 - p) / (100 + p) * (|x| + |y|) shingles. In each band of sizes the hash
   space is cut into that many segments and a few more, so linked sets agree on a whole segment that is not empty; the
   hash of a segment's shingles is a signature. A set near the lower edge of the next band also uses that band's cut. A set with
   too many empty segments (rare) also uses the next of several independent cuts, so no link is missed.
   A set shares at least as many signatures of a cut as it has occupied segments beyond the shingles that can differ; cuts in
   which it shares fewer with anyone are dropped. Of that many shared ones it may pass over all but one, so the others that
   most sets hold, mostly passages in common, bring nobody together.
2. Groups. A signature that two nodes share has its smallest node as leader; each node joins the group of the leader it shares
   most signatures with. Groups are split so that their members stay within ``GROUP_TOKENS`` shingles.
3. Token-group matrix. A group is stored as one row with its members' sets and the union of them. Two groups meet once
   if they share a signature that neither passes over. A member is looked up in the other group's union: the overlap bounds
   its overlap with every member there, and the group is opened for it only if the bound reaches the threshold.
4. Opened members are compared exactly. Of the links found a spanning forest is returned, so copies are never expanded to
   all pairs, and no link that joins two components is lost. Components follow by iterated minimum labels.

Scale. Texts are read twice: once for signatures (stored, about one per six shingles), once for sets of documents that
share one. Counting a signature combines map-side; the join back to hot ones is split by adaptive execution. Pairs of groups
are compared in rounds, so that what a round carries stays within a few times the stored groups, however many pairs there are.

Defined cases. Null, empty and blank texts have no shingles and are alone. With fewer words than a shingle the whole
sequence is one. Rows that share a doc_id are documents of their own. A null id is larger than all others, and comes out
null. Other columns are ignored. Different shingles are assumed to have different 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise.llm.common import portions, text_bytes
from stallwise.session import discard, durable

WIDTH = 3
PERCENT = 90
GROUP_MEMBERS = 128
GROUP_TOKENS = 100_000
CUTS = 6  # independent cuts; a set that finds all of them too empty uses a signature of its size band alone
MOST_BROADCAST = 500_000  # ids, 16 bytes each, up to which the list of documents to read again is broadcast
LAST_CUT = 511  # the low bits of a signature
NO_ID = (1 << 63) - 1
WORDS_KEPT = 300_000
SLICES = 8  # signatures are matched in so many rounds, by hash
CARRIED = 4  # a round of comparisons carries about so many times the bytes of all groups


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over an array."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of each word, worked out once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.lower().split() if text else []  # bytes: only A-Z are lowered
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(width, len(h))
    total = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0x100000001B3) + h[i : len(h) - size + 1 + i]
    total = np.sort(mixed(total, size))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def node_of(tokens: np.ndarray) -> int:
    """Hash of a set; the sum does not depend on order."""
    return int(mixed(mixed(tokens, 11).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(tokens)), 12).astype(np.int64)[0])


@cache
def bands(percent: int) -> list[tuple[int, int, int, int]]:
    """(smallest size, largest size, most differing shingles, segments) per band, from the smallest sizes at which
    unequal sets can link.

    A set must occupy more segments than shingles can differ. There are so many segments that the smallest set which
    uses the band's cut does so with two standard deviations to spare.
    """
    low, out = -(-100 // (100 - percent)), []
    while low < 1 << 31:
        high = low * 3 // 2
        differing = 2 * high * (100 - percent) // (100 + percent)
        size, segments = max(2, percent * low // 100), differing + 1
        while segments < 8 * size:
            free, pair = (1 - 1 / segments) ** size, max(0.0, 1 - 2 / segments) ** size
            spread = segments * (segments - 1) * pair + segments * free - (segments * free) ** 2
            if segments * (1 - free) - 2 * max(0.0, spread) ** 0.5 >= differing + 1:
                break
            segments += max(1, segments // 50)
        out.append((low, high, differing, segments))
        low = high + 1
    return out


def cut(tokens: np.ndarray, segments: int, band: int, seed: int) -> tuple[np.ndarray, int]:
    """Signatures of the segments that hold something, and the number of empty segments."""
    t = tokens if seed == 0 else np.sort(mixed(tokens, 100 + seed))
    at = ((t >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)  # rises with t
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    sums = np.add.reduceat(mixed(t, 21), starts)
    return mixed(sums + at[starts] * np.uint64(0x9E3779B97F4A7C15), 1000 + 64 * seed + band), segments - len(starts)


def signatures(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, list[int], list[int]]:
    """All signatures, with the number of their cut in the low bits; the cuts, and how many signatures of each a set
    shares with any set that it is linked to by that cut."""
    n, found, cuts, needs = len(tokens), [], [], []
    for band, (low, high, differing, segments) in enumerate(bands(percent)):
        if n > high:
            continue
        if 100 * n < percent * low:
            break
        for seed in range(CUTS):
            made, empty = cut(tokens, segments, band, seed)
            found.append(numbered(made, CUTS * band + seed))
            cuts.append(CUTS * band + seed)
            needs.append(max(1, segments - empty - differing))
            if segments - empty > differing:
                break
        else:
            found.append(numbered(mixed(np.array([band], dtype=np.uint64), 77), LAST_CUT))
            cuts.append(LAST_CUT)
            needs.append(1)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64), cuts, needs


def numbered(made: np.ndarray, number: int) -> np.ndarray:
    return (made & ~np.uint64(LAST_CUT)) | np.uint64(number)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64), kind))


def signed_sets(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """id, text_key, n_shingles, node (null without shingles), cuts and needs of every document, and its signatures in
    SLICES columns."""
    names = ["id", "text_key", "n_shingles", "node", "cuts", "needs", *[f"signatures_{k}" for k in range(SLICES)]]
    kinds = ["long"] * 4 + ["array<int>"] * 2 + ["array<long>"] * SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in portions(batches, "text"):
            sets = [shingles(text, width, hashes) for text in text_bytes(batch.column("text"))]
            signed = [signatures(s, percent) for s in sets]
            made = [s[0] for s in signed]
            parts = [(m >> np.uint64(40)) % np.uint64(SLICES) for m in made]
            sliced = [lists([m[p == k] for m, p in zip(made, parts)], pa.int64()) for k in range(SLICES)]
            sliced = [pa.array([s[1] for s in signed], pa.list_(pa.int32())), pa.array([s[2] for s in signed], pa.list_(pa.int32())), *sliced]
            found = [pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_key"), *found, *sliced], names=names)

    return rows_in(documents).mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds)))


def rows_in(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))


def sets_again(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """node, tokens of the documents with these ids, read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in portions(batches, "text"):
            sets = [s for s in (shingles(text, width, hashes) for text in text_bytes(batch.column("text"))) if len(s)]
            yield pa.RecordBatch.from_pydict({"node": pa.array([node_of(s) for s in sets], pa.int64()), "tokens": pa.array([s.tobytes() for s in sets], pa.binary())})

    chosen = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    return rows_in(documents).join(chosen, "id", "left_semi").mapInArrow(run, "node long, tokens binary")


def led(rows: DataFrame) -> DataFrame:
    """The rows whose signature is on more than one node, with its smallest node as leader and the number of its holders."""
    shared = rows.groupBy("signature").agg(F.min("node").alias("leader"), F.max("node").alias("last"), F.count("*").alias("holders")).where(F.col("leader") != F.col("last"))
    return rows.join(shared.drop("last"), "signature")


def memberships(sets: DataFrame) -> DataFrame:
    """signature, node, leader, meets: the signatures that nodes share, and whether the node meets others by them.

    Slices are matched one after the other, so that the shuffles of one can go before the next begins. A node then
    stays in a cut only with as many shared signatures as a link needs: a passage in common is seldom enough.

    Of a cut's signatures in the order of their holders a node passes over the last ``needed - 1``. Linked nodes share
    as many of a cut as either needs, so the one of these with the fewest holders is passed over by neither.
    """
    found = [durable(led(sets.select(F.explode(f"signatures_{k}").alias("signature"), "node").distinct()).select("signature", "node")) for k in range(SLICES)]
    rows = reduce(DataFrame.unionByName, found).select("signature", "node", F.col("signature").bitwiseAND(F.lit(LAST_CUT).cast("long")).cast("int").alias("cut"))
    needs = sets.where(F.size("cuts") > 0).select("node", F.explode(F.arrays_zip("cuts", "needs")).alias("c")).groupBy("node", F.col("c.cuts").alias("cut")).agg(F.min("c.needs").alias("needed"))
    enough = rows.groupBy("node", "cut").agg(F.count("*").alias("n")).join(needs, ["node", "cut"]).where("n >= needed").select("node", "cut", "needed")
    kept = durable(rows.join(enough, ["node", "cut"]).select("signature", "node", "cut", "needed"))
    for step in found:
        discard(step)
    most = Window.partitionBy("node", "cut").orderBy(F.desc("holders"), "signature")
    members = durable(led(kept).select("signature", "node", "leader", (F.row_number().over(most) >= F.col("needed")).alias("meets")))
    discard(kept)
    return members


def groups_of(members: DataFrame, sets: DataFrame) -> DataFrame:
    """node, group: the leader with most shared signatures, and a part of its group of bounded size."""
    best = members.groupBy("node", "leader").agg(F.count("*").alias("n")).groupBy("node").agg(F.max_by("leader", F.struct("n", -F.col("leader"))).alias("leader"))
    sizes = sets.where(F.col("node").isNotNull()).groupBy("node").agg(F.max("n_shingles").alias("size"))
    sized = best.join(sizes, "node")
    parts = sized.groupBy("leader").agg(F.ceil(F.greatest(F.sum("size") / GROUP_TOKENS, F.count("*") / GROUP_MEMBERS)).alias("parts"))
    return durable(sized.join(parts, "leader").select("node", F.xxhash64("leader", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("group")))


def group_rows(tokens: DataFrame, groups: DataFrame) -> DataFrame:
    """The token-group matrix: group, nodes, sizes, union of the members' sets, their tokens as places in it, and its bytes."""
    import pandas as pd

    def stored(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node").sort_values("node")
        sets = [np.frombuffer(t, np.uint64) for t in frame["tokens"]]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        union, places = np.unique(np.concatenate(sets), return_inverse=True)
        tokens = places.astype(np.int32).tobytes() if len(sets) > 1 else b""  # of one member: all in order
        n_bytes = 2 * sizes.nbytes + len(tokens) + union.nbytes
        return pd.DataFrame({"group": [frame["group"].iloc[0]], "nodes": [frame["node"].to_numpy(np.int64).tobytes()], "sizes": [sizes.tobytes()], "tokens": [tokens], "union": [union.tobytes()], "bytes": [n_bytes]})

    return durable(tokens.join(groups, "node").groupBy("group").applyInPandas(stored, "group long, nodes binary, sizes binary, tokens binary, union binary, bytes long"))


class Group:
    def __init__(self, nodes: bytes, sizes: bytes, tokens: bytes, union: bytes) -> None:
        self.nodes, self.sizes = np.frombuffer(nodes, np.int64), np.frombuffer(sizes, np.int64)
        self.union = np.frombuffer(union, np.uint64)
        self.tokens = self.union[np.frombuffer(tokens, np.int32)] if tokens else self.union
        self.owner = np.repeat(np.arange(len(self.nodes)), self.sizes)

    def bounded(self, other: "Group", percent: int) -> np.ndarray:
        """Members whose overlap with the other group's union still allows a link."""
        at = np.minimum(np.searchsorted(other.union, self.tokens), len(other.union) - 1)
        overlap = np.bincount(self.owner, other.union[at] == self.tokens, minlength=len(self.nodes))
        fits = (100 * self.sizes >= percent * other.sizes.min()) & (percent * self.sizes <= 100 * other.sizes.max())
        return np.flatnonzero(fits & (100 * overlap >= percent * self.sizes))


def linked(a: Group, b: Group, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of two groups (or within one)."""
    left, right = a.bounded(b, percent), b.bounded(a, percent)
    if not len(left) or not len(right):
        return []
    wanted_a, wanted_b = np.isin(a.owner, left), np.isin(b.owner, right)
    common = np.intersect1d(np.unique(a.tokens[wanted_a]), np.unique(b.tokens[wanted_b]), assume_unique=True)
    edges: list[tuple[int, int]] = []
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    inter = np.zeros((len(left), len(right)), dtype=np.float64)
    for start in range(0, len(common), 4096):  # slices of the shared shingles bound the matrices
        part = common[start : start + 4096]
        inter += presence(a, left, wanted_a, part) @ presence(b, right, wanted_b, part).T
    size_a, size_b = a.sizes[left][:, None], b.sizes[right][None, :]
    hit = 100 * inter >= percent * (size_a + size_b - inter)
    for i, j in zip(*np.nonzero(hit)):
        x, y = int(a.nodes[left[i]]), int(b.nodes[right[j]])
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            edges.append((x, y))
    return edges


def presence(group: Group, members: np.ndarray, wanted: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    held, owner = group.tokens[wanted], group.owner[wanted]
    at = np.searchsorted(tokens, held)
    inside = at < len(tokens)
    inside[inside] = tokens[at[inside]] == held[inside]
    out = np.zeros((len(members), len(tokens)), dtype=np.float32)
    out[np.searchsorted(members, owner[inside]), at[inside]] = 1
    return out


def pairs_of(members: DataFrame, groups: DataFrame, rows: DataFrame) -> DataFrame:
    """group, other, bytes: the groups that meet, each pair once, those with themselves too, and the bytes of both."""
    held = members.where("meets").join(groups, "node").select("signature", "group").distinct()
    other = held.select("signature", F.col("group").alias("other"))
    apart = held.join(other, "signature").where(F.col("group") < F.col("other")).select("group", "other").distinct()
    pairs = apart.unionByName(rows.where(F.length("nodes") > 8).select("group", F.col("group").alias("other")))
    sizes = rows.select("group", "bytes")
    there = sizes.select(F.col("group").alias("other"), F.col("bytes").alias("there"))
    return durable(pairs.join(sizes, "group").join(there, "other").select("group", "other", (F.col("bytes") + F.col("there")).alias("bytes")))


def links(members: DataFrame, groups: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """a, b: links that join up all nodes linked directly or through others."""
    pairs = pairs_of(members, groups, rows)
    whole, carried = [df.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0] for df in (rows, pairs)]
    rounds = max(1, -(-carried // max(1, CARRIED * whole)))
    fields = ["nodes", "sizes", "tokens", "union"]
    first = rows.select("group", *[F.col(f).alias(f"a_{f}") for f in fields])
    second = rows.select(F.col("group").alias("other"), *[F.col(f).alias(f"b_{f}") for f in fields])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in batch.to_pylist():
                found += linked(Group(*[row[f"a_{f}"] for f in fields]), Group(*[row[f"b_{f}"] for f in fields]), percent)
            yield pa.RecordBatch.from_pydict({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    found = []
    for k in range(rounds):
        chosen = pairs.where(F.pmod(F.xxhash64("group", "other"), F.lit(rounds)) == k).drop("bytes")
        met = chosen.join(first, "group").join(second, "other")
        found.append(durable(met.drop("group", "other").mapInArrow(verify, "a long, b long")))
    discard(pairs)
    return reduce(DataFrame.unionByName, found)


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of all nodes in ``edges``."""
    both = durable(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        stepped = labels.join(near, labels["node"] == near["a"]).select("node", F.least("component", "near").alias("component"), F.col("component").alias("before"))
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("far"))
        following = durable(stepped.join(jump, stepped["component"] == jump["at"]).select("node", F.least("component", "far").alias("component"), "before"))
        done = following.where(F.col("component") != F.col("before")).isEmpty()
        labels = following.select("node", "component")
        if done:
            return labels


def labelled(documents: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets, and of, smallest (id and text_key) for every node: the first document of its component."""
    signed = durable(signed_sets(documents, width, percent))
    members = memberships(signed)
    sets = durable(signed.select("id", "text_key", "n_shingles", "node"))
    discard(signed)
    groups = groups_of(members, sets)
    ids = sets.join(groups, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")).select("id").distinct()
    rows = group_rows(sets_again(documents, durable(ids), width), groups)
    edges = links(members, groups, rows, percent)
    for step in (members, groups, rows):
        discard(step)
    found = components(edges)
    nodes = sets.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct("id", "text_key")).alias("first"))
    named = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    return sets, durable(named.join(smallest, "component").select(F.col("node").alias("of"), "smallest"))


def joined(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every document."""
    sets, named = labelled(documents, width, percent)
    out = sets.select("id", "n_shingles", "node").join(named, F.col("node") == F.col("of"), "left")
    component = F.coalesce(F.col("smallest")["id"], F.col("id"))
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_shingles", F.when(component != NO_ID, component).alias("component_id"))


def first_of_each(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id (of rows that are equal in
    id and text, one). Documents without shingles stay."""
    sets, named = labelled(documents, width, percent)
    alone = sets.where(F.col("node").isNull()).select("id", "text_key")
    stay = durable(named.select("smallest.id", "smallest.text_key").unionByName(alone).groupBy("id", "text_key").agg(F.count("*").alias("n")))
    repeated = sets.where(F.col("node").isNotNull()).groupBy("id", "text_key").agg(F.count("*").alias("n")).where("n > 1").join(stay, ["id", "text_key"], "left_semi")
    keyed = documents.select(F.struct("*").alias("document"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_key"))
    kept = keyed.join(stay.select("id", "text_key"), ["id", "text_key"], "left_semi")
    if not repeated.isEmpty():
        again = durable(repeated.select("id", "text_key"))
        kept = kept.join(again, ["id", "text_key"], "left_anti").unionByName(kept.join(again, ["id", "text_key"], "left_semi").dropDuplicates(["id", "text_key"]))
    return kept.select("document.*")

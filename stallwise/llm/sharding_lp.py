"""Sharding by balanced label propagation.

Documents that share a link value (the same text, host, conversation ...) are linked. Every linked document starts in a shard
by hash. In each round links tell how many of their documents each shard holds; a document wants the shard with most of its
neighbours, and moves there if that is more than it has now and the quotas allow: two shards exchange as many as
ask in both directions, and what is left goes in cycles of shards and to free places. Where fewer can go than ask, those
with the largest gain do. So groups gather in one shard and the number of linked pairs in different shards falls, until
several rounds in a row bring nothing together any more. Documents without links then fill every shard to its exact size:
counts differ by one at most.

Scale. All is done by joins and sums over narrow rows of linked documents; texts are read once for their size and
digests. A link with a third of all rows is counted map-side first and its join is split; no pairs are formed. Numbers within
shards come from ``gapless``. The driver sees one row per pair of shards and round. A round's shards are stored before the next, and
those of the round before deleted.

Defined cases. A null text has size 1 and the checksum of nothing, and no link; an empty text is a text. Repeated rows are
linked like other equal texts, null ids are kept. Ties between shards are broken by a hash of link, shard and round, the same
for all documents of a link, so that two halves of a group do not change places. Texts of any length are read whole and go no
further than their digest. Groups larger than a quota are split, with
as many as fit in the shard that has most of them. Other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stallwise.llm.common import gapless
from stallwise.session import discard, durable

IDLE = 4  # rounds without a gain after which propagation ends
LINKS, NODES = 256, 64  # requests of equal gain are graded by a hash of the link, so that groups go as one, then of the document


def text_nodes(documents: DataFrame) -> DataFrame:
    """node, doc_id, size, text_crc32, link (digest of the text, null without text), stored."""
    text = F.col("text").cast("string")
    bytes_of = F.coalesce(text, F.lit("")).cast("binary")
    return durable(documents.select(
        F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(bytes_of) + 1).cast("long").alias("size"), F.crc32(bytes_of).alias("text_crc32"),
        F.when(text.isNotNull(), F.unhex(F.sha2(bytes_of, 256))).alias("link"),
    ))


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def by_shard(values: list, otherwise, shard: str) -> Column:
    """The value of a short list at the column ``shard``."""
    out = F.lit(otherwise)
    for k, value in enumerate(values):
        out = F.when(F.col(shard) == k, F.lit(value)).otherwise(out)
    return out


def requests(state: DataFrame, counts: DataFrame, offered: list[int], shards: int, turn: int) -> DataFrame:
    """node, shard, to, grade of every linked document that would move; lower grades go first."""
    votes = state.join(counts, "link").groupBy("node", "shard").agg(
        F.min(F.xxhash64("link")).alias("seed"), *[F.sum(F.col("held")[k]).alias(f"v{k}") for k in range(shards)]
    )
    # of equal votes the shard that a hash of link and round puts first: one for all documents of a link, so that halves of
    # a group meet, and any other for the next link, so that requests of equal votes go both ways between two shards
    offers = [F.struct(F.col(f"v{k}").alias("votes"), F.xxhash64("seed", F.lit(turn), F.lit(k)).alias("first"), F.lit(k).alias("shard")) for k in range(shards)]
    asked = votes.select("node", "shard", "seed", F.array_max(F.array(*[offers[k] for k in offered])).alias("best"), F.array(*offers)[F.col("shard")].alias("own"))
    gain = F.floor(F.log2(F.col("best.votes") - F.col("own.votes") + 1))
    grade = ((63 - gain) * LINKS + F.pmod(F.xxhash64("seed", F.lit(turn)), F.lit(LINKS))) * NODES + F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(NODES))
    return asked.where(F.col("best") > F.col("own")).select("node", "shard", F.col("best.shard").alias("to"), grade.alias("grade"))


def closed_walk(left: dict[int, dict[int, int]]) -> list[tuple[int, int]] | None:
    """Edges of a cycle among those with something left, or None."""
    done: set[int] = set()

    def walk(a: int, path: list[int]) -> list[int] | None:
        if a in path:
            return path[path.index(a):] + [a]
        if a in done:
            return None
        for b in sorted(left.get(a, {})):
            if left[a][b] and (found := walk(b, path + [a])):
                return found
        done.add(a)
        return None

    for start in sorted(left):
        if found := walk(start, []):
            return list(zip(found, found[1:]))
    return None


def allowances(asked: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """Moves per (shard, to). Two shards exchange as many as ask in both directions; what is left is met along cycles of
    requests, with the free places as a station that any shard's requests may start from. No shard gets more than it gives
    and its free places."""
    granted: dict[tuple[int, int], int] = {}
    left: dict[int, dict[int, int]] = {}
    for (a, b), n in asked.items():
        even = min(n, asked.get((b, a), 0))
        granted[a, b] = even
        left.setdefault(a, {})[b] = n - even
    outside = len(free)
    left[outside] = {a: sum(free) for a in range(outside)}
    for b, n in enumerate(free):
        left.setdefault(b, {})[outside] = n
    while cycle := closed_walk(left):
        least = min(left[a][b] for a, b in cycle)
        for a, b in cycle:
            left[a][b] -= least
            if outside not in (a, b):
                granted[a, b] += least
    return {way: n for way, n in granted.items() if n}


def counted(state: DataFrame, shards: int) -> tuple[DataFrame, Decimal]:
    """Documents of every link in each shard (link, held), stored, and the sum of their squares, which grows as the cut falls."""
    held = F.array(*[F.sum((F.col("shard") == k).cast("long")) for k in range(shards)])
    counts = durable(state.groupBy("link").agg(held.alias("held")))
    one = F.explode("held").alias("n")
    squares = counts.select(one).select(F.col("n").cast("decimal(18,0)").alias("n")).agg(F.sum(F.col("n") * F.col("n")))
    return counts, squares.first()[0] or Decimal(0)


def propagated(links: DataFrame, quota: list[int], rounds: int | None = None) -> DataFrame:
    """node, shard of every document in ``links`` (node, link), stored; each link value should be on two rows or more.

    Rounds go on until ``IDLE`` of them in a row bring nothing together, or to ``rounds``.
    """
    shards = len(quota)
    state = durable(links.select("node", "link", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")))
    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count_distinct("node").alias("n")).collect()}
    counts, most = counted(state, shards)
    turn = idle = 0
    while idle < IDLE and turn != rounds:
        free = [max(0, quota[k] - held.get(k, 0)) for k in range(shards)]
        # every other round only shards with places are asked for, so that a group whose shard is full finds the next
        offered = [k for k in range(shards) if turn % 2 and free[k]] or list(range(shards))
        moves = durable(requests(state, counts, offered, shards, turn))
        # at most one row per pair of shards reaches the driver, here and below
        wanted = {(r["shard"], r["to"]): r["n"] for r in moves.groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}
        allowed = allowances(wanted, free)
        idle += 1
        turn += 1
        if allowed:
            limit = by_shard([allowed.get((a, b), 0) for a in range(shards) for b in range(shards)], 0, "way")
            upto = F.sum("n").over(Window.partitionBy("way").orderBy("grade"))
            ways = moves.withColumn("way", F.col("shard") * shards + F.col("to"))
            graded = ways.groupBy("way", "grade").agg(F.count("*").alias("n")).withColumn("upto", upto)
            granted = graded.where(F.col("upto") <= limit).groupBy("way").agg(F.max("grade").alias("last"), F.sum("n").alias("n")).collect()
            last = {r["way"]: r["last"] for r in granted}
            for r in granted:
                held[r["way"] // shards] -= r["n"]
                held[r["way"] % shards] = held.get(r["way"] % shards, 0) + r["n"]
            going = ways.where(F.col("grade") <= by_shard([last.get(way, -1) for way in range(shards * shards)], -1, "way"))
            if last:
                used = [state, counts]
                state = durable(
                    state.join(going.select("node", "to"), "node", "left")
                    .select("node", "link", F.coalesce("to", "shard").alias("shard"))
                )
                counts, now = counted(state, shards)
                for step in used:
                    discard(step)
                if now > most:
                    most, idle = now, 0
        discard(moves)
    discard(counts)
    return durable(state.select("node", "shard").distinct())


def sharded(nodes: DataFrame, shards: int = 8, rounds: int | None = None) -> DataFrame:
    """The nodes with shard (int) and slot (gapless from 0 in each shard).

    ``nodes``: a stored table with a unique ``node`` and a ``link`` that documents may share.
    """
    quota = quotas(nodes.count(), shards)
    shared = nodes.where(F.col("link").isNotNull()).groupBy("link").agg(F.count("*").alias("n")).where("n > 1")
    links = durable(nodes.select("node", "link").join(shared.select("link"), "link", "left_semi"))
    linked = durable(gapless(propagated(links, quota, rounds), "shard", [F.col("node")], "slot"))
    held = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # a hash start can overfill a shard when nearly all documents are linked: what lies beyond the quota moves on
    stays = linked.where(F.col("slot") < by_shard(quota, 0, "shard"))
    kept = [min(quota[k], held.get(k, 0)) for k in range(shards)]
    rest = durable(nodes.join(stays.select("node"), "node", "left_anti").withColumn("all", F.lit(0)))
    numbered = gapless(rest, "all", [F.col("node")], "at", few_groups=True)
    starts = [sum(quota[j] - kept[j] for j in range(k)) for k in range(shards)]
    shard = F.lit(shards - 1)
    for k in reversed(range(shards - 1)):
        shard = F.when(F.col("at") < starts[k + 1], F.lit(k)).otherwise(shard)
    filled = numbered.withColumn("shard", shard).withColumn("slot", F.col("at") - by_shard(starts, 0, "shard") + by_shard(kept, 0, "shard"))
    columns = [*nodes.columns, "shard", "slot"]
    return nodes.join(stays, "node").select(*columns).unionByName(filled.select(*columns))


def cut_pairs(assigned: DataFrame) -> DataFrame:
    """linked, cut: pairs of documents that share a link, and those in different shards, counted without forming pairs."""
    pairs = F.col("n") * (F.col("n") - 1) / 2
    inside = assigned.where(F.col("link").isNotNull()).groupBy("link", "shard").agg(F.count("*").alias("n")).groupBy("link").agg(F.sum("n").alias("all"), F.sum(pairs).alias("inside"))
    total = F.coalesce(F.sum(F.col("all") * (F.col("all") - 1) / 2), F.lit(0.0))
    return inside.agg(total.alias("linked"), (total - F.coalesce(F.sum("inside"), F.lit(0.0))).alias("cut"))

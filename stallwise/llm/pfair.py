"""Mixing sources to target weights by Pfair scheduling.

Documents of a source are dealt into blocks. With a share w of the output, block i of a source (from 0) is released at
slot floor(i / w) and due at slot ceil((i + 1) / w); each slot goes to the released block that is due first. These windows
can always be met on one output sequence, so after t slots a source has placed less than one block more or less than w t.

Scale. Weights are whole parts. With Q parts in all, every source has placed exactly its parts after Q slots, so the
order repeats: it is worked out once for Q slots on the driver, and the place of any block follows by arithmetic
from its number, in a join with that small table. Documents get their number within the source by ``gapless``, which
never brings a source together. The driver holds one count per source and at most ``parts`` slots for every phase.

When a source has no blocks left, the others go on with their weights among themselves: a new phase with its own
repeating order, in which the bound holds again. A phase is a whole number of repetitions; in its last one the ended
source leaves slots empty, and these are closed up. No document is dropped or repeated.

Defined cases. A null source is a source. Sources without a weight get one part. Empty texts are documents like any
other; texts are not read. Documents are put in order of a hash within their source. The last block of a source may be
short. An empty table gives an empty result. The added columns replace columns of the same name.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.common import gapless

PARTS = 1000
BLOCK_DOCS = 64
ADDED = ["block", "phase", "release", "deadline", "slot", "position"]


def windows(parts: int, total: int) -> list[tuple[int, int]]:
    """Release and deadline of each of a source's ``parts`` blocks within ``total`` slots."""
    return [(i * total // parts, -(-(i + 1) * total // parts)) for i in range(parts)]


def repeating_order(parts: list[int]) -> list[tuple[int, int]]:
    """(source, block) for each of sum(parts) slots: the earliest deadline among released blocks, ties in source order."""
    total = sum(parts)
    spans = [windows(p, total) for p in parts]
    waiting = [(spans[s][0][0], s, 0) for s in range(len(parts))]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    order = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (spans[s][i][1], s, i))
        _, s, i = heapq.heappop(ready)
        order.append((s, i))
        if i + 1 < parts[s]:
            heapq.heappush(waiting, (spans[s][i + 1][0], s, i + 1))
    return order


def apportioned(wanted: list[float], parts: int = PARTS) -> list[int]:
    """Whole parts in the ratio of ``wanted`` (largest remainders first), at least one each."""
    total = sum(wanted) or 1.0
    exact = [w * parts / total for w in wanted]
    found = [max(1, math.floor(x)) for x in exact]
    rest = sorted(range(len(exact)), key=lambda s: (math.floor(exact[s]) - exact[s], s))
    for s in rest[: max(0, parts - sum(found))]:
        found[s] += 1
    return found


def schedule(blocks: list[int], parts: list[int]) -> tuple[list[tuple], list[tuple]]:
    """Phases and slots for sources with that many blocks and parts.

    A phase row: phase, source, first block, blocks, first slot, slots of a repetition, repetitions. A slot row: phase,
    source, block within the repetition, its place, its place in the last repetition, release and deadline.
    """
    phases, slots = [], []
    left, start = list(blocks), 0
    phase = 0
    while active := [s for s in range(len(blocks)) if left[s] > 0]:
        divisor = math.gcd(*[parts[s] for s in active])
        own = [parts[s] // divisor for s in active]
        total, times = sum(own), min(-(-left[s] // q) for s, q in zip(active, own))
        order = repeating_order(own)
        spans = [windows(q, total) for q in own]
        last, place_in_last = {}, 0
        for a, i in order:
            last[a, i] = place_in_last
            place_in_last += (times - 1) * own[a] + i < left[active[a]]
        for place, (a, i) in enumerate(order):
            slots.append((phase, active[a], i, place, last[a, i], *spans[a][i]))
        for a, s in enumerate(active):
            taken = min(left[s], times * own[a])
            phases.append((phase, s, blocks[s] - left[s], taken, start, total, times, own[a]))
            left[s] -= taken
        start += (times - 1) * total + place_in_last
        phase += 1
    return phases, slots


def mixed(documents: DataFrame, weights: dict[str | None, int] | None = None, parts: int = PARTS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The documents with block (number within the source), phase, release and deadline (slots of the phase), slot
    (place of the block in the output) and position (place of the document, gapless from 0).

    ``weights``: whole parts per source, few in number. None: parts in the ratio of the square roots of the sizes.
    """
    spark = documents.sparkSession
    sizes = [(r["source"], r["n"]) for r in documents.groupBy("source").agg(F.count("*").alias("n")).collect()]  # one row per source
    sizes.sort(key=lambda x: (x[0] is None, str(x[0])))
    counts = [n for _, n in sizes]
    shares = apportioned([math.sqrt(n) for n in counts], parts) if weights is None else [weights.get(s, 1) for s, _ in sizes]
    blocks = [-(-n // block_docs) for n in counts]
    phases, slots = schedule(blocks, shares)
    kind = dict(documents.dtypes)["source"]
    numbers = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(sizes)], f"s int, name {kind}")
    spans = spark.createDataFrame(phases, "phase int, s int, first long, held long, start long, total long, times long, own long")
    places = spark.createDataFrame(slots, "phase int, s int, i long, place long, last long, release long, deadline long")
    # the document is packed, so its columns cannot clash with those of the computation
    rest = [c for c in documents.columns if c not in ADDED]
    tie = F.xxhash64("text") if "text" in documents.columns else F.lit(0)
    packed = documents.select(F.struct(*rest).alias("document"), F.col("source"), F.col("doc_id"), tie.alias("tie"))
    numbered = gapless(packed, "source", [F.col("doc_id"), F.col("tie")], "n", few_groups=True)
    # at most one row per source, per source and phase, and per slot and phase
    joined = (
        numbered.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("block", F.floor(F.col("n") / block_docs))
        .join(F.broadcast(spans), "s").where((F.col("block") >= F.col("first")) & (F.col("block") < F.col("first") + F.col("held")))
        .withColumn("round", F.floor((F.col("block") - F.col("first")) / F.col("own")))
        .withColumn("i", (F.col("block") - F.col("first")) % F.col("own"))
        .join(F.broadcast(places), ["phase", "s", "i"])
    )
    whole = F.when(F.col("round") == F.col("times") - 1, F.col("last")).otherwise(F.col("place"))
    offset = F.col("round") * F.col("total")
    slotted = joined.withColumns({"slot": F.col("start") + offset + whole, "release": offset + F.col("release"), "deadline": offset + F.col("deadline")})
    position = F.col("slot") * block_docs + F.col("n") % block_docs
    for slot, short in short_blocks(counts, phases, slots, block_docs):  # one per source at most
        position = position - F.when(F.col("slot") > slot, F.lit(short)).otherwise(F.lit(0))
    return slotted.withColumn("position", position).select("document.*", *ADDED)


def short_blocks(counts: list[int], phases: list[tuple], slots: list[tuple], block_docs: int) -> list[tuple[int, int]]:
    """Slot of each source's last block and the number of documents it lacks, where it lacks any."""
    place = {row[:3]: row[3:5] for row in slots}
    found = []
    for phase, s, first, count, start, total, times, own in phases:
        last_block = -(-counts[s] // block_docs) - 1
        short = (last_block + 1) * block_docs - counts[s]
        if short and first <= last_block < first + count:
            turn, i = divmod(last_block - first, own)
            found.append((start + turn * total + place[phase, s, i][turn == times - 1], short))
    return found


def in_order(documents: DataFrame, places: bool = False, **settings) -> DataFrame:
    """The documents, all columns, sorted into the mixed order (files in order, rows in order within them).

    With ``places`` their ``slot`` and ``position`` go along, in place of columns of these names, since files and rows may be
    read again in any order.
    """
    rest = [c for c in documents.columns if not (places and c.lower() in ("slot", "position"))]
    packed = documents.select(F.struct(*rest).alias("whole"), "doc_id", "source", F.xxhash64("text").alias("text"))
    placed = mixed(packed, **settings)
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("whole.*", *(["slot", "position"] if places else []))

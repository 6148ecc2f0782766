"""Least-cost repair of conversations by weighted interval parsing.

The wanted order of roles is a regular language, ``(system? (user assistant)+)?``, with the states

    0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.

A repair grammar has a symbol [p q] for every pair of states: "these rows, edited, lead from p to q". Its rules are in
Chomsky normal form: [p q] -> [p r] [r q] for every r, and [p q] -> row, closed under insertions: a row may be preceded by
inserted rows, then be kept (cost 0), given another role (3) or deleted (4; the only edit for blank and repeated rows); kept
or re-roled rows without a final stop cost 3 more, an inserted row costs 3. A cell holds the least (cost, audit) of a
symbol over a span, where the audit spells the edits K, R, D, I in order. Two audits of a symbol with equal cost are never
prefixes of each other (the longer one would have inserts more, which cost), so the least of a concatenation is the
concatenation of the leasts and cells may be combined in any bracketing: every split of a span gives the same
cell. Spans are therefore combined bottom-up by length, each with the neighbour of its own length, in place of all splits.

Scale. Rows are sorted into range slices by (conversation, turn), so a conversation with a third of all rows lies in
many slices. A slice is parsed as it streams by, with at most one open span per power of two; it leaves one fragment
per conversation in it, and fragments of a conversation are combined in their order. Repeats are found from one row per
distinct (conversation, role, text) digest, joined back. Texts are shuffled only to the slices, and once more where repaired
rows are asked for. The audit of a conversation, a letter per edit, is the largest thing a task holds of it.

Defined cases. A null role or text is one space; null turns come first; rows of equal turn are in order of a digest of
role and text, so equal rows are adjacent. A null conversation id is a conversation. Conversations all of whose rows
are marked ``gone`` are in the result with zeros and an empty audit. Other columns are ignored. Texts may be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.common import SPACE, portions
from stallwise.session import discard, durable

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}  # the role that may be inserted or given in a state
ENDS = (0, 3)
LEGAL = frozenset({"su", "ua", "au"})
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
Cells = dict[tuple[int, int], tuple[int, str]]
LONGEST = 2**63 - 1


def least(cells: Cells, symbol: tuple[int, int], cell: tuple[int, str]) -> None:
    if symbol not in cells or cell < cells[symbol]:
        cells[symbol] = cell


def insertions() -> Cells:
    """Closure: states reached by inserted rows alone; a state never pays to come back to itself."""
    cells: Cells = {}
    for p in range(4):
        q, cell = p, (0, "")
        while (p, q) not in cells:
            cells[p, q] = cell
            q, cell = STEP[q, WANTED[q]], (cell[0] + INSERT, cell[1] + "I")
    return cells


CLOSURE = insertions()


def leaf(initial: str, fault: int) -> Cells:
    """Cells of one row."""
    cells: Cells = {}
    more = UNFINISHED if fault == TRUNCATED else 0
    for (p, q), (cost, audit) in CLOSURE.items():
        least(cells, (p, q), (cost + DELETE, audit + "D"))
        if fault not in (BLANK, DUPLICATE):
            if (q, initial) in STEP:
                least(cells, (p, STEP[q, initial]), (cost + KEEP + more, audit + "K"))
            least(cells, (p, STEP[q, WANTED[q]]), (cost + REROLE + more, audit + "R"))
    return cells


LEAVES = {(initial, fault): leaf(initial, fault) for initial in ("s", "u", "a", "") for fault in range(4)}


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its parts."""
    ahead: dict[int, list] = {}
    for (r, q), (cost, audit) in right.items():
        ahead.setdefault(r, []).append((q, cost, audit))
    cells: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q, more, rest in ahead.get(r, ()):
            total, known = cost + more, cells.get((p, q))
            if known is None or total < known[0] or total == known[0] and audit + rest < known[1]:
                cells[p, q] = (total, audit + rest)
    return cells


@dataclass
class Parse:
    """Spans of a conversation so far, each longer than the next one, and what else is counted along the rows."""

    spans: list[tuple[int, Cells]] = field(default_factory=list)
    rows: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    least_turn: int | None = None
    most_turn: int | None = None
    turns: int = 0

    def push(self, length: int, cells: Cells) -> None:
        self.spans.append((length, cells))
        while len(self.spans) > 1 and self.spans[-2][0] <= self.spans[-1][0]:
            self.shorten()

    def shorten(self) -> None:
        (m, right), (n, left) = self.spans.pop(), self.spans.pop()
        self.spans.append((n + m, joined(left, right)))

    def row(self, initial: str, fault: int, turn: int | None) -> None:
        self.push(1, LEAVES[initial if initial in ("s", "u", "a") else "", fault])
        self.meet(1, [fault == f for f in range(4)], 0, initial, initial, turn, turn, turn is not None)

    def meet(self, rows, faults, illegal, first, last, least_turn, most_turn, turns) -> None:
        """Adds counts of the rows that follow."""
        if self.rows and rows:
            self.illegal += self.last + first not in LEGAL
        if rows:
            self.first, self.last = first if self.rows == 0 else self.first, last
        self.rows += rows
        self.faults = [a + int(b) for a, b in zip(self.faults, faults)]
        self.illegal += illegal
        if least_turn is not None:
            self.turns += int(turns) - (self.most_turn == least_turn)
            self.least_turn, self.most_turn = least_turn if self.least_turn is None else self.least_turn, most_turn

    def cells(self) -> Cells:
        while len(self.spans) > 1:
            self.shorten()
        return self.spans[0][1] if self.spans else {}

    def verdict(self) -> tuple[int, str]:
        """Least (cost, audit) of the whole conversation, closed by insertions at its end."""
        if not self.rows:
            return 0, ""
        ended = joined(self.cells(), CLOSURE)
        return min(ended[0, q] for q in ENDS if (0, q) in ended)

    def gaps(self) -> int:
        return 0 if self.least_turn is None else min(LONGEST, self.most_turn - self.least_turn + 1 - self.turns)


def prepared(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, gone, digest, place: a stored table in range slices; ``place`` numbers the rows in order."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    named = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (F.lit(False) if gone is None else gone).alias("gone"), F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"))
    # rows that are equal in everything are told apart by a number, so that any number of them spreads over slices
    stored = durable(named.withColumn("number", F.monotonically_increasing_id()))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("digest"), F.asc("number")]
    sliced = stored.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = durable(sliced.drop("number").withColumn("place", F.monotonically_increasing_id()))
    discard(stored)
    return ordered


def slice_of(place: str = "place") -> Column:
    """The slice of a row: the partition number is in the upper bits of its place."""
    return F.shiftright(place, 33)


def judged(ordered: DataFrame) -> DataFrame:
    """conv_id, place, turn, gone, initial, fault: the first fault of every row that is not gone."""
    blank = F.regexp_replace("text", f"{SPACE}+", "") == ""
    final = F.substring(F.regexp_replace("text", f"{SPACE}+$", ""), -1, 1)
    light = ordered.select(
        "conv_id", "place", "turn", "gone", F.substring("role", 1, 1).alias("initial"),
        F.when(blank, BLANK).when(~final.isin(".", "!", "?"), TRUNCATED).otherwise(NONE).alias("own"), "digest")
    first = light.where(~F.col("gone") & (F.col("own") != BLANK)).groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count("*").alias("copies"))
    first = first.where("copies > 1").select(F.col("conv_id").alias("f_conv_id"), F.col("digest").alias("f_digest"), "first")
    marked = light.join(first, light["conv_id"].eqNullSafe(F.col("f_conv_id")) & (light["digest"] == F.col("f_digest")), "left")
    repeated = (F.col("own") != BLANK) & (F.col("place") > F.col("first"))
    return marked.select("conv_id", "place", "turn", "gone", "initial", F.when(repeated, DUPLICATE).otherwise(F.col("own")).alias("fault"))


FRAGMENT = pa.schema([
    ("conv_id", pa.int64()), ("slice", pa.int64()), ("rows", pa.int64()), ("faults", pa.list_(pa.int64())), ("illegal", pa.int64()), ("first", pa.string()),
    ("last", pa.string()), ("least_turn", pa.int64()), ("most_turn", pa.int64()), ("turns", pa.int64()), ("symbols", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
FRAGMENT_SQL = ("conv_id long, slice long, rows long, faults array<long>, illegal long, first string, last string, least_turn long, most_turn long, "
                "turns long, symbols array<int>, costs array<long>, audits array<string>")


def fragments(marked: DataFrame) -> DataFrame:
    """One row per slice and conversation in it: counts and cells of its rows there."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, made = None, None, []

        def finish() -> None:
            cells = now.cells()
            made.append((key[1], key[0], now.rows, now.faults, now.illegal, now.first, now.last, now.least_turn, now.most_turn, now.turns,
                         [4 * p + q for p, q in cells], [c for c, _ in cells.values()], [a for _, a in cells.values()]))

        for batch in batches:
            for at, conv, gone, initial, fault, turn in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if key != (at, conv):
                    if now is not None:
                        finish()
                    key, now = (at, conv), Parse()
                if not gone:
                    now.row(initial, fault, turn)
            if made:
                yield table(made)
                made = []
        if now is not None:
            finish()
            yield table(made)

    def table(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], f.type) for i, f in enumerate(FRAGMENT)], schema=FRAGMENT)

    together = marked.withColumn("slice", slice_of()).repartition("slice").sortWithinPartitions("slice", "place")
    return together.select("slice", "conv_id", "gone", "initial", "fault", "turn").mapInArrow(parse, FRAGMENT_SQL)


VERDICT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def verdicts(parts: DataFrame, by_slice: bool = False) -> DataFrame:
    """One row per conversation: counts, least cost and audit. With ``by_slice`` one row per fragment with its part of the audit
    (``audit``) and the state in which it begins (``state``), for rewriting the rows."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, counts, made = None, None, [], []

        def finish() -> None:
            cost, audit = now.verdict()
            if not by_slice:
                made.append((key[0], now.gaps(), now.faults[BLANK], now.faults[DUPLICATE], now.faults[TRUNCATED], now.illegal, cost, audit))
                return
            at = state = 0
            for number, (piece, rows, cells) in enumerate(counts):
                begin, before = at, state
                while rows:
                    rows -= audit[at] != "I"
                    at += 1
                # the edits of a fragment and the state before it tell the state after it
                state = next((q for (p, q), cell in cells.items() if p == before and cell[1] == audit[begin:at]), before)
                if number == len(counts) - 1:
                    at = len(audit)
                made.append((key[0], piece, before, audit[begin:at]))

        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["conv_id"],):
                    if now is not None:
                        finish()
                    key, now, counts = (row["conv_id"],), Parse(), []
                cells = {divmod(s, 4): (c, a) for s, c, a in zip(row["symbols"], row["costs"], row["audits"])}
                if row["rows"]:
                    now.push(row["rows"], cells)
                now.meet(*[row[name] for name in ("rows", "faults", "illegal", "first", "last", "least_turn", "most_turn", "turns")])
                if by_slice:
                    counts.append((row["slice"], row["rows"], cells))
            if made:
                yield table(made)
                made = []
        if now is not None:
            finish()
            yield table(made)

    kinds = [pa.int64()] * 3 + [pa.string()] if by_slice else [pa.int64()] * 7 + [pa.string()]
    names = ["conv_id", "slice", "state", "audit"] if by_slice else ["conv_id", *[v.split()[0] for v in VERDICT.split(", ")]]

    def table(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)], names=names)

    together = parts.repartition("conv_id").sortWithinPartitions("conv_id", "slice")
    return together.mapInArrow(combine, "conv_id long, slice long, state long, audit string" if by_slice else f"conv_id long, {VERDICT}")


REPAIRED = "conv_id long, place long, step int, edit string, role string, text string"


def repaired(ordered: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id, place, step, edit, role, text: the rows after repair; (place, step) orders those of a conversation.

    ``step`` is 2 for a row of the table, less for rows inserted before it, more for rows inserted at the end.
    """
    edits = verdicts(parts, by_slice=True).select(
        "slice", "conv_id", F.lit(-1).cast("long").alias("place"), F.lit(False).alias("gone"), "state", "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = ordered.select(
        slice_of().alias("slice"), "conv_id", "place", "gone", F.lit(None).cast("long").alias("state"), F.lit(None).cast("string").alias("audit"), "role", "text")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, state, audit, at = None, 0, 0, "", 0
        made: list[tuple] = []

        def insert(step: int) -> None:
            nonlocal state, at
            while at < len(audit) and audit[at] == "I":
                made.append((conv, place, step, "I", ROLE[WANTED[state]], ""))
                state, at, step = STEP[state, WANTED[state]], at + 1, step + 1

        for batch in portions(batches, 7):
            for _, row_conv, row_place, gone, row_state, row_audit, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if row_audit is not None:
                    insert(3)
                    conv, place, state, audit, at = row_conv, row_place, row_state, row_audit, 0
                    continue
                place = row_place
                if gone:
                    continue
                insert(0)
                edit, at = audit[at], at + 1
                if edit != "D":
                    initial = role[:1] if edit == "K" else WANTED[state]
                    made.append((conv, place, 2, edit, role if edit == "K" else ROLE[initial], text))
                    state = STEP[state, initial]
            if made:
                yield as_rows(made)
                made = []
        insert(3)
        if made:
            yield as_rows(made)

    def as_rows(made: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)], names=["conv_id", "place", "step", "edit", "role", "text"])

    together = rows.union(edits).repartition("slice").sortWithinPartitions("slice", F.asc_nulls_first("conv_id"), "place")
    return together.mapInArrow(rewrite, REPAIRED)


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the ``role:text`` lines of each conversation that has any.

    A digest takes its input in order, so the rows of a conversation stream through one task; no more than a batch is held.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, now, made = None, None, []
        for batch in portions(batches, 2):
            for row_conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or conv != row_conv:
                    if now is not None:
                        made.append((conv, now.hexdigest()))
                    conv, now = row_conv, hashlib.sha256()
                else:
                    now.update(b"\n")
                now.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if made:
                yield table(made)
                made = []
        if now is not None:
            made.append((conv, now.hexdigest()))
            yield table(made)

    def table(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv_id": pa.array([m[0] for m in made], pa.int64()), "repaired_sha256": pa.array([m[1] for m in made])})

    together = rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "place", "step")
    return together.select("conv_id", "role", "text").mapInArrow(digest, "conv_id long, repaired_sha256 string")


def with_digests(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """Verdict and digest of the repaired rows of every conversation."""
    ordered = prepared(rows, gone)
    parts = durable(fragments(judged(ordered)))
    found = digests(repaired(ordered, parts)).withColumnRenamed("conv_id", "d_conv_id")
    told = verdicts(parts)
    return told.join(found, told["conv_id"].eqNullSafe(F.col("d_conv_id")), "left").select(
        *told.columns, F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))

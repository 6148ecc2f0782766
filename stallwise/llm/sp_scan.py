"""SentencePiece encoding as a max-plus scan, and decoding.

A text is segmented into the pieces of a given model so that the sum of their scores is largest. Blanks are written as the
mark U+2581, one mark is put in front, and a character without a piece of its own becomes byte pieces. Equal sums are told
apart by a hash of piece and place in the word, summed like scores, so the result does not depend on how a text is cut.

Short texts fall apart at points that no piece can cross (before a run of marks, around characters that are in no longer
piece); the words between are segmented once per task while they are remembered.

Giant texts are cut into chunks anywhere. At a boundary the state is how many characters the piece across it covers of the
next chunk; a chunk becomes the matrix of best sums from each state at its start to each state at its end. In the max-plus
algebra these matrices are combined associatively: products of runs of chunks, then the states between the runs, then
those between the chunks of each run. With both its states known a chunk is traced back on its own.

Scale. Short texts need no shuffle. Of giant texts the chunks are stored once, matrices of 4 KiB a chunk are shuffled, never
texts; a run holds ``RUN`` matrices and a text at most 2^31 / (chunk * RUN) products.

Defined cases. A null text has null ids and decodes to null; an empty one has no ids. A literal U+2581 is written as bytes,
so decoding gives every text back, byte by byte, broken UTF-8 included. Ids outside the model decode to nothing.
Repeated rows are encoded alike; other columns are carried along. The model file is read on the driver only. If its
scores are ranks of merges, as in models of pairwise merging, the segmentation is the best sum, not the order of merges.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from stallwise.llm.common import portions, text_bytes
from stallwise.session import durable

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
STAND_INS = [chr(c) for c in range(0xFDD0, 0xFDF0)]  # code points that are no characters; one stands for a literal mark
GIANT, CHUNK, RUN = 65_536, 32_768, 64
WORDS_KEPT = 300_000
UNIT = 1 << 16  # scores as whole numbers
LOWEST = -(1 << 62)
UNKNOWN_PENALTY = 10
MANY_LENGTH, MANY_WORDS, TOGETHER = 48, 20_000, 2_000_000  # bounds of what is segmented together


@dataclass
class Pieces:
    """The vocabulary: (id, score) of every piece, and the bytes that each id stands for."""

    known: dict[str, tuple[int, int]]
    byte_ids: list[int]
    bytes_of: list[bytes]
    unknown: int
    longest: int
    words: str  # pattern of the parts between points that no piece crosses


def load(path: str = MODEL) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known: dict[str, tuple[int, int]] = {}
    byte_ids, bytes_of, scores = [0] * 256, [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            bytes_of.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or not piece:
            bytes_of.append(b"")
        else:
            bytes_of.append(piece.replace(MARK, " ").encode())
            score = round(model.get_score(i) * UNIT)
            known[piece] = (i, score)
            scores.append(score)
    pieces = list(known)
    usual = [s for s in scores if s > -(10**8) * UNIT] or [0]
    apart = all(MARK not in p[1:] or not p.strip(MARK) for p in pieces)
    # a line end is a point of its own if it is in no longer piece
    line = "\n" if all("\n" not in p for p in pieces if len(p) > 1) else ""
    pattern = f"{MARK}+[^{MARK}{line}]*|[^{MARK}{line}]+" + ("|\n" if line else "") if apart else r"(?s).+"
    return Pieces(known, byte_ids, bytes_of, min(usual) - UNKNOWN_PENALTY * UNIT, max(map(len, pieces), default=1), pattern)


def with_marks(text: bytes) -> tuple[str, str]:
    """The text in marks, and the character that stands for a literal mark in it."""
    plain = text.decode("utf-8", "surrogateescape")
    stand_in = STAND_INS[0]
    if MARK in plain or stand_in in plain:
        stand_in = next((c for c in STAND_INS if c not in plain), MARK)
        plain = plain.replace(MARK, stand_in)
    return MARK + plain.replace(" ", MARK), stand_in


def tree_of(known: dict[str, tuple[int, int]]) -> dict:
    """Pieces by character: each node has its branches, the id of the piece that ends there (-1: none) and its score."""
    root: dict = {}
    for piece in sorted(known, key=len):
        branches = root
        for char in piece[:-1]:
            branches = branches.setdefault(char, ({}, -1, 0))[0]
        branches[piece[-1]] = ((branches[piece[-1]][0] if piece[-1] in branches else {}), *known[piece])
    return root


class Steps:
    """The same branches as arrays: a hash table from (node, character) to the next node, for many words at once."""

    def __init__(self, known: dict[str, tuple[int, int]]) -> None:
        edges: dict[tuple[int, str], int] = {}
        ends: list[tuple[int, int]] = [(-1, 0)]
        for piece, worth in known.items():
            node = 0
            for char in piece:
                node = edges.setdefault((node, char), len(ends))
                if node == len(ends):
                    ends.append((-1, 0))
            ends[node] = worth
        self.piece, self.score = np.array([e[0] for e in ends], dtype=np.int64), np.array([e[1] for e in ends], dtype=np.int64)
        self.bits = max(4, (8 * len(edges)).bit_length())
        self.keys, self.next = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, -1, dtype=np.int64)
        wanted = np.array([(node << 21) | ord(char) for node, char in edges], dtype=np.int64)
        goals, at = np.array(list(edges.values()), dtype=np.int64), self.place(wanted)
        while len(wanted):  # linear probing: of those that want a free place the last written gets it
            free = self.keys[at] < 0
            self.keys[at[free]], self.next[at[free]] = wanted[free], goals[free]
            left = self.keys[at] != wanted
            wanted, goals, at = wanted[left], goals[left], (at[left] + 1) % len(self.keys)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def after(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next node of each, -1 where there is none."""
        keys = (node << 21) | char
        at = self.place(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.next[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.next[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out


class Segmenter:
    def __init__(self, pieces: Pieces, stand_in: str) -> None:
        self.pieces, self.stand_in = pieces, stand_in
        self.kept: dict[str, bytes] = {}
        self.worth: dict[str, tuple[int, int]] = {}
        self.tree = tree_of(pieces.known)
        self.steps: Steps | None = None

    def spelled(self, char: str) -> list[int]:
        raw = MARK.encode() if char == self.stand_in else char.encode("utf-8", "surrogateescape")
        return [self.pieces.byte_ids[b] for b in raw]

    def spread(self, text: str, start: int, begin_before: int, places) -> tuple[list[int], list[int], list[int], list[int]]:
        """Best score and tie from ``start`` to every later point by pieces that begin before ``begin_before``, and the
        last piece of each with the point before it; ``places`` has the place in its word of every character."""
        longest, size, unknown = self.pieces.longest, len(text), self.pieces.unknown
        score, ties, before, last = [LOWEST] * (size + 1), [0] * (size + 1), [-1] * (size + 1), [-1] * (size + 1)
        score[start] = 0
        for s in range(start, min(begin_before, size)):
            own = score[s]
            if own == LOWEST:
                continue
            own_tie, shift, branches, e = ties[s], places[s] * 0x85EBCA77, self.tree, s
            for char in text[s : s + longest]:
                e += 1
                node = branches.get(char)
                if node is None:
                    if e > s + 1:
                        break
                    branches, piece, worth = {}, -1, unknown
                else:
                    branches, piece, worth = node
                    if piece < 0:
                        if e > s + 1:
                            continue
                        worth = unknown
                total = own + worth
                if total >= score[e]:
                    told = own_tie + (((piece * 0x9E3779B1 + shift) & 0xFFFFFFFF) >> 12)
                    if total > score[e] or told > ties[e]:
                        score[e], ties[e], before[e], last[e] = total, told, s, piece
        return score, ties, before, last

    def trace(self, text: str, before: list[int], last: list[int], start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            if last[end] >= 0:
                out.append(last[end])
            else:
                out += reversed(self.spelled(text[before[end]]))
            end = before[end]
        return out[::-1]

    def scored(self, word: str) -> tuple[bytes, int, int]:
        """Ids as int32 bytes, score and tie of a whole word."""
        n = len(word)
        score, ties, before, last = self.spread(word, 0, n, range(n))
        return array("i", self.trace(word, before, last, 0, n)).tobytes(), score[n], ties[n]

    def word(self, word: str) -> bytes:
        found = self.kept.get(word)
        if found is None:
            found = self.kept[word] = self.scored(word)[0]
        return found

    def sums(self, words: list[str]) -> tuple[int, int]:
        """Score and tie of a row of words."""
        total, told = 0, 0
        for word in words:
            found = self.worth.get(word)
            if found is None:
                found = self.worth[word] = self.scored(word)[1:]
            total, told = total + found[0], told + found[1]
        if len(self.worth) > WORDS_KEPT:
            self.worth.clear()
        return total, told

    def learn(self, words: list[str]) -> None:
        """Segments many new words: those of one length together, by the same rule as ``word``."""
        if self.steps is None:
            self.steps = Steps(self.pieces.known)
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        for n, some in by_length.items():
            if n > MANY_LENGTH or len(some) < 8:
                continue  # left to ``word``
            for at in range(0, len(some), MANY_WORDS):
                self.learn_equal(some[at : at + MANY_WORDS], n)
        for word in words:
            self.word(word)

    def learn_equal(self, words: list[str], n: int) -> None:
        steps, count, unknown = self.steps, len(words), self.pieces.unknown
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(count, n).T.astype(np.int64)
        score, ties = np.full((n + 1, count), LOWEST, dtype=np.int64), np.zeros((n + 1, count), dtype=np.int64)
        before, last = np.zeros((n + 1, count), dtype=np.int64), np.full((n + 1, count), -1, dtype=np.int64)
        score[0] = 0
        for s in range(n):
            alive, node = np.arange(count), np.zeros(count, dtype=np.int64)
            for e in range(s + 1, min(n, s + self.pieces.longest) + 1):
                after = steps.after(node, chars[e - 1, alive])
                piece, worth = steps.piece[after], steps.score[after]
                piece[after < 0] = -1
                if e == s + 1:
                    who, piece, worth = alive, piece, np.where(piece < 0, unknown, worth)
                else:
                    ends = piece >= 0
                    who, piece, worth = alive[ends], piece[ends], worth[ends]
                total = score[s, who] + worth
                told = ties[s, who] + (((piece * 0x9E3779B1 + s * 0x85EBCA77) & 0xFFFFFFFF) >> 12)
                old = score[e, who]
                better = (total > old) | ((total == old) & (told > ties[e, who]))
                won = who[better]
                score[e, won], ties[e, won], before[e, won], last[e, won] = total[better], told[better], s, piece[better]
                on = after >= 0
                alive, node = alive[on], after[on]
                if not len(alive):
                    break
        at, everyone, found = np.full(count, n), np.arange(count), []
        while at.any():
            found.append(np.where(at > 0, last[at, everyone], -2))
            at = before[at, everyone]
        ids = np.array(found[::-1]).T
        plain = ~(ids == -1).any(axis=1)  # a character spelled in bytes is left to ``word``
        lengths = (ids[plain] >= 0).sum(axis=1)
        flat = ids[plain][ids[plain] >= 0].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(lengths)).tolist()
        begin, chosen = 0, np.flatnonzero(plain)
        for i, end in zip(chosen.tolist(), ends):
            self.kept[words[i]] = flat[begin:end]
            begin = end


class Encoder:
    """Whole texts and chunks to ids; one per task."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.parts = pieces, re.compile(pieces.words).findall
        self.spans = re.compile(pieces.words).finditer
        self.segmenters: dict[str, Segmenter] = {}

    def segmenter(self, stand_in: str) -> Segmenter:
        if stand_in not in self.segmenters:
            self.segmenters[stand_in] = Segmenter(self.pieces, stand_in)
        return self.segmenters[stand_in]

    def encode(self, text: bytes) -> bytes:
        if not text:
            return b""
        marked, stand_in = with_marks(text)
        return b"".join(map(self.segmenter(stand_in).word, self.parts(marked)))

    def encode_all(self, texts: list[bytes | None]) -> list[bytes | None]:
        """Ids of many texts; the words that are new in about ``TOGETHER`` characters are segmented together."""
        out: list[bytes | None] = []
        held: list[tuple[list[str], Segmenter] | None] = []
        size = 0
        for text in texts:
            if text is None:
                held.append(None)
            else:
                marked, stand_in = with_marks(text) if text else ("", STAND_INS[0])
                held.append((self.parts(marked), self.segmenter(stand_in)))
                size += len(marked)
            if size >= TOGETHER:
                out += self.joined(held)
                held, size = [], 0
        return out + self.joined(held)

    def joined(self, held: list[tuple[list[str], Segmenter] | None]) -> list[bytes | None]:
        for segmenter in self.segmenters.values():
            if len(segmenter.kept) > WORDS_KEPT:
                segmenter.kept.clear()
        usual = self.segmenter(STAND_INS[0])
        new = set().union(*[item[0] for item in held if item and item[1] is usual])
        usual.learn(list(new.difference(usual.kept)))
        known = usual.kept.__getitem__
        return [None if item is None else b"".join(map(known if item[1] is usual else item[1].word, item[0])) for item in held]

    def chunks(self, text: bytes, size: int) -> list[tuple[int, str, int, int, str]]:
        """(number, characters with those a piece may reach beyond the end, length, place of the start in its word, stand-in)."""
        marked, stand_in = with_marks(text)
        starts = [m.start() for m in self.spans(marked)]
        out = []
        for number, at in enumerate(range(0, len(marked), size)):
            first = int(np.searchsorted(starts, at, side="right")) - 1
            end = min(at + size, len(marked))
            out.append((number, marked[at : min(end + self.pieces.longest - 1, len(marked))], end - at, at - starts[first], stand_in))
        return out

    def inner(self, chunk: str, length: int, place: int) -> tuple[list[int], list[int], list[str]]:
        """Place in its word of every character; points of the chunk that no piece crosses and before which every
        state at the start lies; the words between them."""
        spans = [(m.start(), m.end()) for m in self.spans(chunk)]
        # the first part may go on from the chunk before
        places = [p for s, e in spans for p in (range(place, place + e) if s == 0 else range(e - s))]
        points = [s for s, _ in spans if (s > 0 or place == 0) and self.pieces.longest - 1 <= s <= length]
        return places, points, [chunk[a:b] for a, b in zip(points, points[1:])]

    def matrix(self, chunk: str, length: int, place: int, stand_in: str) -> np.ndarray:
        """Best (score, tie) from each state at the start to each state at the end."""
        n, segmenter = self.pieces.longest, self.segmenter(stand_in)
        out = np.zeros((2, n, n), dtype=np.int64)
        out[0] = LOWEST
        places, points, words = self.inner(chunk, length, place)
        ends = range(min(n, len(chunk) - length + 1))
        if not points:
            for i in range(min(n, length + 1)):
                score, ties, _, _ = segmenter.spread(chunk, i, length, places)
                for j in ends:
                    out[:, i, j] = score[length + j], ties[length + j]
            for i in range(length + 1, n):  # a piece that reaches beyond a chunk shorter than itself
                out[0, i, i - length] = 0
            return out
        between, between_tie = segmenter.sums(words)
        score, ties, _, _ = segmenter.spread(chunk, points[-1], length, places)
        front = chunk[: points[0]]
        for i in range(n):
            to_point, to_tie, _, _ = segmenter.spread(front, i, points[0], places)
            worth, told = to_point[-1] + between, to_tie[-1] + between_tie
            for j in ends:
                if to_point[-1] > LOWEST and score[length + j] > LOWEST:
                    out[:, i, j] = worth + score[length + j], told + ties[length + j]
        return out

    def traced(self, chunk: str, length: int, place: int, stand_in: str, i: int, j: int) -> bytes:
        """Ids of a chunk between its two states."""
        segmenter = self.segmenter(stand_in)
        if i > length:
            return b""
        places, points, words = self.inner(chunk, length, place)
        if not points:
            _, _, before, last = segmenter.spread(chunk, i, length, places)
            return array("i", segmenter.trace(chunk, before, last, i, length + j)).tobytes()
        front = chunk[: points[0]]
        _, _, before, last = segmenter.spread(front, i, points[0], places)
        head = segmenter.trace(front, before, last, i, points[0])
        _, _, before, last = segmenter.spread(chunk, points[-1], length, places)
        tail = segmenter.trace(chunk, before, last, points[-1], length + j)
        return array("i", head).tobytes() + b"".join(map(segmenter.word, words)) + array("i", tail).tobytes()


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two (score, tie) matrices, larger score first, then larger tie."""
    score = np.maximum(a[0][:, :, None] + b[0][None, :, :], LOWEST)
    score[(a[0] == LOWEST)[:, :, None] | (b[0] == LOWEST)[None, :, :]] = LOWEST
    best = score.max(axis=1)
    ties = np.where(score == best[:, None, :], a[1][:, :, None] + b[1][None, :, :], -1).max(axis=1)
    return np.stack([best, np.where(best == LOWEST, 0, ties)])


def boundaries(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The states at all boundaries on the best way from state ``first`` to state ``last``."""
    n = matrices[0].shape[1]
    row = np.zeros((2, 1, n), dtype=np.int64)
    row[0] = LOWEST
    row[0, 0, first] = 0
    rows = [row]
    for m in matrices[:-1]:
        rows.append(product(rows[-1], m))
    states = [last]
    for before, m in zip(reversed(rows), reversed(matrices)):
        j = states[-1]
        score, ties = before[0, 0] + m[0, :, j], before[1, 0] + m[1, :, j]
        score[(before[0, 0] == LOWEST) | (m[0, :, j] == LOWEST)] = LOWEST
        states.append(int(np.lexsort((ties, score))[-1]))
    return states[::-1]


def matrix_of(row: bytes) -> np.ndarray:
    flat = np.frombuffer(row, np.int64)
    n = round((len(flat) / 2) ** 0.5)
    return flat.reshape(2, n, n)


STATES = "row long, chunk int, i int, j int"


def states_between(matrices: DataFrame) -> DataFrame:
    """row, chunk, i, j: the states at both ends of each chunk on the best way through its text."""
    import pandas as pd

    def run_product(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        total = matrix_of(frame["matrix"].iloc[0])
        for m in frame["matrix"].iloc[1:]:
            total = product(total, matrix_of(m))
        return pd.DataFrame({"row": frame["row"].iloc[:1], "run": frame["run"].iloc[:1], "matrix": [total.tobytes()]})

    def along(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("run")
        states = boundaries([matrix_of(m) for m in frame["matrix"]], 0, 0)
        return pd.DataFrame({"row": frame["row"], "run": frame["run"], "first": states[:-1], "last": states[1:]})

    def within(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("chunk")
        states = boundaries([matrix_of(m) for m in left["matrix"]], int(right["first"].iloc[0]), int(right["last"].iloc[0]))
        return pd.DataFrame({"row": left["row"], "chunk": left["chunk"], "i": states[:-1], "j": states[1:]})

    runs = matrices.groupBy("row", "run").applyInPandas(run_product, "row long, run int, matrix binary")
    ends = runs.groupBy("row").applyInPandas(along, "row long, run int, first int, last int")
    return matrices.groupBy("row", "run").cogroup(ends.groupBy("row", "run")).applyInPandas(within, STATES)


def id_lists(rows: list[bytes | None]) -> pa.Array:
    ends = np.cumsum([0] + [len(r or b"") // 4 for r in rows]).astype(np.int32)
    flat = np.frombuffer(b"".join(r for r in rows if r), np.int32)
    nulls = pa.array([r is None for r in rows] + [False])
    offsets = pa.array([None if missing else int(e) for e, missing in zip(ends, nulls.to_pylist())], pa.int32()) if any(r is None for r in rows) else pa.array(ends)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def encoded(documents: DataFrame, pieces: Pieces, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """The documents with ``ids`` (array of int) in place of a column of that name; their rows change order.

    Texts of more than ``giant`` characters are cut into chunks of ``chunk`` characters.
    """
    documents = documents.drop("ids")
    at = documents.columns.index("text")
    long = F.coalesce(F.length("text") > giant, F.lit(False))
    schema = StructType([*documents.schema.fields]).add("ids", ArrayType(IntegerType()))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for batch in portions(batches, at):
            ids = id_lists(encoder.encode_all(text_bytes(batch.column(at))))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    small = documents.where(~long).mapInArrow(short, schema)
    giants = durable(documents.where(long).select(F.struct("*").alias("document"), F.col("text"), F.monotonically_increasing_id().alias("row")))
    if giants.isEmpty():
        return small
    return small.unionByName(giant_ids(giants, pieces, chunk).select("document.*", "ids"))


def giant_ids(giants: DataFrame, pieces: Pieces, size: int) -> DataFrame:
    fields = "row long, chunk int, run int, part string, length int, place int, stand_in string"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), text_bytes(batch.column("text"))):
                parts = encoder.chunks(text, size)
                for at in range(0, len(parts), 16):
                    some = parts[at : at + 16]
                    raw = pa.array([p[1].encode("utf-8", "surrogateescape") for p in some], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(some)), pa.array([p[0] for p in some], pa.int32()), pa.array([p[0] // RUN for p in some], pa.int32()), raw, *[pa.array([p[k] for p in some], t) for k, t in ((2, pa.int32()), (3, pa.int32()), (4, pa.string()))]],
                        names=["row", "chunk", "run", "part", "length", "place", "stand_in"],
                    )

    chunks = durable(giants.select("row", "text").mapInArrow(split, fields.replace("part string", "part binary")))

    def each(function: Callable[[Encoder, dict, str], bytes], out: str) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = Encoder(pieces)
            for batch in batches:
                rows = batch.to_pylist()
                made = [function(encoder, r, r["part"].decode("utf-8", "surrogateescape")) for r in rows]
                columns = [pa.array([r["row"] for r in rows]), pa.array([r["chunk"] for r in rows], pa.int32())]
                if out == "matrix":
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([r["run"] for r in rows], pa.int32()), pa.array(made, pa.binary())], names=["row", "chunk", "run", "matrix"])
                else:
                    yield pa.RecordBatch.from_arrays([*columns, id_lists(made)], names=["row", "chunk", "ids"])

        return run

    matrices = durable(chunks.mapInArrow(each(lambda e, r, part: e.matrix(part, r["length"], r["place"], r["stand_in"]).tobytes(), "matrix"), "row long, chunk int, run int, matrix binary"))
    placed = chunks.join(states_between(matrices), ["row", "chunk"])
    traced = placed.mapInArrow(each(lambda e, r, part: e.traced(part, r["length"], r["place"], r["stand_in"], r["i"], r["j"]), "ids"), "row long, chunk int, ids array<int>")
    whole = traced.groupBy("row").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    return giants.join(whole, "row")


def decoded(encodings: DataFrame, pieces: Pieces, out: str = "decoded") -> DataFrame:
    """The rows with the text of their ``ids`` as column ``out``."""
    carried = encodings.drop(out)
    schema = StructType([*carried.schema.fields]).add(out, StringType())
    at = carried.columns.index("ids")
    table = pieces.bytes_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, at):
            ids = batch.column(at)
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            texts: list[bytes | None] = []
            for i, valid in enumerate(ids.is_valid().to_pylist()):
                own = flat[ends[i] : ends[i + 1]].tolist()
                texts.append(b"".join([table[x] for x in own if 0 <= x < len(table)])[1:] if valid else None)
            column = pa.array(texts, pa.binary())
            text = pa.Array.from_buffers(pa.string(), len(column), column.buffers(), column.null_count)
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, out])

    return carried.mapInArrow(run, schema)

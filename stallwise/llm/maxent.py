"""Language-model scores of a hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(class | history) * P(token | class, history). Both factors are log-linear in hashed features of the
history: the last word (n-gram), the last two words together (n-gram) and the word before the last (skip). The most
frequent ``FEATURED`` tokens, in ``HEAD_CLASSES`` classes by rank, have weights for single features; all others are in
``TAIL_CLASSES`` classes by a hash of their ending. In these, tokens with ``LEAST`` training occurrences or more are leaves of
a tree of nodes of ``FAN`` children, each a model with weights for all three features; the rest, one more child of the root,
follow from their counts, unseen ones included, so the probabilities of a class sum to one.

Training. For a log-linear model counts of (history, class) and (feature, token) say all that the texts say, and since features
are hashed to a fixed number of values these counts have a fixed size for classes and for the most frequent tokens. They are
summed over all training texts; each gradient update is a job over the counts, split by the hash of the last word, with one
update on the driver. Nodes of the trees are independent given the history, so each is fitted in one task, all updates at once.

Scale. Texts are split into words once, in Arrow batches. They are stored in chunks of about ``CHUNK`` words as numbers into the
chunk's own list of distinct words, so that only distinct words of chunks are counted and joined with the counts, never single
occurrences. Occurrences of tokens with own weights go to the trees as packed blocks, ``FAN`` * ``FAN`` children of two levels
together; a task takes ``LANE`` of them at most, whatever a tree's share of the corpus, and fits the nodes it scores from the
training counts of the whole tree part, which have a fixed size. Sums per text come back. A node has at most ``FAN`` + 1 children
and ``LAST`` * ``SKIP`` histories at any corpus size; nodes grow in number with the vocabulary.

Defined cases. A null text is empty: only the end is scored. Without training rows every token has the uniform weight of an
unseen one. Repeated rows and null ids are rows like any other; other columns are ignored. Ties in frequency are broken by the
token's bytes. Texts are never cut.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.common import gapless, text_bytes
from stallwise.session import discard, durable

LAST, SKIP, BOTH = 256, 64, 2048  # hash values of the three kinds of features; the first of LAST and SKIP is the start
FEATURED, HEAD_CLASSES, TAIL_CLASSES = 1024, 32, 16
CLASSES = HEAD_CLASSES + TAIL_CLASSES
PER_CLASS = FEATURED // HEAD_CLASSES
HISTORIES = LAST * SKIP
LEAST = 256  # training occurrences that give a token of a tail class its own weights
FAN = 32  # children of a node of a tail class's tree
REST = FAN  # the root's child for all tokens without own weights
SMOOTH = 0.1
END = b"\n"  # no word holds it
CHUNK = 1_000_000  # words stored and scored together
WIDE = FAN * FAN + 1  # children of two levels of a tree, and the rest
LANE = 2_000_000  # occurrences of tree tokens that a task takes
PARTS = 8


def tail_class(token: bytes) -> int:
    return HEAD_CLASSES + zlib.crc32(token[-2:]) % TAIL_CLASSES


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


CHUNKS = "doc_id array<long>, held_out array<boolean>, lengths array<int>, numbers binary, words array<binary>, classes array<int>, hashes array<int>, times array<int>"


def chunked(texts: DataFrame) -> DataFrame:
    """Whole texts of about ``CHUNK`` words together: ids, lengths with the end, which is a token too, token numbers, and per
    number the word, the class of its ending, its LAST and SKIP hash in one, and its training occurrences."""
    for name, missing in (("doc_id", F.lit(None).cast("long")), ("held_out", F.lit(False))):
        if name not in texts.columns:
            texts = texts.withColumn(name, missing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids, held, numbers, size = Numbers(), [], [], [], 0
        for batch in batches:
            own = (batch.column(name).to_pylist() for name in ("doc_id", "held_out"))
            for doc_id, out, text in zip(*own, text_bytes(batch.column("text"))):
                tokens = text.lower().split() if text else []
                tokens.append(END)
                ids.append(doc_id)
                held.append(out)
                numbers.append(np.fromiter(map(known.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
                size += len(tokens)
                if size >= CHUNK:
                    yield stored(known, ids, held, numbers)
                    known, ids, held, numbers, size = Numbers(), [], [], [], 0
        if ids:
            yield stored(known, ids, held, numbers)

    def stored(known: Numbers, ids: list, held: list, numbers: list[np.ndarray]) -> pa.RecordBatch:
        lengths = [len(x) for x in numbers]
        joined = np.concatenate(numbers)
        times = np.bincount(joined[np.repeat([out is False for out in held], lengths)], minlength=len(known))
        codes = np.array([zlib.crc32(w) for w in known], dtype=np.int64)
        hashes = (1 + codes % (LAST - 1)) * SKIP + 1 + (codes >> 8) % (SKIP - 1)
        values = (ids, held, lengths, packed([joined]), list(known), [tail_class(w) for w in known], hashes, times)
        types = (pa.int64(), pa.bool_(), pa.int32(), None, pa.binary(), pa.int32(), pa.int32(), pa.int32())
        columns = [pa.array([v], pa.binary()) if t is None else one(pa.array(v, t)) for v, t in zip(values, types)]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in CHUNKS.split(", ")])

    made = texts.select("doc_id", "held_out", "text").mapInArrow(run, CHUNKS)
    return durable(made.withColumn("chunk", F.monotonically_increasing_id()))


def one(values: pa.Array) -> pa.ListArray:
    """A column whose single row is a list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def packed(columns: list[np.ndarray]) -> bytes:
    """Whole numbers below 2^32 byte plane by byte plane, so that planes of zeros take next to nothing when compressed."""
    return b"".join(np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns)


def unpacked(data: bytes, width: int) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(width, 4, -1)
    return [np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes]


def counted(chunks: DataFrame) -> DataFrame:
    """token, class of its ending, n over all training texts of the chunks."""
    words = chunks.select(F.explode(F.arrays_zip("words", "classes", "times")).alias("w")).where("w.times > 0")
    return heavy(words.groupBy(F.col("w.words").alias("token"), F.col("w.classes").alias("class")).agg(F.sum("w.times").alias("n")))


def heavy(df: DataFrame) -> DataFrame:
    """``durable`` for plans with rows of some megabytes, few of which are read and passed to Python at a time."""
    conf = df.sparkSession.conf
    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20), "spark.sql.parquet.columnarReaderBatchSize": "16"}
    before = {name: conf.get(name) for name in limits}
    try:
        for name, value in limits.items():
            conf.set(name, value)
        return durable(df)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def token_counts(texts: DataFrame) -> DataFrame:
    """token, class of its ending, n over whole texts; the end of each text is a token."""
    return counted(chunked(texts))


@dataclass
class Vocabulary:
    """The ``FEATURED`` most frequent tokens by falling count, all training tokens, distinct ones, and the tail classes' totals."""

    tokens: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    tail: np.ndarray  # per class: sum of counts + SMOOTH over its tokens and an unseen one

    @property
    def featured(self) -> int:
        return min(FEATURED, len(self.tokens))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rows = counts.orderBy(F.desc("n"), "token").select("token", "n").limit(FEATURED).collect()
    tokens, n = [bytes(r["token"]) for r in rows], np.array([r["n"] for r in rows], dtype=np.int64)
    tail = np.full(CLASSES, SMOOTH)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():  # TAIL_CLASSES rows
        tail[row["class"]] += row["n"] + SMOOTH * row["types"]
    for token, count in zip(tokens[:FEATURED], n):
        tail[tail_class(token)] -= count + SMOOTH
    return Vocabulary(tokens, n, total, distinct, tail)


def histories(numbers: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LAST and SKIP hash of the history of every token."""
    last, skip = np.zeros(len(numbers), dtype=np.int64), np.zeros(len(numbers), dtype=np.int64)
    last[1:] = hashes[numbers[:-1]] // SKIP
    skip[2:] = hashes[numbers[:-2]] % SKIP
    last[starts] = skip[starts] = 0
    second = starts + 1
    skip[second[second < len(numbers)]] = 0
    return last, skip


def occurrences(chunk: dict[str, pa.Array], row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers, text and (LAST, SKIP) history of every occurrence in a chunk."""
    (numbers,) = unpacked(chunk["numbers"][row].as_py(), 1)
    lengths, hashes = (chunk[name][row].values.to_numpy() for name in ("lengths", "hashes"))
    starts = np.cumsum(np.append(0, lengths))[:-1]
    last, skip = histories(numbers, starts, hashes)
    return numbers, np.repeat(np.arange(len(starts)), lengths), last * SKIP + skip


def unlearnt(held_out: pa.ListScalar) -> np.ndarray:
    """Texts that are not for training; those of which this is unknown are not."""
    return held_out.values.fill_null(True).to_numpy(zero_copy_only=False)


BLOCKS = "kind int, key int, data binary"


def history_counts(texts: DataFrame, known: Vocabulary) -> DataFrame:
    """Counts over whole texts, see ``history_blocks``."""
    return history_blocks(chunked(texts), known)


def history_blocks(chunks: DataFrame, known: Vocabulary) -> DataFrame:
    """Counts over all training texts as blocks. Kind 0: (SKIP, class) per LAST hash; 1 and 2: featured tokens per
    LAST and per SKIP hash."""
    import pandas as pd

    ranks = {token: i for i, token in enumerate(known.tokens[:FEATURED])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((LAST, SKIP * CLASSES), np.int64), np.zeros((LAST, FEATURED), np.int64), np.zeros((SKIP, FEATURED), np.int64)]
        for batch in batches:
            chunk = dict(zip(batch.schema.names, batch.columns))
            for row in range(batch.num_rows):
                numbers, text, history = occurrences(chunk, row)
                rank_of = np.array([ranks.get(w, -1) for w in chunk["words"][row].values.to_pylist()])
                kind_of = np.where(rank_of < 0, chunk["classes"][row].values.to_numpy(), rank_of // PER_CLASS)
                learnt = ~unlearnt(chunk["held_out"][row])[text]
                numbers, (last, skip) = numbers[learnt], np.divmod(history[learnt], SKIP)
                rank, kind = rank_of[numbers], kind_of[numbers]
                own = rank >= 0
                for total, key, column in ((sums[0], last, skip * CLASSES + kind), (sums[1], last[own], rank[own]), (sums[2], skip[own], rank[own])):
                    total += np.bincount(key * total.shape[1] + column, minlength=total.size).reshape(total.shape)
        rows = [(kind, key, total[key].tobytes()) for kind, total in enumerate(sums) for key in np.flatnonzero(total.any(axis=1)).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["kind", "key", "data"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d, np.int64) for d in frame["data"])
        return pd.DataFrame({"kind": frame["kind"].iloc[:1], "key": frame["key"].iloc[:1], "data": [total.tobytes()]})

    partial = chunks.select("held_out", "lengths", "numbers", "words", "classes", "hashes").mapInArrow(run, BLOCKS)
    # one row per task and block; a lane adds those of 64 tasks, so that groups are few and no group holds the rows of all tasks
    lanes = partial.withColumn("lane", F.floor(F.spark_partition_id() / 64))
    first = lanes.groupBy("kind", "key", "lane").applyInPandas(lambda f: added(f), BLOCKS)
    return heavy(first.groupBy("kind", "key").applyInPandas(added, BLOCKS))


class Weights:
    """Weights by feature: class bias, LAST, SKIP, BOTH; token bias, LAST, SKIP."""

    def __init__(self, known: Vocabulary, classes: np.ndarray) -> None:
        self.parts = [np.zeros(CLASSES), np.zeros((LAST, CLASSES)), np.zeros((SKIP, CLASSES)), np.zeros((BOTH, CLASSES)), np.zeros(FEATURED), np.zeros((LAST, FEATURED)), np.zeros((SKIP, FEATURED))]
        self.parts[0][:] = np.log((classes + 0.5) / (classes + 0.5).sum())
        self.parts[4][:] = -30.0  # ranks that the vocabulary does not fill
        self.parts[4][: known.featured] = np.log(known.counts[: known.featured])

    def light(self) -> "Weights":
        """A copy of half the size for the tasks."""
        copy = object.__new__(Weights)
        copy.parts = [p.astype(np.float32) for p in self.parts]
        return copy

    def class_logits(self, last: int) -> np.ndarray:
        bias, by_last, by_skip, by_both = self.parts[:4]
        return bias + by_last[last] + by_skip + by_both[both(last)]

    def token_logits(self, last: int) -> np.ndarray:
        """(SKIP, HEAD_CLASSES, PER_CLASS)"""
        bias, by_last, by_skip = self.parts[4:]
        return (bias + by_last[last] + by_skip).reshape(SKIP, HEAD_CLASSES, PER_CLASS)


def both(last: int) -> np.ndarray:
    """Hash of (last, skip) for every skip."""
    return mixed(last * SKIP + np.arange(SKIP))


def mixed(history: np.ndarray) -> np.ndarray:
    return (history.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BOTH


def log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    raised = x - top
    return np.log(np.exp(raised, out=raised).sum(axis=-1, keepdims=True)) + top


def gradient(blocks: DataFrame, weights: Weights) -> tuple[list[np.ndarray], float]:
    """Expected minus observed counts by feature, and minus the log-likelihood; each task returns one sum."""
    sent = blocks.sparkSession.sparkContext.broadcast(weights.light())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        sums, loss = [np.zeros(p.shape) for p in weights.parts], 0.0
        for batch in batches:
            for row in batch.to_pylist():
                data, key = np.frombuffer(row["data"], np.int64).astype(float), row["key"]
                if row["kind"] == 0:
                    seen = data.reshape(SKIP, CLASSES)
                    logits = weights.class_logits(key)
                    chance = logits - log_sum(logits)
                    loss -= float((seen * chance).sum())
                    off = np.exp(chance) * seen.sum(axis=1, keepdims=True) - seen
                    sums[0] += off.sum(axis=0)
                    sums[1][key] += off.sum(axis=0)
                    sums[2] += off
                    np.add.at(sums[3], both(key), off)
                    logits = weights.token_logits(key)
                    total = log_sum(logits)
                    heads = seen[:, :HEAD_CLASSES]
                    loss += float((heads * total[:, :, 0]).sum())
                    expected = (np.exp(logits - total) * heads[:, :, None]).reshape(SKIP, FEATURED)
                    sums[4] += expected.sum(axis=0)
                    sums[5][key] += expected.sum(axis=0)
                    sums[6] += expected
                elif row["kind"] == 1:
                    sums[4] -= data
                    sums[5][key] -= data
                    loss -= float(data @ (weights.parts[4] + weights.parts[5][key]))
                else:
                    sums[6][key] -= data
                    loss -= float(data @ weights.parts[6][key])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate([s.ravel() for s in sums]).astype(np.float32).tobytes()], pa.binary()), "loss": pa.array([loss])})

    flat, loss = np.zeros(sum(p.size for p in weights.parts)), 0.0
    for part in blocks.coalesce(PARTS).mapInArrow(partial, "sums binary, loss double").collect():  # PARTS rows of fixed size
        flat += np.frombuffer(part["sums"], np.float32)
        loss += part["loss"]
    sent.destroy()  # its files go with it
    ends = np.cumsum([p.size for p in weights.parts])
    return [x.reshape(p.shape) for x, p in zip(np.split(flat, ends[:-1]), weights.parts)], loss


def trained(blocks: DataFrame, known: Vocabulary, updates: int = 20, rate: float = 0.25, prior: float = 2.0) -> Weights:
    """Weights after ``updates`` gradient updates with moment estimates per weight; ``prior`` pulls weights to zero."""
    classes = np.zeros(CLASSES)
    for n in range(known.featured):
        classes[n // PER_CLASS] += known.counts[n]
    classes[HEAD_CLASSES:] = known.tail[HEAD_CLASSES:]
    weights = Weights(known, classes)
    spread = durable(blocks.repartition(PARTS, "kind", "key"))
    mean, square = [np.zeros(p.shape) for p in weights.parts], [np.zeros(p.shape) for p in weights.parts]
    for step in range(1, updates + 1):
        found, _ = gradient(spread, weights)
        for i, part in enumerate(weights.parts):
            g = found[i] + (prior * part if i not in (0, 4) else 0)
            mean[i] = 0.8 * mean[i] + 0.2 * g
            square[i] = 0.95 * square[i] + 0.05 * g * g
            pace = rate * (1 - (step - 1) / updates)
            part -= pace * (mean[i] / (1 - 0.8**step)) / (np.sqrt(square[i] / (1 - 0.95**step)) + 1.0)
        weights.parts[4][known.featured :] = -30.0
    discard(spread)
    return weights


@dataclass
class Tables:
    """What scoring looks up, in log10 and float32: class by history, normaliser of head classes, weights by feature."""

    classes: np.ndarray  # (LAST * SKIP, CLASSES)
    totals: np.ndarray  # (LAST * SKIP, HEAD_CLASSES)
    bias: np.ndarray
    by_last: np.ndarray
    by_skip: np.ndarray


def tables(weights: Weights) -> Tables:
    unit = math.log10(math.e)
    classes = np.concatenate([(c := weights.class_logits(last)) - log_sum(c) for last in range(LAST)])
    totals = np.concatenate([log_sum(weights.token_logits(last))[:, :, 0] for last in range(LAST)])
    return Tables(*[(x * unit).astype(np.float32) for x in (classes, totals, *weights.parts[4:])])


def with_numbers(counts: DataFrame, known: Vocabulary) -> DataFrame:
    """token, n and, for tokens of tail classes with ``LEAST`` occurrences or more, a number within the class."""
    heads = counts.sparkSession.createDataFrame([(bytearray(t),) for t in known.tokens[:FEATURED]], "token binary")
    tail = durable(counts.join(F.broadcast(heads), "token", "left_anti"))
    own = gapless(tail.where(F.col("n") >= LEAST), "class", [F.col("token")], "number", few_groups=True).select("token", "class", "n", "number")
    rest = tail.where(F.col("n") < LEAST).withColumn("number", F.lit(-1).cast("long")).select("token", "class", "n", "number")
    numbers = durable(own.unionByName(rest))
    discard(tail)
    return numbers


def fitted_node(code: np.ndarray, child: np.ndarray, n: np.ndarray, root: bool, asked: tuple[np.ndarray, np.ndarray] | None = None, updates: int = 12, rate: float = 0.25, prior: float = 2.0) -> np.ndarray:
    """log10 P(child | node, history) for every row, or for the codes and children ``asked`` for; learns from the rows' training
    counts ``n``."""
    history, at = np.unique(code % HISTORIES, return_inverse=True)
    seen = np.bincount(at * (FAN + 1) + child, weights=n, minlength=len(history) * (FAN + 1)).reshape(len(history), FAN + 1).astype(np.float32)
    totals = seen.sum(axis=0, dtype=np.float64)
    present = np.zeros(FAN + 1, bool)
    present[child] = True
    present[REST] |= root
    bias = np.where(present, np.log(np.maximum(totals, SMOOTH)), -1e30).astype(np.float32)
    features = []
    for value in kinds(history):
        values, number = np.unique(value, return_inverse=True)
        order = np.argsort(number, kind="stable")  # LAST hashes come in order
        starts = np.searchsorted(number[order], np.arange(len(values)))
        features.append((number, order, starts, values))
    sizes = [FAN + 1] + [(len(f[2]), FAN + 1) for f in features]
    parts = [bias] + [np.zeros(x, np.float32) for x in sizes[1:]]
    mean, square = [np.zeros(x, np.float32) for x in sizes], [np.zeros(x, np.float32) for x in sizes]

    def logits() -> np.ndarray:
        total = parts[1][features[0][0]]
        for w, f in zip(parts[2:], features[1:]):
            total += w[f[0]]
        total += parts[0]
        return total

    weight = seen.sum(axis=1, keepdims=True)
    for step in range(1, updates + 1):
        off = logits()
        off -= log_sum(off)
        np.exp(off, out=off)
        off *= weight
        off -= seen
        slopes = [off.sum(axis=0)] + [np.add.reduceat(off if i == 0 else off[order], starts, axis=0) + prior * w for i, (w, (_, order, starts, _)) in enumerate(zip(parts[1:], features))]
        for i, g in enumerate(slopes):
            mean[i] = 0.8 * mean[i] + 0.2 * g
            square[i] = 0.95 * square[i] + 0.05 * g * g
            pace = rate * (1 - (step - 1) / updates)
            parts[i] = parts[i] - pace * (mean[i] / (1 - 0.8**step)) / (np.sqrt(square[i] / (1 - 0.95**step)) + 1.0)
    if asked is not None:
        history, at = np.unique(asked[0] % HISTORIES, return_inverse=True)
        child = asked[1]
        # feature values that training didn't see have no weight
        parts = [parts[0]] + [np.concatenate([w, np.zeros((1, FAN + 1), np.float32)]) for w in parts[1:]]
        features = [(placed(f[3], value),) for f, value in zip(features, kinds(history))]
    chance = logits()
    return (chance - log_sum(chance))[at, child].astype(float) * math.log10(math.e)


def kinds(history: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the three kinds of features."""
    return *np.divmod(history, SKIP), mixed(history)


def placed(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``values``, ``len(values)`` for those that are missing."""
    if not len(values):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return np.where(values[at] == wanted, at, len(values))


TREE = ["stage", "class", "part"]  # two levels of a class's tree below one node, or one level if it is the root's
PIECES = (
    "chunk long, stage int, class int, part long, held boolean, entries long, data binary, "
    "doc_id array<long>, held_out array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>, score array<double>"
)


def pieces(chunks: DataFrame, found: DataFrame, known: Vocabulary, model: Tables, rest: np.ndarray, depth: int) -> DataFrame:
    """Per chunk a row with what is known of its texts without the trees (stage -1), and for every part of a tree the
    occurrences of its tokens as (child, history, text, times) in blocks."""
    schema = pa.schema([pa.field(*x) for x in (
        ("chunk", pa.int64()), ("stage", pa.int32()), ("class", pa.int32()), ("part", pa.int64()), ("held", pa.bool_()), ("entries", pa.int64()), ("data", pa.binary()),
        ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())),
        ("base", pa.list_(pa.float64())), ("score", pa.list_(pa.float64())))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = dict(zip(left.schema.names, left.combine_chunks().columns))
        numbers, text, history = occurrences(chunk, 0)
        texts, held = len(chunk["lengths"][0]), unlearnt(chunk["held_out"][0])
        class_of = chunk["classes"][0].values.to_numpy()
        # count, rank and number within the class by token number
        count_of, place_of = np.zeros(len(class_of), np.int64), np.full(len(class_of), -1)
        at = right["pos"].to_numpy()
        count_of[at], place_of[at] = right["n"].to_numpy(), right["number"].to_numpy()
        rank_of = np.where(place_of < -1, -2 - place_of, -1)
        kind_of = np.where(rank_of >= 0, rank_of // PER_CLASS, class_of)
        log_of = np.log10(count_of + SMOOTH)
        rank, kind = rank_of[numbers], kind_of[numbers]
        token = np.where(place_of[numbers] == -1, log_of[numbers] - np.log10(np.maximum(rest, SMOOTH))[class_of[numbers]], 0.0)
        own = rank >= 0
        f, (last, skip) = rank[own], np.divmod(history[own], SKIP)
        token[own] = model.bias[f].astype(float) + model.by_last[last, f] + model.by_skip[skip, f] - model.totals[history[own], kind[own]]

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(text, weights=values, minlength=texts)

        base = per_text(log_of[numbers] - math.log10(known.total + SMOOTH * (known.distinct + 1)))
        known_tokens = per_text(count_of[numbers] > 0).astype(np.int64)
        score = per_text(model.classes[history, kind] + token)
        identity = chunk["chunk"][0].as_py()
        rows = [(identity, -1, None, None, None, None, None, chunk["doc_id"][0].as_py(), chunk["held_out"][0].as_py(), chunk["lengths"][0].values.to_numpy().astype(np.int64), known_tokens, base, score)]
        tail = np.flatnonzero(~own)
        place, kind, text, history = place_of[numbers[tail]], kind[tail], text[tail], history[tail]
        for stage in range((depth + 1) // 2):
            top = 2 * stage + 2 >= depth  # the root is among its levels
            taken = np.flatnonzero((place >= 0) | top)
            up = place[taken] // FAN ** (2 * stage)
            child = np.where(up < 0, WIDE - 1, up % (FAN * FAN))
            part = np.where(up < 0, 0, up // (FAN * FAN))
            # by block (class, part, held out) first, then by what fills it
            spread = int(part.max(initial=0)) + 1
            block = ((kind[taken] - HEAD_CLASSES) * spread + part) * 2 + held[text[taken]]
            inner = (child * HISTORIES + history[taken]) * texts + text[taken]
            order = np.lexsort((inner, block))
            block, inner = block[order], inner[order]
            first = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (inner[1:] != inner[:-1]))[: len(block)])
            times = np.diff(np.append(first, len(block)))
            block, inner = block[first], inner[first]
            cell, owner = np.divmod(inner, texts)
            child, past = np.divmod(cell, HISTORIES)
            starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])[: len(block)])
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(block)).tolist()):
                above, out = divmod(int(block[a]), 2)
                of, within = divmod(above, spread)
                rows.append((identity, stage, of + HEAD_CLASSES, within, bool(out), b - a, packed([child[a:b], past[a:b], owner[a:b], times[a:b]]), *[None] * 6))
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], field.type) for i, field in enumerate(schema)], schema=schema)

    left = chunks.select("chunk", "doc_id", "held_out", "lengths", "numbers", "classes", "hashes")
    return heavy(left.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(run, PIECES))


def summed_cells(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells (child, history) and their sums."""
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cells, at = np.unique(np.concatenate(codes), return_inverse=True)
    return cells, np.bincount(at, weights=np.concatenate(times)).astype(np.int64)


CELLS = "stage int, class int, part long, lanes int, data binary"


def added_cells(table: pa.Table) -> pa.Table:
    """One row of the training counts of a tree's part, from blocks of occurrences or from rows of counts."""
    codes, times = [], []
    for data, entries in zip(table["data"].to_pylist(), table["entries"].to_pylist()):
        if entries is None:
            cell, n = unpacked(data, 2)
        else:
            child, past, _, n = unpacked(data, 4)
            cell = child * HISTORIES + past
        codes.append(cell)
        times.append(n)
    return table.select([*TREE, "lanes"]).slice(0, 1).append_column("data", pa.array([packed(list(summed_cells(codes, times)))], pa.binary()))


def tree_sums(blocks: DataFrame, depth: int) -> DataFrame:
    """chunk, text, tree: per text the sum of log10 P(token | tail class, history) over its tokens of tail classes, with the
    probability of the rest for tokens without own weights.

    Tokens of a class are leaves of a tree by the digits of their number in base ``FAN``. Every node is a model of its own, for
    at most ``FAN`` + 1 children and ``HISTORIES`` histories. Two levels are worked out together. Parts with more than ``LANE``
    occurrences are dealt over several tasks, each of which gets the training counts of the whole part.
    """
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = blocks.groupBy(*TREE).agg(F.ceil(F.sum("entries") / F.lit(LANE)).cast("int").alias("lanes"))
    blocks = blocks.select("chunk", *TREE, "held", "entries", "data").join(sizes, TREE).withColumn("lane", F.pmod(F.xxhash64("chunk"), "lanes").cast("int"))
    split = blocks.where("lanes > 1 and not held").select(*TREE, "lanes", "lane", "entries", "data")
    cells = split.groupBy(*TREE, "lane").applyInArrow(added_cells, CELLS).withColumn("entries", F.lit(None).cast("long"))
    cells = heavy(cells.groupBy(*TREE).applyInArrow(added_cells, CELLS))
    shared = cells.select(
        F.lit(None).cast("long").alias("chunk"), *TREE, F.lit(None).cast("boolean").alias("held"), F.lit(None).cast("long").alias("entries"), "data",
        "lanes", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"))

    def run(table: pa.Table) -> pa.Table:
        stage, lanes = table["stage"][0].as_py(), table["lanes"][0].as_py()
        seen, n, chunks, columns = [], [], [], []
        for chunk, held, data in zip(*(table[name].to_pylist() for name in ("chunk", "held", "data"))):
            if chunk is None:
                cell, times = unpacked(data, 2)
                seen.append(cell)
                n.append(times)
                continue
            child, past, owner, times = unpacked(data, 4)
            cell = (child * HISTORIES + past).astype(np.int32)
            if lanes == 1 and not held:
                seen.append(cell)
                n.append(times)
            chunks.append(chunk)
            columns.append((cell, owner.astype(np.int32), times.astype(np.int32)))
        del table
        chance = two_levels(*summed_cells(seen, n), np.concatenate([c[0] for c in columns]) if columns else np.zeros(0, np.int32), stage, depth)
        ids, texts, sums, at = [], [], [], 0
        for chunk, (cell, owner, times) in zip(chunks, columns):
            total = np.bincount(owner, weights=chance[at : at + len(cell)] * times)
            at += len(cell)
            own = np.unique(owner)
            ids.append(chunk)
            texts.append(own.astype("<i4").tobytes())
            sums.append(total[own].tobytes())
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(sums, pa.binary())], names=["chunk", "texts", "sums"])

    spread = blocks.select(shared.columns).unionByName(shared).repartition(tasks, *TREE, "lane")
    scores = heavy(spread.groupBy(*TREE, "lane").applyInArrow(run, "chunk long, texts binary, sums binary"))
    discard(cells)
    return scores


def two_levels(cells: np.ndarray, n: np.ndarray, asked: np.ndarray, stage: int, depth: int) -> np.ndarray:
    """log10 probabilities of the cells (child, history) ``asked`` for at the levels of a stage, from the training counts ``n``."""
    wanted, back = np.unique(asked, return_inverse=True)
    (child, past), (want, wanted_past) = np.divmod(cells, HISTORIES), np.divmod(wanted.astype(np.int64), HISTORIES)
    chance = np.zeros(len(wanted))
    upper = 2 * stage + 1 < depth
    if upper:
        for node in np.unique(want[want < WIDE - 1] // FAN).tolist():
            learn, mine = (np.flatnonzero((x < WIDE - 1) & (x // FAN == node)) for x in (child, want))
            chance[mine] += fitted_node(past[learn], child[learn] % FAN, n[learn], False, (wanted_past[mine], want[mine] % FAN))
    top = [np.where(x == WIDE - 1, REST, x // FAN if upper else x) for x in (child, want)]
    chance += fitted_node(past, top[0], n, 2 * stage + 2 >= depth, (wanted_past, top[1]))
    return chance[back]


def scored(documents: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    The model learns from the rows where ``held_out`` is false. Scores are log10 probabilities of whole texts.
    """
    chunks = chunked(documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text")))
    counts = counted(chunks)
    known = vocabulary(counts)
    blocks = history_blocks(chunks, known)
    model = tables(trained(blocks, known))
    discard(blocks)
    numbers = with_numbers(counts, known)
    discard(counts)
    own = numbers.where(F.col("number") >= 0)
    depth = tree_depth(own.agg(F.max("number")).first()[0])
    rest = known.tail.copy()
    for row in own.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():  # TAIL_CLASSES rows
        rest[row["class"]] -= row["n"] + SMOOTH * row["types"]
    heads = [(bytearray(t), int(n), -2 - i) for i, (t, n) in enumerate(zip(known.tokens[:FEATURED], known.counts))]
    all_numbers = numbers.select("token", "n", "number").unionByName(chunks.sparkSession.createDataFrame(heads, "token binary, n long, number long"))
    words = chunks.select(F.col("chunk").alias("of"), F.posexplode("words").alias("pos", "token"))
    # stored by itself, so that the shuffle files of the words are gone when the chunks are shuffled
    found = heavy(words.join(all_numbers, "token").select("of", "pos", "n", "number"))
    discard(numbers)
    parts = pieces(chunks, found, known, model, rest, depth)
    discard(chunks)
    discard(found)
    rows = parts.where("stage < 0").select("chunk", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", F.lit(None).cast("binary").alias("texts"), F.lit(None).cast("binary").alias("sums"))
    if depth:
        sums = tree_sums(parts.where("stage >= 0"), depth)
        rows = rows.unionByName(sums, allowMissingColumns=True)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score"]

    def joined(table: pa.Table) -> pa.Table:
        main = table.filter(table["texts"].is_null()).combine_chunks()
        columns = [main[name].combine_chunks().flatten() for name in names]
        score = columns[-1].to_numpy().copy()
        # one order of adding whatever order the rows came in
        for texts, more in sorted((t.as_py(), s.as_py()) for t, s in zip(table["texts"], table["sums"]) if t.is_valid):
            score[np.frombuffer(texts, "<i4")] += np.frombuffer(more)
        return pa.Table.from_arrays([*columns[:-1], pa.array(score)], names=names)

    result = heavy(rows.groupBy("chunk").applyInArrow(joined, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"))
    discard(parts)
    if depth:
        discard(sums)
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(known.total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def tree_depth(largest: int | None) -> int:
    """Levels of a tree whose leaves are numbered up to ``largest``."""
    depth = 0 if largest is None else 1
    while depth and largest >= FAN**depth:
        depth += 1
    return depth

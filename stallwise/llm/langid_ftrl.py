"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, everything else is a word boundary; n-grams of one to three characters are hashed to ``2**bits``
columns. Document frequencies come from all whole training texts. Weights are fitted on a bounded sample of them by the
follow-the-regularised-leader update with an elastic net (l1 sets weights to zero, l2 shrinks them): in each round the
tasks sum the gradient over their rows and one update follows. A part of the sample that the fit does not see then sets
the temperature by which logits are divided, so that scores are probabilities.

Scale. Two passes over the texts: frequencies (a task keeps one array and emits at most ``2**bits`` rows) and predictions
(no shuffle). The sample holds about ``sample_rows`` rows however large the input is, split evenly over the
languages, rare ones whole; the driver holds one weight per column and language.

Defined cases. A text that is null or has no letter is ``und`` with score 0; so is every text if nothing can be learned.
Null languages and null texts teach nothing. Ties between languages go to the one that sorts first. The prediction is a
function of the text alone. Repeated rows count as often as they occur; other columns are passed through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from stallwise.llm.common import text_bytes
from stallwise.session import durable

UNKNOWN = "und"
ORDERS = 3
PARTS = 8  # partial gradients of a round
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def hasher(bits: int) -> Callable[[bytes | None], tuple[np.ndarray, np.ndarray]]:
    """A function from a text to its n-gram columns and their counts; both are empty without a letter."""
    letter: np.ndarray | None = None
    shift = np.uint64(64 - bits)

    def columns(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        nonlocal letter
        if letter is None:
            letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letter[points]
        if not is_letter.any():
            return none, none
        padded = np.zeros(len(points) + 2, dtype=np.uint64)
        padded[1:-1] = np.where(is_letter, points, 0)
        keep = np.ones(len(padded), dtype=bool)
        keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
        chars = padded[keep] + np.uint64(1)
        hashed, found = np.zeros(len(chars), dtype=np.uint64), []
        for n in range(ORDERS):
            # a rolling polynomial of the last n + 1 characters, then a multiplicative hash with a constant per order
            hashed = chars if n == 0 else hashed[:-1] * np.uint64(0x100000001B3) + chars[n:]
            mixed = hashed * np.uint64(MIX[n])
            found.append((mixed ^ (mixed >> np.uint64(29))) * np.uint64(MIX[0]) >> shift)
        counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=1 << bits)
        at = np.flatnonzero(counts)
        return at, counts[at]

    return columns


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[at]
    length = math.sqrt(float(values @ values))
    return values / length if length else values


@dataclass
class Model:
    """Learned languages in order, idf per column, weights (last row: bias), temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int

    def rule(self) -> Callable[[bytes | None], tuple[str, float]]:
        columns, idf = hasher(self.bits), self.idf
        weights, languages, temperature = self.weights, self.languages, self.temperature

        def predict(text: bytes | None) -> tuple[str, float]:
            at, counts = columns(text)
            if not len(at) or not languages:
                return UNKNOWN, 0.0
            logits = (weighted(at, counts, idf) @ weights[at] + weights[-1]) / temperature
            best = int(np.argmax(logits))
            return languages[best], float(1 / np.exp(logits - logits[best]).sum())

        return predict


def frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """In how many texts each column occurs, and the number of texts with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, total, rows = hasher(bits), np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for text in text_bytes(batch.column("text")):
                at, _ = columns(text)
                total[at] += 1
                rows += len(at) > 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.append(at, -1)), "n": pa.array(np.append(total[at], rows))})

    summed = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    found, rows = np.zeros(1 << bits, dtype=np.int64), 0
    for at, n in summed.collect():  # at most 2**bits + 1 rows
        if at < 0:
            rows = n
        else:
            found[at] = n
    return found, rows


def vectors(sample: DataFrame, languages: list[str], idf: np.ndarray, bits: int) -> DataFrame:
    """label, fold, at, values: the sample as sparse rows, stored."""
    number = {language: i for i, language in enumerate(languages)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = hasher(bits)
        for batch in batches:
            out: list[tuple] = []
            for text, language, fold in zip(text_bytes(batch.column("text")), batch.column("lang").to_pylist(), batch.column("fold").to_pylist()):
                at, counts = columns(text)
                if len(at):
                    out.append((number[language], fold, at.astype(np.int32).tobytes(), weighted(at, counts, idf).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["label", "fold", "at", "values"])

    encoded = sample.repartition(PARTS, "key").mapInArrow(encode, "label int, fold int, at binary, values binary")
    return durable(encoded)


def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, row starts, columns and values of a batch of sparse rows."""
    at = [np.frombuffer(x, np.int32) for x in batch.column("at").to_pylist()]
    values = np.concatenate([np.frombuffer(x, np.float32) for x in batch.column("values").to_pylist()])
    return np.array(batch.column("label")), np.cumsum([0] + [len(x) for x in at])[:-1], np.concatenate(at), values


def logits_of(starts: np.ndarray, at: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.stack([np.add.reduceat(weights[at, k] * values, starts) + weights[-1, k] for k in range(weights.shape[1])], axis=1)


def gradient(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Mean gradient of the cross-entropy over the rows; each task returns one sum."""
    size, classes = weights.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((size, classes)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            labels, starts, at, values = rows_of(batch)
            logits = logits_of(starts, at, values, weights)
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(labels)), labels] -= 1
            lengths = np.diff(np.append(starts, len(at)))
            for k in range(classes):
                total[:-1, k] += np.bincount(at, values * np.repeat(chance[:, k], lengths), minlength=size - 1)
            total[-1] += chance.sum(axis=0)
            n += len(labels)
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary()), "n": pa.array([n])})

    sums, n = np.zeros((size, classes)), 0
    for part in rows.coalesce(PARTS).mapInArrow(partial, "total binary, n long").collect():  # PARTS rows of fixed size
        sums += np.frombuffer(part["total"]).reshape(size, classes)
        n += part["n"]
    return sums / max(n, 1)


def leader(rows: DataFrame, size: int, classes: int, rounds: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after ``rounds`` updates of follow-the-regularised-leader."""
    z, n, weights = (np.zeros((size, classes)) for _ in range(3))
    for _ in range(rounds):
        g = gradient(rows, weights)
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / alpha
        z += g - sigma * weights
        n += g * g
        penalty = np.full((size, 1), l1)
        penalty[-1] = 0
        weights = np.where(np.abs(z) <= penalty, 0.0, -(z - np.sign(z) * penalty) / ((beta + np.sqrt(n)) / alpha + l2))
    return weights


def calibrated(rows: DataFrame, weights: np.ndarray) -> float:
    """The temperature of least cross-entropy on rows the fit has not seen, between 1/20 and 20; 1 without rows.

    Targets are smoothed by one row's worth, so a perfect fit doesn't make scores certain.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                labels, starts, at, values = rows_of(batch)
                yield pa.RecordBatch.from_pydict({"label": pa.array(labels), "logits": pa.array([x.tobytes() for x in logits_of(starts, at, values, weights)], pa.binary())})

    found = rows.mapInArrow(score, "label int, logits binary").collect()  # a tenth of the sample
    if not found:
        return 1.0
    labels, logits = np.array([r["label"] for r in found]), np.stack([np.frombuffer(r["logits"]) for r in found])

    doubt = 1 / (len(labels) + 2)
    target = np.full(logits.shape, doubt / logits.shape[1])
    target[np.arange(len(labels)), labels] += 1 - doubt

    def loss(log_t: float) -> float:
        scaled = logits / math.exp(log_t)
        top = scaled.max(axis=1)
        return float((np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top - (scaled * target).sum(axis=1)).mean())

    low, high, golden = math.log(1 / 20), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def train(documents: DataFrame, learn: Column, bits: int = 15, sample_rows: int = 8000, rounds: int = 25,
          alpha: float = 3.0, beta: float = 1e-4, l1: float = 2e-6, l2: float = 1e-4) -> Model:
    """A model from the rows where ``learn`` holds and text and lang are known."""
    known = documents.where(learn).where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        F.abs(F.xxhash64(F.col("doc_id"), F.length("text"))).alias("key"),
    )
    sizes = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.ones(1 << bits), np.zeros(((1 << bits) + 1, 0)), 1.0, bits)
    found, rows = frequencies(known, bits)
    idf = np.log((1 + rows) / (1 + found)) + 1
    each = sample_rows / len(languages)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(1_000_000 * min(1.0, each / sizes[lang])))])
    sample = known.where(F.pmod(F.col("key"), F.lit(1_000_000)) < share[F.col("lang")]).withColumn("fold", (F.floor(F.col("key") / 1_000_000) % 10).cast("int"))
    stored = vectors(sample, languages, idf, bits)
    weights = leader(stored.where("fold > 0"), (1 << bits) + 1, len(languages), rounds, alpha, beta, l1, l2)
    return Model(languages, idf, weights, calibrated(stored.where("fold = 0"), weights), bits)


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with lang_pred and score added (columns of that name are replaced)."""
    rule = model.rule()
    carried = documents.drop("lang_pred", "score")
    at = carried.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule(text) for text in text_bytes(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*carried.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return carried.mapInArrow(run, schema)


def told(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents with a letter whose predicted language has a probability of at least ``least``, all columns."""
    rule, at = model.rule(), documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule(text) for text in text_bytes(batch.column(at))]
            yield batch.filter(pa.array([language != UNKNOWN and score >= least for language, score in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)

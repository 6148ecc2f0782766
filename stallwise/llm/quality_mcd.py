"""Quality rules: robust multivariate outliers per language and source.

Each text becomes a vector of transformed statistics. Per (language, source) the minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps: the ``support`` share of rows nearest to the current
centre gives the next centre and scatter, until ``steps`` are done. A last step re-estimates from all rows within the
97.5 % ellipse. A text is rejected when its squared Mahalanobis distance exceeds ``cutoff``.

Scale. Texts are read once, in Arrow batches, and leave a narrow stored table. A concentration step is one pass over
that table: moments are summed per (group, distance bin), map-side first, so a group with a third of all rows never
meets in one task, and what is shuffled is some hundred rows per group. Vectors are whole numbers (thousandths), sums
are exact and repeatable, and the subset of a step is cut at a bin edge (bins of 1/16 of a power of two).

Defined cases. A null or empty text has zero words and fails the base rule. Groups with fewer than ``min_rows`` rows
that pass the base rule are pooled per language, and pools that are still too small into one; where even that is too
small nothing but the base rule rejects. Null languages and sources are groups like any other. Constant
statistics do no harm: scatter has a floor per statistic. Repeated rows are kept as they are; other columns are ignored.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.llm.common import map_batches, text_bytes
from stallwise.session import durable

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

UNIT = 1000  # vectors are whole thousandths
LIMIT = 16  # and lie within +-LIMIT
STATISTICS = ["log_words", "log_word_length", "symbol_rate", "upper_rate", "dup_line_rate", "repeat_rate"]
# Noise added to the standard deviation of a statistic: one repeated line or a single symbol is no outlier.
FLOOR = [0.10, 0.02, 0.03, 0.03, 0.15, 0.11]
SIZE = len(STATISTICS)
PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
BINS_PER_OCTAVE = 16


def chi_square(share: float, freedom: int = SIZE) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    from statistics import NormalDist

    spread = 2 / (9 * freedom)
    return freedom * (1 - spread + NormalDist().inv_cdf(share) * math.sqrt(spread)) ** 3


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=n)
    pairs = ids[:-1] * len(codes) + ids[1:]
    if len(codes) > 1_000_000:  # three ids no longer fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(codes) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    equal = ranked[1:] == ranked[:-1]
    again = np.zeros(n - 2, dtype=bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics_of(text: bytes | None) -> tuple[int, ...]:
    """The counts of one whole text, then its lines with a word and its capitals."""
    if not text:
        return (0,) * 7
    words = text.split()
    joined = b"".join(words)
    # code points: bytes that do not continue another
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS.encode()))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    upper = len(joined) - len(joined.translate(None, UPPER.encode()))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), upper


def measured(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    counts = np.array([statistics_of(text) for text in text_bytes(batch.column("text"))], dtype=np.int64).reshape(-1, 7)
    n_words, chars, symbols, dup_lines, repeats, lines, upper = counts.T.astype(float)
    words, chars = np.maximum(n_words, 1), np.maximum(chars, 1)
    vectors = [np.log(words), np.log(chars / words), np.sqrt(symbols / chars), np.sqrt(upper / chars), np.sqrt(dup_lines / np.maximum(lines, 1)), np.sqrt(repeats / words)]
    out = {name: batch.column(name) for name in ("doc_id", "lang", "source", "digest")}
    out |= {name: pa.array(counts[:, i]) for i, name in enumerate(COUNTS)}
    return out | {f"x{i}": pa.array(np.clip(np.rint(v * UNIT), -LIMIT * UNIT, LIMIT * UNIT).astype(np.int64)) for i, v in enumerate(vectors)}


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, a digest of the text, the five counts, base_failed, and the vector x0..x5 in thousandths."""
    schema = "doc_id long, lang string, source string, digest long, " + ", ".join(f"{c} long" for c in [*COUNTS, *[f"x{i}" for i in range(SIZE)]])
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("digest"))
    return map_batches(narrow, measured, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    )


def group_keys(statistics: DataFrame, min_rows: int) -> DataFrame:
    """lang, source, group: the pair itself, its language's pool of small pairs, or the pool of small languages."""
    sizes = statistics.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < min_rows
    pool = F.sum(F.when(small, F.col("n")).otherwise(0)).over(Window.partitionBy("lang"))
    return sizes.withColumn("pool", pool).select(
        "lang", "source",
        F.when(~small, F.to_json(F.struct(F.lit("pair").alias("level"), "lang", "source")))
        .when(F.col("pool") >= min_rows, F.to_json(F.struct(F.lit("language").alias("level"), "lang")))
        .otherwise(F.lit("rest")).alias("group"),
    )


def distance() -> Column:
    """Squared Mahalanobis distance of x0..x5 to the joined columns ``centre`` and ``inverse``."""
    delta = [F.col(f"x{i}") / F.lit(float(UNIT)) - F.col("centre")[i] for i in range(SIZE)]
    total = F.lit(0.0)
    for at, (i, j) in enumerate(PAIRS):
        total = total + delta[i] * delta[j] * F.col("inverse")[at] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def binned(d2: Column) -> Column:
    return F.floor(F.log2(d2 + F.lit(2.0**-20)) * BINS_PER_OCTAVE).cast("int")


def moments_by_bin(vectors: DataFrame, parameters: DataFrame) -> DataFrame:
    """Count, sums and sums of products per (group, distance bin)."""
    joined = vectors.join(parameters, "group").withColumn("bin", binned(distance()))
    return joined.groupBy("group", "bin").agg(
        F.count("*").alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(SIZE)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{at}") for at, (i, j) in enumerate(PAIRS)],
    )


PARAMETERS = "group string, centre array<double>, inverse array<double>"


def estimated(frame):
    """Centre and inverse scatter per group from its sums; ``median`` is the middle distance of the step before."""
    out = []
    for row in frame.itertuples(index=False):
        n = float(row.n)
        centre = np.array([float(getattr(row, f"s{i}")) for i in range(SIZE)]) / n
        scatter = np.zeros((SIZE, SIZE))
        for at, (i, j) in enumerate(PAIRS):
            scatter[i, j] = scatter[j, i] = float(getattr(row, f"p{at}")) / n - centre[i] * centre[j]
        scatter = scatter / UNIT**2 + np.diag(np.square(FLOOR))
        inverse = np.linalg.inv(scatter)
        out.append((row.group, (centre / UNIT).tolist(), [inverse[i, j] for i, j in PAIRS]))
    import pandas as pd

    return pd.DataFrame(out, columns=["group", "centre", "inverse"])


def concentrated(by_bin: DataFrame, keep: Column) -> DataFrame:
    """New parameters from the bins for which ``keep`` holds (n rows, n_before in nearer bins, n_all in the group)."""
    nearer = Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = ["n", *[f"s{i}" for i in range(SIZE)], *[f"p{at}" for at in range(len(PAIRS))]]
    chosen = (
        by_bin.withColumn("n_before", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
        .withColumn("n_all", F.sum("n").over(Window.partitionBy("group")))
        .where(keep).groupBy("group").agg(*[F.sum(s).alias(s) for s in sums])
    )
    return durable(chosen.mapInPandas(lambda frames: map(estimated, frames), PARAMETERS))


def first_parameters(vectors: DataFrame) -> DataFrame:
    """Medians and quartile widths per statistic: a robust start with a diagonal scatter."""
    bins = vectors.select("group", F.posexplode(F.array(*[F.floor(F.col(f"x{i}") / 10) for i in range(SIZE)])).alias("i", "bin")).groupBy("group", "i", "bin").agg(F.count("*").alias("n"))
    window = Window.partitionBy("group", "i")
    upto = F.sum("n").over(window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = bins.withColumn("upto", upto).withColumn("n_all", F.sum("n").over(window))
    quantile = [F.min(F.when(F.col("upto") >= F.col("n_all") * q, F.col("bin"))) * 10.0 / UNIT for q in (0.25, 0.5, 0.75)]
    quartiles = ranked.groupBy("group", "i").agg(*[q.alias(name) for q, name in zip(quantile, ("low", "middle", "high"))])
    floors = F.array(*[F.lit(f) for f in FLOOR])
    deviation = F.greatest((F.col("high") - F.col("low")) / 1.349, F.element_at(floors, F.col("i") + 1))
    wide = quartiles.groupBy("group").agg(
        *[F.max(F.when(F.col("i") == i, F.col("middle"))).alias(f"m{i}") for i in range(SIZE)],
        *[F.max(F.when(F.col("i") == i, 1 / (deviation * deviation))).alias(f"v{i}") for i in range(SIZE)],
    )
    return durable(wide.select("group", F.array(*[f"m{i}" for i in range(SIZE)]).alias("centre"), F.array(*[F.col(f"v{i}") if i == j else F.lit(0.0) for i, j in PAIRS]).alias("inverse")))


def with_scale(vectors: DataFrame, parameters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rescales so that a group's median distance is that of a normal sample; also returns the group's bins."""
    by_bin = moments_by_bin(vectors, parameters)
    upto = F.sum("n").over(Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = by_bin.select("group", "bin", "n", upto.alias("upto"), F.sum("n").over(Window.partitionBy("group")).alias("n_all"))
    median = ranked.groupBy("group").agg(F.min(F.when(2 * F.col("upto") >= F.col("n_all"), F.col("bin"))).alias("middle"))
    factor = F.lit(chi_square(0.5)) / F.pow(F.lit(2.0), (F.col("middle") + 0.5) / BINS_PER_OCTAVE)
    # never widened by floors alone: a group of equal vectors keeps its floors
    scaled = parameters.join(median, "group").select("group", "centre", F.transform("inverse", lambda v: v * F.least(factor, F.lit(1.0))).alias("inverse"))
    return durable(scaled), by_bin


def minimum_covariance(vectors: DataFrame, support: float = 0.75, steps: int = 6) -> DataFrame:
    """group, centre, inverse: the reweighted minimum-covariance-determinant estimate of every group."""
    parameters = first_parameters(vectors)
    half = F.col("n_before") < F.ceil(F.col("n_all") * support)
    for _ in range(steps):
        parameters = concentrated(moments_by_bin(vectors, parameters), half)
    scaled, _ = with_scale(vectors, parameters)
    edge = math.floor(math.log2(chi_square(0.975)) * BINS_PER_OCTAVE)
    reweighted = concentrated(moments_by_bin(vectors, scaled), (F.col("bin") <= edge) | half)
    return with_scale(vectors, reweighted)[0]


# Squared distance beyond which a text is rejected: one in a million of normal vectors. Floors are small enough for each
# statistic to pass it alone: all lines repeated add 1 / 0.15^2 = 44, half the words repeated 0.5 / 0.11^2 = 41.
CUTOFF = chi_square(1 - 1e-6)


def outliers(documents: DataFrame, cutoff: float = CUTOFF, support: float = 0.75, steps: int = 6, min_rows: int = 100) -> DataFrame:
    """Statistics of every text, ``distance`` (null without an estimate) and ``kept``; nothing is dropped."""
    stored = durable(text_statistics(documents))
    keys = durable(group_keys(stored, min_rows))
    tagged = stored.join(keys.withColumnsRenamed({"lang": "_lang", "source": "_source"}), F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left").drop("_lang", "_source")
    vectors = durable(tagged.where(~F.col("base_failed")).select("group", *[f"x{i}" for i in range(SIZE)]))
    enough = vectors.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows).select("group")
    parameters = minimum_covariance(durable(vectors.join(enough, "group", "left_semi")), support, steps)
    judged = tagged.join(parameters, "group", "left").withColumn("distance", F.when(F.col("centre").isNotNull(), distance()))
    return judged.select(
        "doc_id", "lang", "source", "digest", *COUNTS, "base_failed",
        "distance", (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)).alias("kept"),
    )


def filtered(documents: DataFrame, **settings) -> DataFrame:
    """The documents that ``outliers`` keeps, with all their columns.

    Rows are matched by id, language, source and a digest of the text, null to null; rows that are equal in these have the
    same verdict, so repeated and missing ids do no harm.
    """
    keys = {"_id": F.col("doc_id").cast("long"), "_lang": F.col("lang").cast("string"), "_source": F.col("source").cast("string"), "_digest": F.xxhash64(F.col("text").cast("string"))}
    kept = outliers(documents, **settings).where("kept").select(F.col("doc_id").alias("k_id"), F.col("lang").alias("k_lang"), F.col("source").alias("k_source"), F.col("digest").alias("k_digest")).distinct()
    packed = documents.select(F.struct("*").alias("document"), *[value.alias(name) for name, value in keys.items()])
    condition = F.col("_digest") == F.col("k_digest")
    for name in ("id", "lang", "source"):
        condition = condition & F.col(f"_{name}").eqNullSafe(F.col(f"k_{name}"))
    return packed.join(kept, condition, "left_semi").select("document.*")

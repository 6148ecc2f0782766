"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks; every query block meets every candidate block once (a stated query set against all rows,
in blocks). A tile multiplies int8 codes. With v = code * step + rest, the true inner product differs from the tile's
value by at most |q_code| |c_rest| + |q_rest| |c| (Cauchy and Schwarz), so a pair is dropped only if at least ``k``
other candidates of its tile are certainly nearer. Survivors are recomputed in double precision from the original vectors,
component by component in order. The best of each tile are merged per query by a heap; nothing is lost, recall is 1.

Scale. A block is a row with one binary of some megabytes at most. Candidate blocks are copied to as many keys as there
are query blocks and meet them in an equi-join on (query block, lane); there are so many lanes that about ``STRIPE``
candidate blocks share one. What leaves a tile is ``k`` rows per query.

Defined cases. Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without id, which a result could not name. Vectors of different length never meet. Rows that share an id are rows of their
own: each is a candidate of the others, and each is a query where its id is. Ties go to the smaller id; with fewer than ``k``
candidates all are returned. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.session import durable

BLOCK_ROWS = 4096
STRIPE = 16  # candidate blocks that meet a query block in one task, about
MOST_KEYS = 1_000_000  # query blocks, 12 bytes each, up to which their list is broadcast; beyond that it is shuffled
CODE_LIMIT = 127


def usable(vectors: DataFrame) -> DataFrame:
    """row, vec_id, embedding as doubles: the vectors that can be compared, each with a number of its own."""
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        kept.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0.0))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    )


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of at most BLOCK_ROWS vectors of one length: dim, and row numbers, ids and vectors as binaries."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[int], list[np.ndarray]]] = {}
        for batch in batches:
            vectors = batch.column("embedding")
            flat, ends = vectors.flatten().to_numpy(), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            for i, (row, vec_id) in enumerate(zip(batch.column("row").to_pylist(), batch.column("vec_id").to_pylist())):
                vector = flat[ends[i] : ends[i + 1]]
                numbers, ids, many = held.setdefault(len(vector), ([], [], []))
                numbers.append(row)
                ids.append(vec_id)
                many.append(vector)
                if len(ids) == BLOCK_ROWS:
                    yield as_batch(len(vector), *held.pop(len(vector)))
        for dim, block in held.items():
            yield as_batch(dim, *block)

    def as_batch(dim: int, numbers: list[int], ids: list[int], many: list[np.ndarray]) -> pa.RecordBatch:
        whole = {name: pa.array([np.array(values, dtype=np.int64).tobytes()], pa.binary()) for name, values in (("numbers", numbers), ("ids", ids))}
        return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), **whole, "vectors": pa.array([np.array(many, dtype=np.float64).tobytes()], pa.binary())})

    return rows.mapInArrow(pack, "dim int, numbers binary, ids binary, vectors binary")


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, step per row, and the lengths of the coded and the remaining part of each row."""
    step = np.abs(vectors).max(axis=1) / CODE_LIMIT
    step[step == 0] = np.finfo(float).tiny
    code = np.rint(vectors / step[:, None]).astype(np.int8)
    coded = code * step[:, None]
    grown = 1 + 1e-9  # covers rounding in the bound itself
    return code, step, np.linalg.norm(coded, axis=1) * grown, np.linalg.norm(vectors - coded, axis=1) * grown + np.finfo(float).tiny


def tile(q_numbers: np.ndarray, q: np.ndarray, c_numbers: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest candidates of a tile for each query: query index, candidate id, score."""
    q_code, q_step, q_len, q_rest = codes(q)
    c_code, c_step, c_len, c_rest = codes(c)
    # products of int8 codes are whole numbers below 2^24 for up to 1,040 components, exact in float32; beyond that in double
    wide = np.float32 if q.shape[1] * CODE_LIMIT**2 < 2**24 else np.float64
    about = (q_code.astype(wide) @ c_code.astype(wide).T) * (q_step[:, None] * c_step[None, :])
    slack = q_len[:, None] * c_rest[None, :] + q_rest[:, None] * (c_len + c_rest)[None, :]
    slack += 1e-12 * np.abs(about)
    own = q_numbers[:, None] == c_numbers[None, :]
    low = np.where(own, -np.inf, about - slack)
    k_here = min(k, len(c_ids))
    least = np.partition(low, len(c_ids) - k_here, axis=1)[:, len(c_ids) - k_here]
    qi, ci = np.nonzero((about + slack >= least[:, None]) & ~own)
    score = np.zeros(len(qi))
    for d in range(q.shape[1]):
        score += q[qi, d] * c[ci, d]
    order = np.lexsort((c_ids[ci], -score, qi))
    qi, ci, score = qi[order], ci[order], score[order]
    first = np.searchsorted(qi, np.arange(len(q_numbers)))
    best = np.arange(len(qi)) - first[qi] < k
    return qi[best], c_ids[ci[best]], score[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` candidates of largest inner product for every row where ``is_query``."""
    rows = durable(usable(vectors))
    candidates = durable(packed(rows).withColumn("stripe", F.monotonically_increasing_id()))
    queries = durable(packed(rows.where(is_query)).withColumn("q_block", F.monotonically_increasing_id()))
    keys = queries.select("dim", "q_block")
    if queries.count() <= MOST_KEYS:
        keys = F.broadcast(keys)
    lanes = 1 + candidates.count() // STRIPE
    left = candidates.select("dim", F.pmod(F.xxhash64("stripe"), F.lit(lanes)).alias("lane"), F.col("numbers").alias("c_numbers"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors")).join(keys, "dim")
    right = queries.select("q_block", F.explode(F.expr(f"sequence(0L, {lanes - 1}L)")).alias("lane"), F.col("numbers").alias("q_numbers"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    tiles = left.join(right, ["q_block", "lane"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_numbers, q_ids, c_numbers, c_ids = (np.frombuffer(row[name], np.int64) for name in ("q_numbers", "q_ids", "c_numbers", "c_ids"))
                q = np.frombuffer(row["q_vectors"]).reshape(len(q_ids), -1)
                c = np.frombuffer(row["c_vectors"]).reshape(len(c_ids), -1)
                for at in range(0, len(q_ids), 512):
                    qi, ids, score = tile(q_numbers[at : at + 512], q[at : at + 512], c_numbers, c_ids, c, k)
                    yield pa.RecordBatch.from_pydict({"number": pa.array(q_numbers[at + qi]), "query_id": pa.array(q_ids[at + qi]), "vec_id": pa.array(ids), "score": pa.array(score)})

    found = tiles.select("q_numbers", "q_ids", "q_vectors", "c_numbers", "c_ids", "c_vectors").mapInArrow(multiply, "number long, query_id long, vec_id long, score double")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip(-frame["score"], frame["vec_id"]))
        return pd.DataFrame({"query_id": frame["query_id"].iloc[0], "rank": np.arange(1, len(best) + 1, dtype=np.int32), "vec_id": [b[1] for b in best], "score": [-b[0] for b in best]})

    return found.groupBy("number").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")

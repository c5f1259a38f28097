"""Approximate nearest neighbours by randomly rotated one-bit codes, largest cosine first.

A unit vector is rotated by a fixed random orthogonal matrix and kept as its sign bits and one correction
scalar, the inner product of the vector with its own sign pattern. The inner product with a query follows
from popcounts of the packed bits against the bit planes of the quantised query; the scalar also bounds
the error. Rows are reranked by exact cosine as long as their upper bound reaches the exact score of the
k-th best so far, so the bound (``sigmas``), not a fixed count, chooses them.

Vectors that are null, zero, or hold null or non-finite components take no part; vectors are compared
with those of the same length only. Rows without an id take no part either. Rows with the query's id are
its own row and no candidates; equal (id, vector) rows count once. Fewer candidates than ``k`` give fewer
rows, an empty table none. Further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import cells, common

SEED = 7
QUERY_BITS = 6
# Standard deviations of the estimate that the bound allows for.
SIGMAS = 3.0
FIRST_LOOK = 32
GROUP_ROWS = 16_384
BLOCK_ROWS = 512

FOUND = "query_row long, query_id long, vec_id long, score double"


@functools.cache
def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def cosine(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine in double precision, summed component by component, so equal rows score equally."""
    dot, own, other = np.zeros(len(rows)), np.zeros(len(rows)), 0.0
    for j in range(rows.shape[1]):
        dot += rows[:, j] * query[j]
        own += rows[:, j] * rows[:, j]
        other += query[j] * query[j]
    return np.clip(dot / np.sqrt(own * other), -1.0, 1.0)


def sign_words(rotated: np.ndarray) -> np.ndarray:
    """Sign bits packed into 64-bit words, row by row."""
    packed = np.packbits(rotated > 0, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def _unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / largest
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def index(vectors: DataFrame, seed: int = SEED) -> DataFrame:
    """Distinct usable (vec_id, vector) rows with their code and correction scalar."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, scalars = [b""] * batch.num_rows, np.zeros(batch.num_rows)
            for at, rows in cells.matrix(pa.chunked_array([batch.column(1)])):
                rotated = _unit(rows) @ rotation(rows.shape[1], seed)
                scalars[at] = np.abs(rotated).sum(axis=1) / np.sqrt(rows.shape[1])
                for i, words in zip(at.tolist(), sign_words(rotated)):
                    codes[i] = words.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(scalars)], names=["vec_id", "vector", "code", "scalar"]
            )

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    usable_rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()
    return usable_rows.mapInArrow(run, "vec_id long, vector array<double>, code binary, scalar double")


def estimates(
    words: np.ndarray, scalars: np.ndarray, query: np.ndarray, sigmas: float = SIGMAS, bits: int = QUERY_BITS
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded unit vectors with a rotated unit query, and their error bounds."""
    size = len(query)
    low = query.min()
    width = (query.max() - low) / (2**bits - 1) or 1.0
    steps = np.rint((query - low) / width).astype(np.int64)
    total = np.zeros(len(words), np.int64)
    for b in range(bits):
        plane = sign_words((steps >> b & 1)[None, :])[0]
        total += np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64) << b
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    rounded = low + width * steps
    signed = (2 * (width * total + low * ones) - rounded.sum()) / np.sqrt(size)
    quantised = np.abs(query - rounded).sum() / np.sqrt(size)
    spread = np.sqrt(np.maximum(0.0, 1 - scalars**2) / max(1, size - 1))
    return signed / scalars, (sigmas * spread + quantised) / scalars


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    sigmas: float = SIGMAS,
    seed: int = SEED,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest found rows of each row that ``queries`` selects: query_id, rank, vec_id, score."""

    def step(group: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if group.num_rows and block.num_rows:
            ids = group.column("vec_id").to_numpy()
            scalars = group.column("scalar").to_numpy()
            codes = group.column("code").to_pylist()
            query_ids, query_rows = block.column("vec_id").to_numpy(), block.column("row").to_numpy()
            of_size = {rows.shape[1]: (at, rows) for at, rows in cells.matrix(group.column("vector"))}
            for asked, wanted in cells.matrix(block.column("vector")):
                size = wanted.shape[1]
                if size not in of_size:
                    continue
                at, rows = of_size[size]
                words = np.frombuffer(b"".join(codes[i] for i in at.tolist()), np.uint64).reshape(len(at), -1)
                turned = _unit(wanted) @ rotation(size, seed)
                for i, query, line in zip(asked.tolist(), wanted, turned):
                    guess, bound = estimates(words, scalars[at], line, sigmas)
                    open_ = ids[at] != query_ids[i]
                    guess = np.where(open_, guess, -np.inf)
                    first = np.argpartition(-guess, min(FIRST_LOOK, len(at)) - 1)[:FIRST_LOOK]
                    first = first[open_[first]]
                    if not len(first):
                        continue
                    exact = np.sort(cosine(rows[first], query))
                    least = exact[-k] if len(exact) >= k else -np.inf
                    chosen = np.flatnonzero(open_ & (guess + bound >= least))
                    chosen = np.union1d(chosen, first)
                    scores = cosine(rows[chosen], query)
                    for j in np.lexsort((ids[at[chosen]], -scores))[:k].tolist():
                        out.append((query_rows[i], query_ids[i], ids[at[chosen[j]]], scores[j]))
        columns = list(zip(*out)) or [()] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            [pa.array(np.array(c), t) if len(c) else pa.array([], t) for c, t in zip(columns, types)],
            names=["query_row", "query_id", "vec_id", "score"],
        )

    rows = cells.numbered(common.keep(index(vectors, seed)))
    asked = rows.where(queries).select("row", "vec_id", "vector")
    found = cells.meet(rows.select("vec_id", "vector", "code", "scalar", "row"), asked, step, FOUND, group_rows, block_rows)
    return cells.best(found, [F.desc("score"), "vec_id"], k).select("query_id", "rank", "vec_id", "score")

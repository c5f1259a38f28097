"""Exact top-k by Hamming distance: incremental multi-index hashing of binary codes.

A code of ``b`` bits is cut into ``m`` segments, each with an index from segment value to rows. A query
looks up all segment values within a radius of its own, one segment after the other, and verifies whole
codes by popcount. After radius ``r`` in the first ``a + 1`` segments every code within ``m * r + a`` bits
has been met; the search ends once the k-th verified distance is covered by that, ties included. So the
result is exact whatever the data.

Codes are sign bits of vectors. Vectors that are null or hold null or non-finite components have no code
and take no part, nor do rows without an id; codes are compared with those of the same length only. Rows
with the query's id are its own row and no candidates; equal (id, code) rows count once. Fewer candidates
than ``k`` give fewer rows, an empty table none. Further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import cells, common

SEGMENT_BITS = 16
GROUP_ROWS = 65_536
BLOCK_ROWS = 256

FOUND = "query_row long, query_id long, vec_id long, distance int"


def sign_codes(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, bits, code): a bit for every component, set where it is above zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, bits = [b""] * batch.num_rows, np.zeros(batch.num_rows, np.int32)
            for at, rows in cells.matrix(pa.chunked_array([batch.column(1)])):
                bits[at] = rows.shape[1]
                for i, packed in zip(at.tolist(), np.packbits(rows > 0, axis=1, bitorder="little")):
                    codes[i] = packed.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits), pa.array(codes, pa.binary())], names=["vec_id", "bits", "code"]
            )

    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    return usable.mapInArrow(run, "vec_id long, bits int, code binary").distinct()


@functools.cache
def flips(width: int, radius: int) -> np.ndarray:
    """Masks of ``width`` bits with exactly ``radius`` bits set."""
    return np.array([sum(1 << i for i in c) for c in combinations(range(width), radius)], np.int64)


class SegmentIndex:
    """Codes of one length with an index from every segment's value to the rows that hold it."""

    def __init__(self, codes: np.ndarray, bits: int, segment_bits: int = SEGMENT_BITS):
        parts = max(1, round(bits / segment_bits))
        cuts = np.linspace(0, bits, parts + 1).round().astype(int).tolist()
        self.segments = list(zip(cuts, cuts[1:]))
        self.codes = codes
        self.words = _words(codes)
        self.tables = []
        for a, b in self.segments:
            values = self.values(codes, a, b)
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << (b - a)) + 1))
            self.tables.append((order, starts))

    @staticmethod
    def values(codes: np.ndarray, first: int, end: int) -> np.ndarray:
        bits = np.unpackbits(codes, axis=1, bitorder="little")[:, first:end].astype(np.int64)
        return bits @ (1 << np.arange(end - first))

    def nearest(self, query: np.ndarray, k: int, barred: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the ``k`` nearest rows that are not barred, ties by ``order``."""
        own = [int(self.values(query[None, :], a, b)[0]) for a, b in self.segments]
        word = _words(query[None, :])[0]
        met = barred.copy()
        near, far = np.empty(0, np.int64), np.empty(0, np.int64)
        parts = len(self.segments)
        for radius in range(max(b - a for a, b in self.segments) + 1):
            for a, ((first, end), (rows, starts)) in enumerate(zip(self.segments, self.tables)):
                if radius <= end - first:
                    probes = own[a] ^ flips(end - first, radius)
                    lows, counts = starts[probes], starts[probes + 1] - starts[probes]
                    lows, counts = lows[counts > 0], counts[counts > 0]
                    ends = np.cumsum(counts)
                    hits = rows[np.repeat(lows - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
                    hits = hits[~met[hits]]
                    met[hits] = True
                    if len(hits):
                        distance = np.bitwise_count(self.words[hits] ^ word).sum(axis=1, dtype=np.int64)
                        near, far = np.append(near, hits), np.append(far, distance)
                        best = np.lexsort((order[near], far))[:k]
                        near, far = near[best], far[best]
                if len(near) == k and far[-1] <= parts * radius + a:
                    return near, far
        return near, far


def _words(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 8)))).view(np.uint64)


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    segment_bits: int = SEGMENT_BITS,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest codes of each row that ``queries`` selects: query_id, rank, vec_id, distance."""

    def codes_of(table: pa.Table, at: np.ndarray) -> np.ndarray:
        codes = table.column("code").to_pylist()
        return np.frombuffer(b"".join(codes[i] for i in at.tolist()), np.uint8).reshape(len(at), -1)

    def step(group: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        sizes, wanted = (t.column("bits").to_numpy() for t in (group, block))
        for bits in np.intersect1d(sizes, wanted).tolist():
            at, asked = np.flatnonzero(sizes == bits), np.flatnonzero(wanted == bits)
            made = SegmentIndex(codes_of(group, at), bits, segment_bits)
            ids = group.column("vec_id").to_numpy()[at]
            for i, code in zip(asked.tolist(), codes_of(block, asked)):
                query_id, row = block.column("vec_id")[i].as_py(), block.column("row")[i].as_py()
                for j, distance in zip(*made.nearest(code, k, ids == query_id, ids)):
                    out.append((row, query_id, int(ids[j]), int(distance)))
        columns = list(zip(*out)) or [()] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
        names = ["query_row", "query_id", "vec_id", "distance"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    rows = cells.numbered(common.keep(sign_codes(vectors)))
    found = cells.meet(rows, rows.where(queries), step, FOUND, group_rows, block_rows)
    return cells.best(found, ["distance", "vec_id"], k).select("query_id", "rank", "vec_id", "distance")

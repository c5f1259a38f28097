"""Hard negatives by lists that the anchors of a cluster share, exact.

Anchors are clustered by direction. For a cluster with centroid c, whose members are within an angle b of
it, no member a scores a candidate x above |a| |x| cos(max(0, angle(x, c) - b)). Candidates are sorted once
per cluster by this bound; every member walks that one list from the top until the bound of what is left
shows that nothing more can enter its result. The walk is done twice: for an anchor's positives (highest
scores of its own label), and then, for each positive, for the negatives (other labels) whose score lies
between two shares of the positive's.

Anchors meet all rows in blocks of ``BLOCK_ANCHORS``; a block, its clusters and its positives are all that
is sent to tasks, and a task holds ``GROUP_ROWS`` candidates at a time. Its results go on from group to
group; what it found is merged per anchor.

Components are scaled and rounded down to whole numbers, scores are whole. Rows with a null id, a null
label, a null vector, or a null component or one that is not finite once scaled take no part, nor do empty
vectors; vectors meet those of the same length only. Rows with the anchor's id are its own and no
candidates; equal rows count once, and rows of one id that differ are anchors and candidates of their own.
Ties go to the smaller id. Fewer candidates give fewer rows, an empty table none. Further columns are
ignored. A score that a long does not hold is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from aerolake.llm import cells, common
from aerolake.llm.blocks import Best, blocks

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
BLOCK_ANCHORS = 4096
BLOCK_BYTES = 8 << 20
GROUP_ROWS = 16_384
# Candidates of a list between two looks at who has finished.
STEP = 1024
ROUNDS = 8
# What a bound gives away to rounding: of an angle, and of a length.
ANGLE_SLACK, SLACK = 1e-7, 1e-9

FOUND = "search long, score long, vec_id long"


def usable_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """Distinct (vec_id, label, parts) of the rows that take part; parts are whole numbers, as doubles."""
    parts = F.transform(F.col("vector").cast("array<double>"), lambda x: x * float(scale))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), parts.alias("parts"))
    finite = F.forall("parts", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    whole = F.transform("parts", lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0) + 0.0)
    kept = rows.where("vec_id is not null and label is not null and parts is not null and size(parts) > 0").where(finite)
    return kept.withColumn("parts", whole).distinct()


def lengths(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths that neither overflow nor vanish."""
    top = np.abs(rows).max(axis=1)
    scaled = rows / np.where(top == 0, 1, top)[:, None]
    return top * np.sqrt((scaled * scaled).sum(axis=1))


def units(rows: np.ndarray) -> np.ndarray:
    """Directions; a zero vector has none and stays zero."""
    top = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / np.where(top == 0, 1, top)
    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(size == 0, 1, size)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers: in doubles where these hold them exactly, else in Python's."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2**53:
        return (left @ right.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.array(whole(left) @ whole(right).T, object).astype(np.int64)


@dataclass
class Cluster:
    """Anchors that share a list: places in the block, their vectors, the centroid and its widest angle."""

    members: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray
    centroid: np.ndarray
    width: float


def clusters(at: np.ndarray, rows: np.ndarray, rounds: int = ROUNDS) -> list[Cluster]:
    """Spherical k-means of anchors of one length, about the square root of their number of clusters."""
    unit = units(rows)
    centres = unit[np.linspace(0, len(rows) - 1, math.ceil(math.sqrt(len(rows)))).astype(int)]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        centres = np.where(np.abs(sums).max(axis=1, keepdims=True) > 0, units(sums), centres)
    nearest = (unit @ centres.T).argmax(axis=1)
    made = []
    for c in np.unique(nearest):
        own = np.flatnonzero(nearest == c)
        widest = float(np.arccos(np.clip(unit[own] @ centres[c], -1, 1)).max())
        made.append(Cluster(at[own], rows[own], lengths(rows[own]), centres[c], widest))
    return made


@dataclass
class Block:
    """A block of anchors and what each searches for: scores of ``low`` to ``high``, own label or others."""

    ids: np.ndarray
    labels: np.ndarray
    parts: list[list[float]]
    clusters: dict[int, list[Cluster]]
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int

    @classmethod
    def of(cls, rows: list[Row], k: int) -> Block:
        """Anchors that search their positives."""
        ids, labels = (np.array([r[c] for r in rows], np.int64) for c in ("vec_id", "label"))
        parts = [r["parts"] for r in rows]
        sizes = np.array([len(p) for p in parts])
        made = {}
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            made[size] = clusters(at, np.array([parts[i] for i in at], np.float64))
        least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        every = np.arange(len(rows))
        return cls(ids, labels, parts, made, every, np.full(len(rows), least), np.full(len(rows), most), True, k)

    def against(self, anchor: np.ndarray, score: np.ndarray, low: int, high: int, k: int) -> Block:
        """The same anchors, searching other labels between two hundredths of the scores of their positives."""
        least = np.array([-(-low * s // 100) for s in score.tolist()], np.int64)
        most = np.array([high * s // 100 for s in score.tolist()], np.int64)
        return Block(self.ids, self.labels, self.parts, self.clusters, anchor, least, most, False, k)


class Walk:
    """The searches of a block over groups of candidates."""

    def __init__(self, block: Block):
        self.block = block
        self.best = Best(len(block.anchor), block.k)
        self.met = 0

    def group(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        size, unit = lengths(rows), units(rows)
        for cluster in self.block.clusters.get(rows.shape[1], ()):
            apart = np.arccos(np.clip(unit @ cluster.centroid, -1, 1)) - cluster.width - ANGLE_SLACK
            bound = size * np.cos(np.maximum(0, apart)) + SLACK * size
            order = np.argsort(-bound, kind="stable")
            self.list(cluster, ids[order], labels[order], rows[order], bound[order])

    def list(self, cluster: Cluster, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, bound: np.ndarray) -> None:
        block, best = self.block, self.best
        # The searches of this cluster, and the place of each one's anchor among the members.
        place = np.full(len(block.ids), -1)
        place[cluster.members] = np.arange(len(cluster.members))
        open_ = np.flatnonzero((place[block.anchor] >= 0) & (block.low <= block.high))
        for at in range(0, len(ids), STEP):
            # Nothing left on the list scores a member above this.
            top = cluster.lengths[place[block.anchor[open_]]] * bound[at]
            open_ = open_[(top >= best.least[open_]) & (top >= block.low[open_])]
            if not len(open_):
                return
            members, of = np.unique(place[block.anchor[open_]], return_inverse=True)
            step = slice(at, at + STEP)
            scores = products(cluster.rows[members], rows[step])
            self.met += scores.size
            own = cluster.members[members]
            fits = (labels[step][None, :] == block.labels[own][:, None]) == block.same
            fits &= ids[step][None, :] != block.ids[own][:, None]
            mine = scores[of]
            hit = fits[of] & (mine >= best.least[open_][:, None])
            if not block.same:
                hit &= (mine >= block.low[open_][:, None]) & (mine <= block.high[open_][:, None])
            i, j = np.nonzero(hit)
            if len(i):
                best.add(open_[i], mine[i, j], ids[step][j])


def walked(rows: DataFrame, block: Block, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(search, score, vec_id): the best of every task."""
    held = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(held.value)

        def group(parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts)
            ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
            for at, matrix in cells.matrix(table.column("parts")):
                walk.group(ids[at], labels[at], matrix)

        parts: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for at in range(0, batch.num_rows, group_rows):
                parts.append(batch.slice(at, group_rows))
                count += parts[-1].num_rows
                if count >= group_rows:
                    group(parts)
                    parts, count = [], 0
        if parts:
            group(parts)
        if walk.best.waiting:
            walk.best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in walk.best.kept], names=["search", "score", "vec_id"])

    rank = F.row_number().over(Window.partitionBy("search").orderBy(F.desc("score"), "vec_id"))
    found = rows.select("vec_id", "label", "parts").mapInArrow(run, FOUND)
    return found.withColumn("rank", rank).where(F.col("rank") <= block.k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block_anchors: int = BLOCK_ANCHORS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``anchors`` selects."""
    spark = vectors.sparkSession
    rows = common.keep(usable_rows(vectors, scale))
    made = []
    for stated in blocks(rows.where(anchors), block_anchors, F.size("parts") * 8, BLOCK_BYTES):
        block = Block.of(stated, positives)
        # At most ``positives`` rows for each anchor of the block.
        found = walked(rows, block, group_rows).orderBy("search", "rank").collect()
        if not found:
            continue
        anchor, score = (np.array([r[c] for r in found], np.int64) for c in ("search", "score"))
        best = walked(rows, block.against(anchor, score, low, high, negatives), group_rows)
        of = spark.createDataFrame(
            [(i, int(block.ids[r["search"]]), r["vec_id"], r["score"]) for i, r in enumerate(found)],
            "search long, anchor_id long, positive_id long, positive_score long",
        )
        named = best.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(F.broadcast(of), "search")
        made.append(named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    out = made[0] if made else spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    for more in made[1:]:
        out = out.unionByName(more)
    return out

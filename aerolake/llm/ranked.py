"""Ranked lexical search by two trees, exact.

Every document is a vector over the items' terms (a saturated term frequency), every item one of term
weights; a score is their inner product, in whole numbers. Both sides stand in hierarchies whose nodes hold
the largest value of each coordinate. The inner product of an item node and a document node bounds every
score between them; where it is below the weakest k-th score of the node's items, the whole batch is left
out. A task walks a block of its documents at a time, best branches first, and keeps its k-th scores from
block to block; what it found is merged per item.

Items meet all documents in blocks of ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes of text; a block, its
terms and their counts are all that is sent to tasks. Two passes over the texts, nothing is stored or moved
but counts and the k best of each task.

Null texts have no terms; documents without terms, and those without a doc_id, are never found, but the
latter count in the statistics. Equal documents are documents of their own. An item is a distinct
(item_id, text); items without terms find nothing, and so does an empty table. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from aerolake.llm import common
from aerolake.llm.blocks import Best, blocks

K = 50
BLOCK_ITEMS = 512
BLOCK_BYTES = 1 << 20
# Documents of a hierarchy; bounds its memory where texts are short.
TREE_ROWS = 4096
LEAF = 32
FAN = 8
# Item nodes that a document is placed by.
PLACES = 32

# ASCII but letters and digits separates terms; only A-Z are lowered.
_TABLE = bytes((c | 0x20 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Items:
    """A block of items: their ids, terms by column, and weights once the counts are known."""

    ids: list[int]
    columns: list[np.ndarray]
    vocabulary: dict[bytes, int]
    documents: int = 0
    total: int = 0
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[Row]) -> Items:
        vocabulary: dict[bytes, int] = {}
        ids, columns = [], []
        for row in rows:
            own = {vocabulary.setdefault(t, len(vocabulary)) for t in terms((row["text"] or "").encode())}
            ids.append(row["item_id"])
            columns.append(np.array(sorted(own), np.int64))
        return cls(ids, columns, vocabulary)

    def weigh(self, counts: dict[int, int]) -> None:
        self.documents, self.total = counts.get(-1, 0), counts.get(-2, 0)
        top = 2 * self.documents + 2
        self.weights = np.array(
            [math.floor(1000 * math.log(top / (2 * counts.get(c, 0) + 1))) for c in range(len(self.vocabulary))], np.int64
        )

    def matrix(self) -> np.ndarray:
        """Items by terms; doubles hold every score exactly unless an item has very many terms."""
        most = max((int(self.weights[c].sum()) for c in self.columns), default=0) * 10**6
        made = np.zeros((len(self.ids), len(self.vocabulary)), np.float64 if most < 2**53 else np.int64)
        for i, columns in enumerate(self.columns):
            made[i, columns] = self.weights[columns]
        return made


def counted(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (text, column, times) of the vocabulary's terms in them, text by text."""
    split = [terms(t) for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    get, width = vocabulary.get, max(1, len(vocabulary))
    found = np.concatenate([np.fromiter(map(get, s, repeat(-1)), np.int64, len(s)) for s in split])
    places = (np.repeat(np.arange(len(split)), sizes) * width + found)[found >= 0]
    places, times = np.unique(places, return_counts=True)
    return sizes, places // width, places % width, times


def statistics(docs: DataFrame, items: Items) -> dict[int, int]:
    """Documents that hold each column's term; at -1 documents with a term, at -2 the terms of all."""
    held = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        holding, with_terms, total = np.zeros(len(vocabulary), np.int64), 0, 0

        def step(block: pa.RecordBatch) -> None:
            nonlocal with_terms, total
            sizes, _, columns, _ = counted(block.column("text").cast(pa.binary()).to_pylist(), vocabulary)
            holding[:] += np.bincount(columns, minlength=len(vocabulary))
            with_terms += int((sizes > 0).sum())
            total += int(sizes.sum())

        yield from common.by_block("text", step)(batches)
        at = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at.tolist(), -1, -2]), pa.array([*holding[at].tolist(), with_terms, total])], names=["term", "held"]
        )

    rows = docs.select(common.text_or_empty().alias("text"))
    sums = rows.mapInArrow(run, "term long, held long").groupBy("term").agg(F.sum("held").alias("held"))
    return {r["term"]: r["held"] for r in sums.collect()}


# --- hierarchies -----------------------------------------------------------------------------


def levels(leaves: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of nodes, leaves first; node ``i`` of a level covers ``FAN`` nodes below."""
    made = [leaves]
    while len(made[-1]) > 1:
        made.append(np.maximum.reduceat(made[-1], np.arange(0, len(made[-1]), FAN), axis=0))
    return made


def arranged(vectors: np.ndarray) -> np.ndarray:
    """An order of items in which like ones are neighbours: halves by the nearer of two distant items."""
    size = np.sqrt((vectors.astype(float) ** 2).sum(axis=1, keepdims=True))
    unit = vectors / np.where(size == 0, 1, size)
    alike = unit @ unit.T

    def part(at: np.ndarray) -> list[int]:
        if len(at) <= FAN:
            return at.tolist()
        one = at[np.argmin(alike[at[0], at])]
        two = at[np.argmin(alike[one, at])]
        at = at[np.argsort(alike[two, at] - alike[one, at], kind="stable")]
        return part(at[: len(at) // 2]) + part(at[len(at) // 2 :])

    return np.array(part(np.arange(len(vectors))), np.int64)


class DualTree:
    """Items in their hierarchy, with the best documents met so far."""

    def __init__(self, items: Items, k: int = K):
        rows = items.matrix()
        order = arranged(rows)
        self.items, self.ids = items, [items.ids[i] for i in order]
        self.levels = levels(rows[order])
        self.best = Best(len(order), k)
        place = next((x for x in self.levels if len(x) <= PLACES), self.levels[-1])
        self.place = place.astype(float).T.copy()
        self.met = self.scored = 0
        self.weaken()

    def weaken(self) -> None:
        """The weakest k-th score below every item node; a score of zero never counts."""
        self.weakest = [np.maximum(self.best.least, 1)]
        for _ in self.levels[1:]:
            self.weakest.append(np.minimum.reduceat(self.weakest[-1], np.arange(0, len(self.weakest[-1]), FAN)))

    def walk(self, ids: np.ndarray, texts: list[bytes]) -> None:
        """Search a block of documents."""
        sizes, doc, column, times = counted(texts, self.items.vocabulary)
        if not len(doc):
            return
        length = 50 + 50 * sizes * self.items.documents // self.items.total
        value = 10**9 * times // (1000 * times + 20 * length[doc])

        # Documents that favour the same items, strongest first, become neighbours.
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        favour = np.stack([np.add.reduceat(value * one[column], first) for one in self.place.T], axis=1)
        favourite = favour.argmax(axis=1)
        order = np.lexsort((-favour.max(axis=1), favourite))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        spans = np.append(first, len(doc))

        dense = self.levels[0].dtype
        leaves = np.zeros((-(-len(order) // LEAF), len(self.items.vocabulary)), dense)
        np.maximum.at(leaves, (np.repeat(place, np.diff(spans)) // LEAF, column), value.astype(dense))
        nodes = levels(leaves)
        of_doc = ids[doc[first]]

        def leaf(number: int, items: np.ndarray) -> None:
            rows = order[number * LEAF : (number + 1) * LEAF]
            wanted = np.flatnonzero(self.levels[0][items].any(axis=0))
            at = np.concatenate([np.arange(spans[r], spans[r + 1]) for r in rows])
            whole = np.zeros((len(rows), leaves.shape[1]), dense)
            whole[np.repeat(np.arange(len(rows)), spans[rows + 1] - spans[rows]), column[at]] = value[at]
            scores = (self.levels[0][items][:, wanted] @ whole[:, wanted].T).astype(np.int64)
            self.scored += scores.size
            i, j = np.nonzero(scores >= self.weakest[0][items][:, None])
            if len(i) and self.best.add(items[i], scores[i, j], of_doc[rows[j]]):
                self.weaken()

        def below(tree: list[np.ndarray], level: int, held: np.ndarray) -> np.ndarray:
            children = (held[:, None] * FAN + np.arange(FAN)).ravel()
            return children[children < len(tree[level - 1])]

        def visit(item_level: int, items: np.ndarray, doc_level: int, docs: np.ndarray) -> None:
            """Bounds of all pairs of these nodes; what survives goes down in both trees."""
            self.met += len(items) * len(docs)
            bounds = nodes[doc_level][docs] @ self.levels[item_level][items].T
            for d in np.argsort(-bounds.max(axis=1), kind="stable"):
                left = items[bounds[d] >= self.weakest[item_level][items]]
                if not len(left):
                    continue
                if item_level:
                    next_items, next_level = below(self.levels, item_level, left), item_level - 1
                else:
                    next_items, next_level = left, 0
                if doc_level:
                    visit(next_level, next_items, doc_level - 1, below(nodes, doc_level, docs[d : d + 1]))
                elif item_level:
                    visit(next_level, next_items, 0, docs[d : d + 1])
                else:
                    leaf(int(docs[d]), left)

        visit(len(self.levels) - 1, np.zeros(1, np.int64), len(nodes) - 1, np.zeros(1, np.int64))


def found_in(docs: DataFrame, items: Items, k: int = K) -> DataFrame:
    """(item, item_id, doc_id, score): the best of every task."""
    held = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = DualTree(held.value, k)

        def step(block: pa.RecordBatch) -> None:
            for at in range(0, block.num_rows, TREE_ROWS):
                part = block.slice(at, TREE_ROWS)
                tree.walk(part.column("doc_id").to_numpy(), part.column("text").cast(pa.binary()).to_pylist())

        yield from common.by_block("text", step)(batches)
        tree.best.settle()
        item, score, doc = tree.best.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array([tree.ids[i] for i in item.tolist()], pa.int64()), pa.array(doc), pa.array(score)],
            names=["item", "item_id", "doc_id", "score"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item."""
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    stated = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for rows in blocks(stated, block_items, F.octet_length("text"), BLOCK_BYTES):
        block = Items.of(rows)
        counts = statistics(docs, block) if block.vocabulary else {}
        if counts.get(-2):
            block.weigh(counts)
            best = found_in(docs, block, k).withColumn("rank", rank).where(F.col("rank") <= k)
            out = out.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    return out

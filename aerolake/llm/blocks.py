"""Stated queries in blocks that a task can hold, and the best finds of many searches at once."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from aerolake.llm import cells, common


def blocks(stated: DataFrame, rows: int, size: Column, most: int) -> Iterator[list[Row]]:
    """The rows of a stated query set, about ``rows`` rows and ``most`` bytes at a time, in a fixed order.

    Each block goes to all tasks, which pass over their rows of the other side with it; so what is sent at
    once stays the same however many queries there are.
    """
    stored = cells.numbered(common.keep(stated))
    count, held = stored.agg(F.count("*"), F.sum(size.cast("long"))).first()
    parts = max(math.ceil(count / rows), math.ceil((held or 0) / most))
    for part in range(parts):
        block = stored.where(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).drop("row").collect()
        if block:
            yield sorted(block, key=str)


class Best:
    """The ``k`` best (score, id) of each of many searches: highest score, then smallest id."""

    def __init__(self, searches: int, k: int, hold: int = 4096):
        self.k, self.hold = k, hold
        self.kept: tuple[np.ndarray, ...] = tuple(np.empty(0, np.int64) for _ in range(3))
        self.new: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0
        # Least score that can still enter; known late, never too high.
        self.least = np.full(searches, np.iinfo(np.int64).min)

    def add(self, search: np.ndarray, score: np.ndarray, found: np.ndarray) -> bool:
        """Whether ``least`` may have moved."""
        self.new.append((search, score, found))
        self.waiting += len(search)
        if self.waiting >= self.hold:
            self.settle()
            return True
        return False

    def settle(self) -> None:
        search, score, found = (np.concatenate(x) for x in zip(self.kept, *self.new))
        order = np.lexsort((found, -score, search))
        search, score, found = search[order], score[order], found[order]
        starts = np.flatnonzero(np.diff(search, prepend=-1))
        rank = np.arange(len(search)) - np.repeat(starts, np.diff(starts, append=len(search)))
        self.least[search[rank == self.k - 1]] = score[rank == self.k - 1]
        within = rank < self.k
        self.kept = (search[within], score[within], found[within])
        self.new, self.waiting = [], 0

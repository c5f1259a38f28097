from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import common, negatives


def plain_mine(rows: list[tuple], every: int, k_pos: int = 5, k_neg: int = 10, low: int = 30, high: int = 90) -> Counter:
    """Positives and negatives of each anchor by looking at every row."""
    part = set()
    for vec_id, label, vector in rows:
        usable = vector and all(x is not None and math.isfinite(256 * x) for x in vector)
        if vec_id is not None and label is not None and usable:
            part.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    out: Counter = Counter()
    for anchor, label, own in part:
        if anchor % every:
            continue
        others = [r for r in part if r[0] != anchor and len(r[2]) == len(own)]
        scored = sorted((-sum(a * b for a, b in zip(own, x)), i, y) for i, y, x in others)
        for score, positive, _ in [s for s in scored if s[2] == label][:k_pos]:
            fit = [s for s in scored if s[2] != label and low * -score <= 100 * -s[0] <= high * -score]
            for rank, (found, negative, _) in enumerate(fit[:k_neg], 1):
                out[anchor, positive, rank, negative, -score, -found] += 1
    return out


def mined(vectors, every, **options) -> Counter:
    return Counter(tuple(r) for r in negatives.mine(vectors, F.col("vec_id") % every == 0, **options).collect())


@pytest.mark.parametrize("options", [{}, {"block_anchors": 3, "group_rows": 70}])
def test_given_embeddings(spark, options):
    given = common.read(spark, "/root/testdata/sf0.001", "embeddings")
    vectors = given.select("vec_id", "label", F.col("embedding").alias("vector"))
    rows = [(r.vec_id, r.label, r.vector) for r in vectors.collect()]
    found = mined(vectors.repartition(3), 50, **options)
    assert found == plain_mine(rows, 50)
    assert len(found) > 300


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [1.0, 0.4]), (1, 1, [2.0, 1.0]), (2, 1, [2.0, 1.0]),
        (3, 2, [1.0, 0.0]), (4, 2, [1.0, 0.0]), (4, 2, [0.5, 0.0]), (5, 3, [0.9, -0.1]), (6, 1, [-1.0, -0.5]),
        (7, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (8, 1, None), (9, 1, []), (11, 1, [nan, 1.0]), (12, 2, [inf, 1.0]),
        (13, 2, [None, 1.0]), (14, 2, [1e308, 1.0]), (10, 1, [0.0, 0.0]), (20, 1, [1.0, 0.5, 0.1]), (30, 4, [1.0, 0.0]),
        (-10, 1, [0.3, 0.2]),
    ]
    extra = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, vector array<double>, score int, parts string")
    found = mined(extra, 10)
    assert found == plain_mine(rows, 10) and found
    assert mined(extra.limit(0), 10) == Counter()


def test_components_that_doubles_do_not_multiply_exactly(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(i % 3), [float(x) for x in 2.0**rng.integers(15, 21, 4) + rng.random(4)]) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    assert mined(vectors, 10) == plain_mine(rows, 10)


def test_walks_end_early_where_the_bound_allows():
    """Tight clusters: a member's list ends long before the rows of other directions."""
    rng = np.random.default_rng(5)
    centres = negatives.units(rng.standard_normal((20, 32)))
    rows = np.floor(256 * negatives.units(centres[rng.integers(0, 20, 8000)] + 0.02 * rng.standard_normal((8000, 32))))
    labels, ids = rng.integers(0, 2, 8000), np.arange(8000)
    stated = [{"vec_id": i, "label": int(labels[i]), "parts": rows[i].tolist()} for i in range(0, 8000, 100)]
    walk = negatives.Walk(negatives.Block.of(stated, 5))
    walk.group(ids, labels, rows)
    walk.best.settle()
    assert walk.met < len(stated) * 8000 / 2
    search, score, found = walk.best.kept
    exact = rows[::100] @ rows.T
    for i in range(len(stated)):
        fit = np.flatnonzero((labels == labels[i * 100]) & (ids != i * 100))
        first = fit[np.lexsort((fit, -exact[i, fit]))][:5]
        assert found[search == i].tolist() == first.tolist()

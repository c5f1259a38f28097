"""A stated query set against all rows, in bounded blocks.

Rows are dealt over groups of about ``group_rows`` rows and queries over blocks of about ``block_rows``;
each group meets each block in one task that holds no more than the two. What it finds is merged per
query afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(stored: DataFrame) -> DataFrame:
    """Rows of a stored frame with a number each; stored rows keep their order, so numbers stay."""
    return stored.withColumn("row", F.monotonically_increasing_id())


def meet(
    rows: DataFrame,
    queries: DataFrame,
    step: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    group_rows: int,
    block_rows: int,
) -> DataFrame:
    """``step(group, block)`` for every pair; both sides carry a ``row`` number."""
    groups = max(1, math.ceil(rows.count() / group_rows))
    blocks = max(1, math.ceil(queries.count() / block_rows))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(parts))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        )

    left = dealt(rows, "_group", groups, "_block", blocks).groupBy("_group", "_block")
    right = dealt(queries, "_block", blocks, "_group", groups).groupBy("_group", "_block")
    return left.cogroup(right).applyInArrow(step, schema)


def best(found: DataFrame, order: Sequence, k: int) -> DataFrame:
    """The first ``k`` finds of every query row, numbered from 1."""
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def matrix(column: pa.ChunkedArray, dtype: type = np.float64) -> list[tuple[np.ndarray, np.ndarray]]:
    """List values as (positions, matrix) by list length."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0) if flat.num_chunks else pa.array([], flat.type)
    lengths = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    out = []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out.append((at, values[starts[at][:, None] + np.arange(n)].astype(dtype)))
    return out

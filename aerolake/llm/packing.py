"""Cost-balanced packing of tokenised documents into sequences of a fixed capacity.

A document's ids are cut into full sequences and one shorter rest. The attention cost of a piece is
estimated as ``linear * n + quadratic * n * n``. Pieces are dealt over groups of about ``group_pieces``
pieces; in a group they go, longest first, to the sequence of lowest cost that still has room, and to a
new one where none has. Only the pieces' numbers travel, not the texts or ids, unless ids are asked for.

Null texts count as empty: their one piece is the end id. Null doc_ids and repeated rows are packed as
rows of their own. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm import common, words

CAPACITY = 2048
END_ID = 1
LINEAR = 1.0
QUADRATIC = 1.0 / CAPACITY
GROUP_PIECES = 16_384
# Sequences that a group opens at once, as a share of its tokens' bare need; the last few open singly.
OPENED = 0.97

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """The pieces of every document: place, length, checksum and, if wanted, the ids themselves."""
    last = np.array([end_id], "<u4")

    def step(block: pa.RecordBatch) -> pa.RecordBatch:
        docs_of, starts, parts, totals = [], [], [], []
        for doc, made in zip(block.column("doc_id").to_pylist(), words.encode(block.column("text"), vocabulary)):
            whole = np.concatenate((made, last))
            for start in range(0, len(whole), capacity):
                docs_of.append(doc)
                starts.append(start)
                parts.append(whole[start : start + capacity])
                totals.append(len(whole))
        lengths = [len(p) for p in parts]
        columns = {
            "doc_id": pa.array(docs_of, pa.int64()),
            "start": pa.array(starts, pa.int64()),
            "length": pa.array(lengths, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            "doc_tokens": pa.array(totals, pa.int64()),
        }
        if ids:
            flat = np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32)
            columns["ids"] = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32), flat)
        return pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    return rows.mapInArrow(common.by_block("text", step), PIECE + ", ids array<int>" * ids)


def assign(
    lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; pieces come longest first."""
    opened = math.ceil(OPENED * lengths.sum() / capacity)
    room = np.zeros(opened + len(lengths), np.int64)
    room[:opened] = capacity
    cost = np.zeros(len(room))
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        open_cost = np.where(room[:opened] >= n, cost[:opened], np.inf)
        at = int(open_cost.argmin()) if opened else 0
        if not opened or open_cost[at] == np.inf:
            at, opened = opened, opened + 1
            room[at] = capacity
        sequence[i], offset[i] = at, capacity - room[at]
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n
    return sequence, offset


def pack(
    cut: DataFrame,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """The pieces with the sequence and the offset they are given."""
    stored = common.keep(cut)
    groups = max(1, math.ceil(stored.count() / group_pieces))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        sequence, offset = assign(rows["length"].to_numpy(), capacity, linear, quadratic)
        group = int(rows["group"].iloc[0])
        return rows.drop(columns="group").assign(sequence_id=sequence * groups + group, offset=offset)

    # Stored rows keep their order, so a row's number and with it its group never change.
    dealt = stored.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    schema = ", ".join(f"{n} {t}" for n, t in stored.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy("group").applyInPandas(one, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(pieces(docs, vocabulary, capacity, end_id), capacity)

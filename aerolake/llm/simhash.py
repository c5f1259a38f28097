"""SimHash near-duplicates: bit-sliced comparison inside equal-segment buckets, then components.

Two fingerprints within ``radius`` bits agree on two of ``radius + 2`` segments at least, so every link
is met in a bucket named by a pair of segments and their bits. A bucket stores its fingerprints as bit
planes: word ``w`` of plane ``p`` holds bit ``p`` of 64 fingerprints. Distances of a probe to all of them
grow plane by plane in carry-save counters, and a block of probes is abandoned once every distance in it
exceeds the radius. Exact copies collapse before any comparison; a bucket gives back a spanning forest
of its links, never the pairs; a bucket above ``bucket_rows`` is dealt out as cells, each pair of whose
slices meets once.

Null texts count as empty (fingerprint zero, linked like any other). A row without a doc_id gets the
component of its fingerprint; a component with no doc_id at all has a null id. Repeated rows give
repeated results. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aerolake.llm import common

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET_ROWS = 8192
# Rows that are compared together at least; small neighbouring buckets share a tile.
TILE_ROWS = 512
PROBES = 256
# Planes between two looks at which probes still have a lane within the radius.
LOOK_EVERY = 8
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ----------------------------------------------------------------------------


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the shingles' XXH64; bytes.lower and bytes.split know ASCII only, as wanted."""
    split = text.lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(split) > words:
        starts, ends = starts[: len(split) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts)
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and the fingerprint of its whole text, as a signed long."""
    return coded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words, seed)


def coded(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """The rows with the fingerprint of their text in place of the text."""
    others = [c for c in docs.columns if c != "text"]

    def step(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = block.column("text").cast(pa.binary()).to_pylist()
        codes = np.array([fingerprint(t, words, seed) for t in texts], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(block.column(c) for c in others), pa.array(codes)], names=[*others, "code"])

    rows = docs.select(*others, common.text_or_empty().alias("text"))
    schema = StructType([*(rows.schema[c] for c in others), StructField("code", LongType())])
    return rows.mapInArrow(common.by_block("text", step), schema)


# --- bit-sliced comparison -------------------------------------------------------------------


def planes_of(codes: np.ndarray) -> np.ndarray:
    """Bit planes, 64 x words; lanes beyond the last code are zero."""
    words = -(-len(codes) // BITS)
    bits = np.zeros((BITS, words * BITS), np.uint8)
    bits[:, : len(codes)] = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _add(counters: list[np.ndarray], over: np.ndarray, carry: np.ndarray, at: int) -> np.ndarray:
    """Add one-bit numbers to the counters from digit ``at`` on; what leaves the last digit is over."""
    for k in range(at, len(counters)):
        counters[k], carry = counters[k] ^ carry, counters[k] & carry
    return over | carry


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is larger than ``radius``: digit by digit from the highest."""
    larger, equal = np.zeros_like(over), np.full_like(over, ALL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            larger |= equal & counters[k]
            equal &= ~counters[k]
    return over | larger


def near(codes: np.ndarray, radius: int = RADIUS, probes: int = PROBES) -> Iterator[tuple[int, np.ndarray]]:
    """For each code that has any: the later codes of the block within ``radius`` bits."""
    count = len(codes)
    planes = planes_of(codes)
    lanes = np.arange(planes.shape[1] * BITS)
    digits = max(1, int(radius).bit_length())
    for first in range(0, count, probes):
        rows = np.arange(first, min(first + probes, count))
        low = first // BITS  # words of earlier lanes only are left out
        shut = (lanes[None, low * BITS :] <= rows[:, None]) | (lanes[None, low * BITS :] >= count)
        over = np.packbits(shut, axis=1, bitorder="little").view(np.uint64)
        counters = [np.zeros_like(over) for _ in range(digits)]
        own = codes[rows]
        for p in range(0, BITS, 2):
            x, y = (
                planes[q, None, low:] ^ np.where(own >> np.uint64(q) & np.uint64(1), ALL, np.uint64(0))[:, None]
                for q in (p, p + 1)
            )
            half = counters[0] ^ x
            carry = (counters[0] & x) | (half & y)
            counters[0] = half ^ y
            over = _add(counters, over, carry, 1)
            if (p + 2) % LOOK_EVERY == 0:
                beyond = _beyond(counters, over, radius)
                open_rows = (beyond != ALL).any(axis=1)
                if not open_rows.any():
                    rows = rows[:0]
                    break
                if not open_rows.all():
                    rows, own, over = rows[open_rows], own[open_rows], over[open_rows]
                    counters = [c[open_rows] for c in counters]
        if len(rows):
            found = np.unpackbits((~_beyond(counters, over, radius)).view(np.uint8), axis=1, bitorder="little")
            for row, lane in zip(rows.tolist(), found):
                hits = np.flatnonzero(lane)
                if len(hits):
                    yield row, hits + low * BITS


def forest(codes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the block's links: each linked code and the root of its tree."""
    parent = np.arange(len(codes))

    def roots(nodes: np.ndarray) -> np.ndarray:
        while True:
            up = parent[nodes]
            if (up == nodes).all():
                return nodes
            nodes = up

    for row, hits in near(codes, radius):
        tops = roots(np.append(hits, row))
        parent[tops] = tops.min()
    top = roots(np.arange(len(codes)))
    linked = np.flatnonzero(top != np.arange(len(codes)))
    return codes[linked], codes[top[linked]]


# --- candidate buckets -----------------------------------------------------------------------


def segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 2 segments that cover the code."""
    cuts = np.linspace(0, BITS, radius + 3).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(code: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def buckets(codes: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """(part, key, low, high, code): the bucket cells in which a code meets others.

    Buckets of one code are left out. One with more than ``bucket_rows`` is cut into slices by hash, and
    a code goes to the cells of its slice with every slice.
    """
    code = F.col("code")
    entries = [
        F.struct(
            F.lit(part).alias("part"),
            F.shiftleft(_bits(code, *a), b[1]).bitwiseOR(_bits(code, *b)).alias("key"),
        )
        for part, (a, b) in enumerate(combinations(segments(radius), 2))
    ]
    rows = codes.select("code", F.explode(F.array(*entries)).alias("at")).select("at.part", "at.key", "code")
    sizes = rows.groupBy("part", "key").agg(F.count("*").alias("held")).where("held > 1")
    slices = F.ceil(F.col("held") / F.lit(bucket_rows)).cast("int")
    own = F.pmod(F.xxhash64("code", "part"), slices.cast("long")).cast("int")
    met = rows.join(sizes, ["part", "key"]).withColumns({"own": own, "slices": slices})
    with_slice = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    return met.select("part", "key", "code", "own", with_slice).select(
        "part", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "code"
    )


def compare(cells: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links (code, root) of all cells; whole cells share tiles of ``TILE_ROWS`` or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if parts:
                made = forest(np.unique(np.concatenate(parts)), radius)
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in made], names=["code", "root"]
                    )

        parts: list[np.ndarray] = []
        held, last = 0, None
        for batch in batches:
            names = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            codes = batch.column(4).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(codes)]):
                if a == b:
                    continue
                if (name := tuple(names[a].tolist())) != last and held >= TILE_ROWS:
                    yield from tile(parts)
                    parts, held = [], 0
                last = name
                parts.append(codes[a:b])
                held += b - a
        yield from tile(parts)

    order = ["part", "key", "low", "high"]
    return (
        cells.repartition(*order)
        .sortWithinPartitions(*order)
        .select(*order, "code")
        .mapInArrow(run, "code long, root long")
    )


# --- components ------------------------------------------------------------------------------


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over links (a, b), for every node that has a link.

    Large-star and small-star rounds: every link is re-hung to the smallest neighbour until nothing
    moves. Rounds are cut by checkpoints; only a count and a checksum of the links reach the driver.
    """
    links = common.keep(
        links.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = state(links)
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
            .select(F.col("x.a").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links = common.keep(small)
        now = state(links)
        if now == seen:
            nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = now
    raise RuntimeError("components did not settle")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """doc_id, code, component_id (the smallest doc_id reachable over links) and root (the smallest such code) of every row."""
    rows = common.keep(fingerprints(docs, words, seed))
    classes = common.keep(rows.groupBy("code").agg(F.min("doc_id").alias("least")))
    roots = components(compare(buckets(classes.select("code"), radius, bucket_rows), radius))
    rooted = classes.join(roots, classes["code"] == roots["node"], "left").select(
        "code", "least", F.coalesce("root", "code").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_code = rooted.join(named, "root").select("code", "component_id", "root")
    return rows.join(of_code, "code").select("doc_id", "code", "component_id", "root")


def as_hex(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of ``groups`` (of the same rows, by ``near_duplicates``): the one with
    the least doc_id, then code, then row. Rows without doc_id are a side of their own: one stays for each component.
    """
    doc_id = F.col("doc_id").cast("long")
    rows_of = groups.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("copies"))
    least = groups.where("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "code")).alias("x"))
    heads = common.keep(least.select("x.*").join(rows_of, "doc_id"))
    single = heads.where("copies = 1").select(F.col("doc_id").alias("_head"))
    kept = docs.join(single, doc_id == F.col("_head"), "left_semi")
    whole = F.struct(*docs.columns).alias("row")
    often = heads.where("copies > 1").select("doc_id", "code")
    if not often.isEmpty():
        # The id alone does not tell which of its rows heads the component; their codes do.
        ids = often.select(F.col("doc_id").alias("_head")).distinct()
        met = docs.join(ids, doc_id == F.col("_head"), "left_semi").select(doc_id.alias("doc_id"), "text", whole)
        one = coded(met).join(often, ["doc_id", "code"], "left_semi").groupBy("doc_id", "code").agg(F.min("row").alias("row"))
        kept = kept.unionByName(one.select("row.*"))
    unnamed = common.keep(groups.where("doc_id is null").select("code", "root").distinct())
    if not unnamed.isEmpty():
        met = coded(docs.where("doc_id is null").select("text", whole)).groupBy("code").agg(F.min("row").alias("row"))
        one = met.join(unnamed, "code").groupBy("root").agg(F.min("row").alias("row"))
        kept = kept.unionByName(one.select("row.*"))
    return kept

"""N-gram Jaccard join by several global token orders, then components.

A text's tokens are its distinct word shingles. Under any one order of all tokens, two sets whose Jaccard
similarity reaches the threshold share a token among the first few of each (the prefix). So a candidate
pair must share one under every one of several orders; only pairs that pass all of them are verified by
their whole sets. Every order puts rare tokens first, by exact counts:

* the first ranks a fifth of all tokens, chosen by hash, by the number of sets that hold them, and the rest
  after these by hash. A prefix is a tenth of a set, so hardly more than that fifth is counted and moved;
* the second ranks all tokens of the sets that passed the first, by their counts among these;
* the third does so with ties, of which there are many, the other way round.

A set whose tokens of its own fill its prefix has no partner and is dropped, which leaves little beside
families of copies: sets that postings of the third order connect. Each family meets in one task, or is
dealt out in cells, each pair of whose slices meets once; its sets move there once for each slice. There
candidates are compared, those with the largest share of tokens met elsewhere (the common source of copies)
first, and sets that verified links already connect are compared no more. A cell gives back a spanning
forest of its links, never its pairs.

Shingles are told apart by 64 bits and sets by 128. Null texts count as empty: no shingles, linked with
nothing. A row without a doc_id takes part and gets the component of its set; a component with no doc_id at
all has a null id. Repeated rows give repeated results. An empty table gives no rows. Further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm import cells, common
from aerolake.llm.simhash import components

SHINGLE = 3
PERCENT = 90
SEED = 42
# The first order counts one token in so many.
COUNTED = 5
ORDERS = ("first", "second", "third")
# Of the number of sets that hold a token, and of a token, in a rank; tokens that meet there are further candidates.
HELD_BITS, TOKEN_BITS = 15, 47
# Rows of numbers that are broadcast at most: ids, or a table of bits that finds the texts of sets again.
MARKS = 1 << 16
# Word hashes and sets already sent that a task remembers.
REMEMBERED = 200_000
# Sets of a family that one task compares with as many others.
CELL_ROWS = 2048
CELL_BYTES = 16 << 20


# --- sets ------------------------------------------------------------------------------------


class Words(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = made = xxhash.xxh64_intdigest(word, SEED)
        return made


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def factors(count: int) -> np.ndarray:
    """Odd multipliers, one for each place in a shingle or each order."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes, memory: Words, words: int = SHINGLE) -> np.ndarray:
    """The set of a text, sorted; bytes.lower and bytes.split know ASCII only, as wanted."""
    split = text.lower().split()
    hashes = np.fromiter(map(memory.__getitem__, split), np.uint64, len(split))
    size = min(words, len(split))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    total = np.zeros(count, np.uint64)
    for place, factor in enumerate(factors(size)):
        total += hashes[place : place + count] * factor
    return np.unique(mixed(total))


def key_of(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


# --- orders ----------------------------------------------------------------------------------


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return size - (percent * size + 99) // 100 + 1


def prefix_size(size: Column, percent: int = PERCENT) -> Column:
    return size - F.floor((size * percent + 99) / 100).cast("long") + 1


def is_counted(token: Column) -> Column:
    """As ``leading`` has it."""
    return F.shiftrightunsigned(token, 32) % COUNTED == 0


def leading(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The tokens of a set that its prefix under the first order is taken from: the counted ones and, where
    these are too few, the first of the others."""
    counted = (tokens >> np.uint64(32)) % np.uint64(COUNTED) == 0
    missing = prefix_length(len(tokens), percent) - int(counted.sum())
    return np.concatenate([tokens[counted], tokens[~counted][: max(0, missing)]])


def profiles(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, (hi, lo) that names the set, sent (number of leading tokens) and these tokens, once a task for each set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, known = Words(), set()

        def step(block: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, sent, first = [], [], [], []
            for text in block.column("text").cast(pa.binary()).to_pylist():
                found = shingles(text, memory, words)
                key = key_of(found)
                part = leading(found, percent) if len(found) else found
                sizes.append(len(found))
                keys.append(key)
                sent.append(len(part))
                if len(known) >= REMEMBERED:
                    known.clear()
                first.append(None if key in known or not len(found) else part.view(np.int64))
                known.add(key)
            hi, lo = zip(*keys)
            return pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    *(pa.array(x, pa.int64()) for x in (sizes, hi, lo, sent)),
                    pa.array(first, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "hi", "lo", "sent", "tokens"],
            )

        yield from common.by_block("text", step)(batches)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, hi long, lo long, sent long, tokens array<long>")


def whole_sets(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(hi, lo, n, tokens) of the distinct sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Words()

        def step(block: pa.RecordBatch) -> pa.RecordBatch:
            texts = block.column("text").cast(pa.binary()).to_pylist()
            sets = {key_of(s): s for s in (shingles(t, memory, words) for t in texts)}
            hi, lo = zip(*sets)
            return pa.RecordBatch.from_arrays(
                [
                    *(pa.array(x, pa.int64()) for x in (hi, lo, [len(s) for s in sets.values()])),
                    pa.array([s.view(np.int64) for s in sets.values()], pa.list_(pa.int64())),
                ],
                names=["hi", "lo", "n", "tokens"],
            )

        yield from common.by_block("text", step)(batches)

    rows = docs.select(common.text_or_empty().alias("text"))
    return rows.mapInArrow(run, "hi long, lo long, n long, tokens array<long>").dropDuplicates(["hi", "lo"])


def ranked_tokens(tokens: DataFrame, sets: DataFrame, names: list[str], late: Column, percent: int = PERCENT) -> DataFrame:
    """(names, ranks, left) of the sets that have a partner under some order: their tokens that other sets hold too, and
    how many of them belong to a prefix.

    ``tokens`` has a row for each set and token, the sets named by the columns ``names``; ``sets`` has their size
    ``n`` and the number ``sent`` of their tokens. Tokens of one set alone come first in every order, so their
    number says how many others still belong to the prefix. A rank is one long: whether the token is ``late``,
    the number of sets that hold it (as far as ``HELD_BITS`` tell), and the token's last ``TOKEN_BITS`` bits.
    """
    # One exchange: the grouping, which drops what several tasks sent, and the window keep its partitions.
    distinct = tokens.select("token", *names).repartition("token").dropDuplicates(["token", *names])
    shared = distinct.withColumn("held", F.count("*").over(Window.partitionBy("token"))).where("held > 1")
    held = F.shiftleft(F.least(F.col("held"), F.lit((1 << HELD_BITS) - 1)), TOKEN_BITS)
    rank = F.when(late, F.lit(1 << 62)).otherwise(F.lit(0)) + held + _token(F.col("token"))
    lists = shared.groupBy(*names).agg(F.collect_list(rank).alias("ranks"))
    own = F.col("sent") - F.size("ranks")
    left = (prefix_size(F.col("n"), percent) - own).cast("int")
    cut = lists.join(sets.select(*names, "n", "sent"), names).withColumn("left", left)
    return cut.where("left > 0").select(*names, "ranks", "left")


def _token(rank: Column) -> Column:
    return rank.bitwiseAND(F.lit((1 << TOKEN_BITS) - 1))


def prefix(backwards: bool = False) -> Column:
    """The first ``left`` of the ``ranks``, as tokens; ``backwards`` turns ties round."""

    def turned(rank: Column) -> Column:
        return rank.bitwiseXOR(F.lit((1 << TOKEN_BITS) - 1)) if backwards else rank

    first = F.slice(F.array_sort(F.transform("ranks", turned)), 1, F.col("left"))
    return F.transform(first, lambda rank: _token(turned(rank)))


def bounded(rows: DataFrame) -> DataFrame:
    """Stored rows of a few numbers each, hinted for a broadcast if there are at most ``MARKS`` of them."""
    return F.broadcast(rows) if rows.count() <= MARKS else rows


def near_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is among ``ids`` (stored, distinct, not null).

    Up to ``MARKS`` ids are broadcast. Of more ids, bits in a table of that many rows first leave out most other
    texts, before those left move to the ids.
    """
    if (few := bounded(ids)) is not ids:
        return docs.join(few, "doc_id", "left_semi")

    def place(name: str) -> tuple[Column, Column]:
        spread = F.xxhash64(name)
        return F.pmod(spread, F.lit(MARKS)), F.pmod(F.shiftrightunsigned(spread, 32), F.lit(63)).cast("int")

    slot, bit = place("doc_id")
    marks = ids.groupBy(slot.alias("slot")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("marks"))
    likely = docs.withColumn("slot", slot).join(F.broadcast(marks), "slot")
    marked = F.call_function("shiftright", F.col("marks"), bit).bitwiseAND(F.lit(1).cast("long")) == 1
    return likely.where(marked).select("doc_id", "text").join(ids, "doc_id", "left_semi")


def postings(sets: DataFrame, order: str) -> DataFrame:
    """(token, id) of the prefix tokens under an order that at least two of the sets hold in their prefix."""
    rows = sets.select("id", F.explode(order).alias("token"))
    return rows.withColumn("sets", F.count("*").over(Window.partitionBy("token"))).where("sets > 1").select("token", "id")


def partners(sets: DataFrame, order: str) -> DataFrame:
    """Ids of the sets that share a prefix token with another."""
    return postings(sets, order).select("id").distinct()


# --- the join --------------------------------------------------------------------------------


class Ragged:
    """Lists of tokens, one after the other, as small numbers."""

    def __init__(self, lists: pa.ListArray):
        self.ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
        found, self.codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        self.flags = np.zeros(len(found), bool)

    def common(self, row: int, others: np.ndarray) -> np.ndarray:
        """How many tokens of ``row`` each of the other rows holds."""
        own = self.codes[self.ends[row] : self.ends[row + 1]]
        sizes = self.ends[others + 1] - self.ends[others]
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(self.ends[others] - starts, sizes) + np.arange(sizes.sum())
        self.flags[own] = True
        sums = np.append(0, np.cumsum(self.flags[self.codes[at]]))
        self.flags[own] = False
        return sums[starts + sizes] - sums[starts]


def forest(cell: pa.Table, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a cell's links: each linked id and the root of its tree."""
    ids, sizes = cell.column("id").to_numpy(), cell.column("n").to_numpy()
    lists = {name: Ragged(cell.column(name).combine_chunks()) for name in (*ORDERS, "tokens")}
    share = np.diff(lists[ORDERS[0]].ends) / (sizes - (percent * sizes + 99) // 100 + 1)
    order = np.lexsort((ids, -share))
    tops = np.arange(len(ids))
    for at, row in enumerate(order):
        later = order[at + 1 :]
        small, large = np.minimum(sizes[row], sizes[later]), np.maximum(sizes[row], sizes[later])
        others = later[(tops[later] != tops[row]) & (small * 100 >= large * percent)]
        for name in ORDERS:
            if len(others):
                others = others[lists[name].common(row, others) > 0]
        if len(others):
            both = lists["tokens"].common(row, others)
            others = others[both * 100 >= (sizes[row] + sizes[others] - both) * percent]
            if len(others):
                joined = np.append(tops[others], tops[row])
                tops[np.isin(tops, joined)] = joined.min()
    linked = np.flatnonzero(tops != np.arange(len(ids)))
    return ids[linked], ids[tops[linked]]


def connected(postings: DataFrame) -> DataFrame:
    """(id, family): sets that postings (token, id) connect."""
    first = F.min("id").over(Window.partitionBy("token"))
    stars = common.keep(postings).select("id", first.alias("first")).where("id <> first")
    return components(stars).toDF("id", "family")


def compared(
    sets: DataFrame, families: DataFrame, percent: int = PERCENT, cell_rows: int = CELL_ROWS, cell_bytes: int = CELL_BYTES
) -> DataFrame:
    """Spanning links (id, root) of all families: the sets (id, tokens), and id, family, n and the prefixes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cell(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if sum(p.num_rows for p in parts) > 1:
                made = forest(pa.Table.from_batches(parts), percent)
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["id", "root"])

        parts: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in place], axis=1)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a < b:
                    if (name := tuple(names[a].tolist())) != last:
                        yield from cell(parts)
                        parts, last = [], name
                    parts.append(batch.slice(a, b - a))
        yield from cell(parts)

    place = ["family", "low", "high"]
    slices = F.greatest(F.ceil(F.count("*") / cell_rows), F.ceil(F.sum("n") * 8 / cell_bytes))
    sizes = families.groupBy("family").agg(slices.alias("slices"))
    own = F.pmod(F.xxhash64("id"), F.col("slices"))
    # Places are found before the sets themselves join, which so move to them once.
    placed = families.join(sizes, "family").withColumn("own", own)
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    rows = sets.join(dealt.select("family", low, high, "id", "n", *ORDERS), "id").select(*place, "id", "n", "tokens", *ORDERS)
    return rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "id long, root long")


def near_sets(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable over links) of every row."""
    made = common.keep(profiles(docs, words, percent))
    key = ["hi", "lo"]
    rows = made.select("doc_id", "n", *key)
    classes = common.keep(
        made.where("n > 0").groupBy(*key).agg(F.max("n").alias("n"), F.max("sent").alias("sent"), F.min("doc_id").alias("least"))
    )

    # First order, over all sets.
    sent = made.where("tokens is not null").select(*key, F.explode("tokens").alias("token"))
    ranks = ranked_tokens(sent, classes, key, ~is_counted(F.col("token")), percent)
    passed = common.keep(ranks.select(*key, prefix().alias(ORDERS[0])).join(classes, key))
    kept = cells.numbered(passed).withColumnRenamed("row", "id")
    kept = common.keep(kept.join(partners(kept, ORDERS[0]), "id"))

    # Second and third order, over the sets that passed.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = common.keep(kept.select(F.col("least").alias("doc_id")).where("doc_id is not null").distinct())
    wanted = near_rows(texts, ids)
    if not kept.where("least is null").isEmpty():
        wanted = wanted.unionByName(texts.where("doc_id is null"))
    sets = common.keep(whole_sets(wanted, words).join(kept.select(*key, "id"), key).select("id", "n", "tokens"))
    exploded = sets.select("id", F.explode("tokens").alias("token"))
    sizes = kept.select("id", "n", F.col("n").alias("sent"))
    ranks = ranked_tokens(exploded, sizes, ["id"], F.lit(False), percent)
    others = common.keep(ranks.select("id", prefix().alias(ORDERS[1]), prefix(backwards=True).alias(ORDERS[2])))

    families = common.keep(connected(postings(others, ORDERS[2])).join(kept.select("id", "n", ORDERS[0]), "id").join(others, "id"))
    links = compared(sets.join(bounded(families.select("id")), "id", "left_semi").select("id", "tokens"), families, percent)
    roots = components(links).toDF("id", "root").join(kept.select("id", *key), "id")
    rooted = classes.join(roots, key, "left").select(*key, "least", "root")
    joined = rooted.where("root is not null")
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_key = joined.join(named, "root").select(*key, "component_id")
    alone = rooted.where("root is null").select(*key, F.col("least").alias("component_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    found = rows.where("n > 0").join(of_key.unionByName(alone), key).select(*columns)
    return found.unionByName(rows.where("n = 0").withColumn("component_id", F.col("doc_id")).select(*columns))

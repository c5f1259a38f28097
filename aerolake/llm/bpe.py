"""Byte-level BPE by merge replay over all words of a block of texts at once.

Texts are split by the vocabulary's pattern. The distinct words of a block lie end to end as one array of
token ids with links to the neighbours. An inverted index maps each mergeable pair, named by the rank of
its merge, to the positions where it stands; the merges are applied in rank order, each to all of its
positions in one step, and only the pairs at the touched neighbours are looked up again and indexed.
The ids of a word depend on nothing outside it, so the corpus is replayed in blocks wherever its texts
lie, and no text or word is shuffled. Words that a worker has met before are not replayed again.

Null texts count as empty: no ids, empty bytes. Repeated rows and null doc_ids are encoded as rows of
their own. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm import common, cuts

BLOCK_BYTES = 6 << 20
# Words and cuts whose ids a worker remembers between blocks; beyond it it replays them anew.
REMEMBERED = 200_000
# Ids that are decoded at a time.
DECODED_IDS = 2 << 20
NO_MERGE = np.iinfo(np.int32).max


class Vocabulary:
    """Ranks of a tiktoken file: the token's id, its bytes, and the merge that each pair of ids has."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(ranks.values()) + 1
        self.bytes = [b""] * size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = sorted(
            (ranks[left] * size + ranks[right], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in ranks and (right := token[cut:]) in ranks
        )
        self.size = size
        self.pairs = np.array([p for p, _ in merges], np.int64)
        self.merged = np.array([r for _, r in merges], np.int32)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids; NO_MERGE where an id is -1 or the pair has none."""
        pair = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.merged[at], NO_MERGE)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# --- replay ----------------------------------------------------------------------------------


class PairIndex:
    """Positions by merge rank; the lowest rank comes out first."""

    def __init__(self):
        self.positions: dict[int, list[np.ndarray]] = defaultdict(list)
        self.waiting: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        real = ranks != NO_MERGE
        ranks, positions = ranks[real], positions[real]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
            rank = int(ranks[a])
            if rank not in self.positions:
                heapq.heappush(self.waiting, rank)
            self.positions[rank].append(positions[a:b])

    def lowest(self) -> tuple[int, np.ndarray] | None:
        if not self.waiting:
            return None
        rank = heapq.heappop(self.waiting)
        return rank, np.unique(np.concatenate(self.positions.pop(rank)))


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that overlap (``aaa``), every second one, from the left."""
    chained = np.concatenate(([False], after[at[:-1]] == at[1:]))
    if not chained.any():
        return at
    number = np.arange(len(at))
    first = np.maximum.accumulate(np.where(chained, 0, number))
    return at[(number - first) % 2 == 0]


def replay(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words end to end, and where each word ends."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    count = len(flat)
    # One more slot stands for "no neighbour"; its id is -1 and has no merge.
    ids = np.append(vocab.of_byte[flat], np.int32(-1))
    after = np.append(np.arange(1, count + 1, dtype=np.int32), np.int32(count))
    before = np.append(np.arange(-1, count - 1, dtype=np.int32), np.int32(count))
    ends = np.cumsum(lengths)
    filled = lengths > 0
    after[ends[filled] - 1] = count
    before[(ends - lengths)[filled]] = count
    ranks = np.append(vocab.merge(ids[:count], ids[after[:count]]), np.int32(NO_MERGE))
    index = PairIndex()
    index.add(ranks[:count], np.arange(count, dtype=np.int32))
    alive = np.ones(count, bool)
    while (found := index.lowest()) is not None:
        rank, at = found
        at = _apart(at[ranks[at] == rank], after)
        if not len(at):
            continue
        gone = after[at]
        beyond = after[gone]
        ids[at] = rank
        alive[gone] = False
        ranks[gone] = NO_MERGE
        after[at] = beyond
        before[beyond] = at
        before[count] = count
        ahead = before[at]
        touched = np.concatenate((at, ahead[ahead != count]))
        new = vocab.merge(ids[touched], ids[after[touched]])
        ranks[touched] = new
        index.add(new, touched)
    kept = np.concatenate(([0], np.cumsum(alive)))
    return ids[:count][alive], kept[ends]


# --- texts -----------------------------------------------------------------------------------

_ODD = re.compile(cuts.ODD)
# A blank that has white space on both sides, or before it and the end behind it.
_WIDE = re.compile(r"[\t\n\r ] (?:[\t\n\r ]|\Z)")
_CUT = "\x00"


@functools.cache
def splitters(pattern: str) -> tuple[re.Pattern, re.Pattern]:
    """The pattern, and its twin for texts of plain characters, on which ``re`` is twice as fast."""
    plain = cuts.plain_characters()
    classes = {k: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == k) for k in "LN"}
    # Inside a class first, then alone.
    twin = pattern.replace(r"\s\p{L}\p{N}", r"\t\n\r " + classes["L"] + classes["N"])
    for kind in "LN":
        twin = twin.replace(rf"\p{{{kind}}}", f"[{classes[kind]}]")
    return regex.compile(pattern), re.compile(twin)


class Encoder:
    """Ids of texts; remembers the words it has replayed and the cuts it has put together.

    Plain texts are cut before every blank: a word of the pattern begins with a blank or holds none, unless
    white space runs on both sides of it. Texts with such runs are one cut each.
    """

    def __init__(self, path: str, pattern: str):
        self.vocab = vocabulary(path)
        self.full, self.plain = splitters(pattern)
        self.words: dict[str, bytes] = {}
        self.cuts: dict[str, bytes] = {}

    def _replay(self, split: list[list[str]]) -> list[bytes]:
        """Ids of texts or cuts that are given as words."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        known = self.words
        new = list({w for words in split for w in words}.difference(known))
        ids, ends = replay([w.encode("utf-8") for w in new], self.vocab)
        flat, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
        known.update((w, flat[a:b]) for w, a, b in zip(new, [0, *ends], ends))
        of_word = known.__getitem__
        return [of_word(w[0]) if len(w) == 1 else b"".join(map(of_word, w)) for w in split]

    def _ids_of(self, distinct: list[str]) -> list[bytes]:
        known = self.cuts
        if len(known) > REMEMBERED:
            known.clear()
        new = [c for c in distinct if c not in known]
        known.update(zip(new, self._replay([self.plain.findall(c) for c in new])))
        return [known[c] for c in distinct]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        smooth = [not (_ODD.search(t) or _WIDE.search(t)) for t in texts]
        marked = pc.replace_substring(pa.array([t for t, s in zip(texts, smooth) if s], pa.string()), " ", _CUT + " ")
        made = cuts.assemble(pc.split_pattern(marked, _CUT), self._ids_of)
        rest = [t for t, s in zip(texts, smooth) if not s]
        whole = self._replay([(self.full if _ODD.search(t) else self.plain).findall(t) for t in rest])
        return cuts.merge(smooth, made, [np.frombuffer(w, "<u4") for w in whole])


@functools.cache
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path, pattern)


def bytes_of(lists: pa.ListArray, path: str) -> pa.BinaryArray:
    """The bytes that each list of ids stands for."""
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    tokens = pa.array(vocabulary(path).bytes, pa.binary()).take(lists.flatten())
    # The tokens' bytes lie end to end, so a text is the stretch between its first and last token.
    _, offsets, data = tokens.buffers()
    places = np.frombuffer(offsets, np.int32)[ends]
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(places), data])


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id and the ids of its whole text; with ``decoded`` also the bytes that these ids stand for,
    which spares handing the ids to a second worker."""

    def step(block: pa.RecordBatch) -> pa.RecordBatch:
        made = encoder(path, pattern).encode(block.column("text").to_pylist())
        offsets = np.concatenate(([0], np.cumsum([len(m) for m in made]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.uint32), *made]).astype(np.int32))
        columns = {"doc_id": block.column("doc_id"), "ids": ids}
        if decoded:
            columns["decoded"] = bytes_of(ids, path)
        return pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return rows.mapInArrow(common.by_block("text", step, BLOCK_BYTES), schema)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with the bytes that the ids stand for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in common.slices(batch, np.diff(batch.column("ids").offsets.to_numpy()), DECODED_IDS):
                texts = bytes_of(block.column("ids"), path)
                yield pa.RecordBatch.from_arrays([*block.columns, texts], names=["doc_id", "ids", "decoded"])

    return coded.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")

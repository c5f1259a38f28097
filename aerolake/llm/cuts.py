"""Texts put together from the ids of their distinct cuts, in columns rather than word by word."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

# Plain characters: Latin letters, usual punctuation and plain white space. Python, Arrow and the
# tokenizer libraries split and lower-case texts of these alike; U+0130, which lower-cases to two, is out.
PLAIN = ((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x7E), (0xA1, 0x12F), (0x131, 0x24F), (0x2010, 0x2027))
ODD = "[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in PLAIN) + "]"


def plain_characters() -> list[str]:
    return [chr(c) for a, b in PLAIN for c in range(a, b + 1)]


def assemble(lists: pa.ListArray, ids_of: Callable[[list[str]], Sequence[bytes]]) -> list[np.ndarray]:
    """Ids of each text from the ids (32-bit, little-endian) that ``ids_of`` has for its distinct cuts."""
    coded = lists.flatten().dictionary_encode()
    at = coded.indices.to_numpy()
    parts = ids_of(coded.dictionary.to_pylist())
    table = np.frombuffer(b"".join(parts), "<u4")
    lengths = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
    starts = np.cumsum(lengths, dtype=np.int32) - lengths
    counts = lengths[at]
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)  # a block of texts is far below 2 ** 31
    flat = table[np.repeat(starts[at] - ends[:-1], counts) + np.arange(ends[-1], dtype=np.int32)]
    text_ends = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return [flat[a:b] for a, b in zip(text_ends.tolist(), text_ends[1:].tolist())]


def merge(first: Sequence[bool], yes: list, no: list) -> list:
    """One list from two: where ``first`` holds the next of ``yes``, else the next of ``no``."""
    left, right = iter(yes), iter(no)
    return [next(left) if f else next(right) for f in first]

"""Exact token ids of whole texts, word by word, in columns.

A ``tokenizers`` vocabulary that lower-cases, drops white space and splits by a fixed pattern gives every
word its ids without regard to its neighbours. So a block of texts is split into words as one column, the
block's distinct words are encoded by the library once, and texts are put together from the words' ids.
Texts with characters that are not plain, or with one of the vocabulary's added tokens, are encoded by the
library whole.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from aerolake.llm import cuts

# Words whose ids a worker remembers between blocks; those not met for long go first.
REMEMBERED = 200_000


def _class(kind: str) -> str:
    """The lower-cased plain characters of a Unicode category, for a character class."""
    plain = {c.lower() for c in cuts.plain_characters()}
    return "".join(re.escape(c) for c in sorted(plain) if unicodedata.category(c)[0] == kind)


# Fixed: the word pattern of the vocabulary file, for plain characters.
WORD = f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^\\t\\n\\r {_class('L')}{_class('N')}]+"


class Encoder:
    """Ids of texts; remembers words it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # The vocabulary's added tokens are looked for in the text as it stands.
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.met: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single words, by one call over all of them, a blank between each two."""
        made = self.library.encode(" ".join(words), add_special_tokens=False)
        flat = np.array(made.ids, "<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(made.word_ids, minlength=len(words)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _ids_of(self, distinct: list[str]) -> list[bytes]:
        if len(self.met) > REMEMBERED // 2:
            # What was not met since the last turn is forgotten.
            self.met, self.before = {}, self.met
        met, before = self.met, self.before
        met[""] = b""  # what lies ahead of the first blank and after the last
        new = [w for w in distinct if w not in met]
        met.update((w, before[w]) for w in new if w in before)
        unmet = [w for w in new if w not in before]
        for at in range(0, len(unmet), 4096):
            part = unmet[at : at + 4096]
            met.update(zip(part, self._words(part)))
        return [met[w] for w in distinct]

    def encode(self, texts: pa.StringArray) -> list[np.ndarray]:
        odd = pc.match_substring_regex(texts, cuts.ODD)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        lower = pc.utf8_lower(texts.filter(pc.invert(odd)))
        split = pc.utf8_split_whitespace(pc.replace_substring_regex(lower, WORD, r"\0 "))
        made = cuts.assemble(split, self._ids_of)
        whole = self.library.encode_batch_fast(texts.filter(odd).to_pylist(), add_special_tokens=False)
        return cuts.merge(pc.invert(odd).to_pylist(), made, [np.array(e.ids, "<u4") for e in whole])


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)


def encode(texts: pa.StringArray, path: str) -> list[np.ndarray]:
    return encoder(path).encode(texts)

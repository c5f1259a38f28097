from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from aerolake.llm import bpe, common
from aerolake.llm.register import BYTE_VOCABULARY, QUERIES


@pytest.fixture(scope="module")
def library():
    with open(BYTE_VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_the_library(library):
    own = bpe.Encoder(BYTE_VOCABULARY, public_tokenizers.PATTERN)
    odd = [
        "", "aaaaaaa aaaaaaaaa", "   \n\n  x\t\t", "日本語テキスト русский", "   x ", "a" * 5000, "  " * 777, "=-=-=-=-====",
        "it's we'll I'M 's", "é̇ İstanbul ſ K ǅ ﬁ", "\x1c\x1d a\x85b", "<|endoftext|> hi",
    ]
    random.seed(1)
    odd += ["".join(random.choice("abcab  .'\néñ日1") for _ in range(random.randrange(60))) for _ in range(2000)]
    assert [x.tolist() for x in own.encode(odd)] == [library.encode_ordinary(x) for x in odd]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Encoder(BYTE_VOCABULARY, public_tokenizers.PATTERN)
    for text in ("one two three four five", "two", "six one"):
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_table_and_round_trip(spark, library):
    docs = common.read(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    coded = bpe.decode(bpe.encode(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN), BYTE_VOCABULARY).collect()
    assert len(coded) == len(texts)
    for row in coded:
        assert row.ids == library.encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded).decode() == texts[row.doc_id]
    both = bpe.encode(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted(both) == sorted(coded)
    assert QUERIES["op4_bpe"](spark, "/root/testdata/sf0.001").count() == len(texts)


def test_odd_rows(odd_docs, no_docs, library):
    def made(docs):
        return bpe.decode(bpe.encode(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN), BYTE_VOCABULARY).collect()

    want = sorted((r.doc_id or -1, library.encode_ordinary(r.text or "")) for r in odd_docs.collect())
    assert sorted((r.doc_id or -1, r.ids) for r in made(odd_docs)) == want
    assert made(no_docs) == []

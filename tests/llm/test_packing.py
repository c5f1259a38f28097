from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerolake.llm import common, packing, words
from aerolake.llm.register import WORD_VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def hold(rows, texts, library):
    """Every document's ids lie in exactly one piece each, sequences are gapless and not too long."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        whole = ids_of(library, text)
        pieces = sorted(of_doc.pop(doc), key=lambda r: r.start)
        assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces[:-1]]).tolist()
        assert sum(p.length for p in pieces) == len(whole) == pieces[0].doc_tokens
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(whole[p.start : p.start + p.length], "<u4").tobytes())
    assert not of_doc
    for pieces in of_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= packing.CAPACITY
    used = sum(r.length for r in rows)
    return used / (len(of_sequence) * packing.CAPACITY)


def test_table(spark, library):
    docs = common.read(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack_documents(docs, WORD_VOCABULARY).collect()
    assert hold(rows, texts, library) > 0.97
    one_by_one = packing.pack(packing.pieces(docs, WORD_VOCABULARY), group_pieces=100).collect()
    assert hold(one_by_one, texts, library) > 0.9


def test_ids_travel_when_asked(spark, library):
    docs = common.read(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pieces(docs, WORD_VOCABULARY, ids=True).collect()
    assert all(len(r.ids) == r.length for r in rows)
    first = next(r for r in rows if r.start == 0)
    text = docs.where(f"doc_id = {first.doc_id}").first().text
    assert first.ids == ids_of(library, text)[: first.length]


def test_words_equal_the_library(library):
    texts = [
        "", " ", "It's I'LL we've 12½³ x_y--z", "ÀÉÎ Ǆ ȺȾ İı ſ ß", "a\x1cb\x85c\xa0d", "日本 Σίσυφος ΣΑΣ K Å ﬁ", "é é",
        "<|endoftext|> <|startoftext|>", "'s'S''s 't'tt", "“quoted” – dash…", "x" * 3000,
    ]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = words.Encoder(WORD_VOCABULARY)
    for _ in range(2):
        assert [m.tolist() for m in encoder.encode(pa.array(texts))] == expected
    assert encoder.encode(pa.array([], pa.string())) == []


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(alphabet="aB1é²'’stre.,-_ \t\nß½Ǆ<|>", max_size=40), max_size=5))
def test_words_of_any_text(library, texts):
    made = words.encoder(WORD_VOCABULARY).encode(pa.array(texts, pa.string()))
    assert [m.tolist() for m in made] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_not_met_for_long_are_forgotten(library, monkeypatch):
    monkeypatch.setattr(words, "REMEMBERED", 20)
    encoder = words.Encoder(WORD_VOCABULARY)
    for turn in range(30):
        text = f"always here and word{turn}x or {turn * 7} things{turn}"
        made = encoder.encode(pa.array([text]))
        assert made[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.met) + len(encoder.before) < 50
    assert "always" in encoder.met or "always" in encoder.before


def plain_assign(lengths, capacity, linear, quadratic):
    """Each piece, longest first, to the first of the cheapest sequences that have room; else to a new one."""
    opened = math.ceil(packing.OPENED * sum(lengths) / capacity)
    room, cost, out = [capacity] * opened, [0.0] * opened, []
    for n in lengths:
        fits = [i for i in range(len(room)) if room[i] >= n]
        if not fits:
            room.append(capacity)
            cost.append(0.0)
            fits = [len(room) - 1]
        at = min(fits, key=lambda i: (cost[i], i))
        out.append((at, capacity - room[at]))
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n
    return out


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 50), max_size=80), st.sampled_from([50, 64, 100]), st.sampled_from([0.0, 0.02, 1.0]))
def test_assign_equals_a_plain_loop(lengths, capacity, quadratic):
    lengths = sorted(lengths, reverse=True)
    sequence, offset = packing.assign(np.array(lengths, np.int64), capacity, 1.0, quadratic)
    assert list(zip(sequence.tolist(), offset.tolist())) == plain_assign(lengths, capacity, 1.0, quadratic)


def test_assign_takes_the_cheapest_with_room():
    lengths = np.array([6, 5, 4, 3, 2, 1])
    sequence, offset = packing.assign(lengths, capacity=10, quadratic=0.1)
    room: dict[int, int] = defaultdict(int)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist()):
        assert o == room[s]
        room[s] += n
    assert max(room.values()) <= 10 and len(room) <= 4


def test_odd_rows(odd_docs, no_docs, library):
    rows = packing.pack_documents(odd_docs, WORD_VOCABULARY).collect()
    assert sum(r.start == 0 for r in rows) == odd_docs.count()
    assert {r.length for r in rows if r.doc_id == 2} == {1}
    assert sum(r.length for r in rows if r.doc_id == 4) == 60_003
    assert packing.pack_documents(no_docs, WORD_VOCABULARY).count() == 0


def test_added_tokens_have_their_own_ids(spark):
    """As an unmodified library gives them."""
    library = Tokenizer.from_file(WORD_VOCABULARY)
    texts = ["a <|endoftext|> b", "x<|startoftext|>y", "<|ENDOFTEXT|> <|endof text|>", "日本 <|endoftext|>", "plain text"]
    made = words.encoder(WORD_VOCABULARY).encode(pa.array(texts))
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert made[0].tolist() == [320, 49407, 321]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hold(packing.pack_documents(docs, WORD_VOCABULARY).collect(), dict(enumerate(texts)), library)

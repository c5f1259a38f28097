from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.llm import common, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs: list[tuple], items: list[tuple], k: int) -> Counter:
    split = [(doc, plain_terms(text)) for doc, text in docs]
    n_docs, total = sum(1 for _, t in split if t), sum(len(t) for _, t in split)
    held = Counter(t for _, terms in split for t in set(terms))
    out: Counter = Counter()
    for item, text in set(items):
        found = []
        for doc, terms in split:
            times, m = Counter(terms), 50 + (50 * len(terms) * n_docs) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * times[t] // (1000 * times[t] + 20 * m))
                for t in set(plain_terms(text))
                if times[t]
            )
            if score > 0 and doc is not None:
                found.append((-score, doc))
        for rank, (score, doc) in enumerate(sorted(found)[:k], 1):
            out[item, rank, doc, -score] += 1
    return out


def searched(docs, items, **options) -> Counter:
    return Counter(tuple(r) for r in ranked.search(docs, items, **options).collect())


@settings(deadline=None)
@given(st.text(alphabet="aZ09 _-\x00\x7f\x85\xa0éİñ日.,\n", max_size=60))
def test_terms(text):
    assert [t.decode() for t in ranked.terms(text.encode())] == plain_terms(text)


@settings(deadline=None, max_examples=25)
@given(st.integers(1, 400), st.integers(1, 90), st.integers(1, 60), st.integers(0, 10**6))
def test_two_trees_find_what_a_plain_search_finds(n_docs, n_items, k, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(n_docs)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(n_items)]
    rows = [{"item_id": i, "text": t} for i, t in items]
    block = ranked.Items.of(rows)
    texts = [t.encode() for _, t in docs]
    sizes, _, columns, _ = ranked.counted(texts, block.vocabulary)
    if not sizes.sum() or not block.vocabulary:
        return
    block.weigh(Counter(columns.tolist()) | Counter({-1: int((sizes > 0).sum()), -2: int(sizes.sum())}))
    tree = ranked.DualTree(block, k)
    for at in range(0, n_docs, 150):
        tree.walk(np.arange(at, min(n_docs, at + 150)), texts[at : at + 150])
    tree.best.settle()
    found = {(tree.ids[i], int(d), int(s)) for i, s, d in zip(*tree.best.kept)}
    assert found == {(i, d, s) for i, _, d, s in plain_search(docs, items, k)}


def test_bounds_leave_most_pairs_out():
    """Documents of one topic never meet the items of another."""
    rng = random.Random(1)
    texts, items = [], []
    for topic in range(8):
        words = [f"t{topic}w{i}" for i in range(80)]
        texts += [" ".join(rng.choices(words, k=30)).encode() for _ in range(400)]
        items += [{"item_id": topic * 10 + i, "text": " ".join(rng.choices(words, k=8))} for i in range(8)]
    block = ranked.Items.of(items)
    sizes, _, columns, _ = ranked.counted(texts, block.vocabulary)
    block.weigh(Counter(columns.tolist()) | Counter({-1: len(texts), -2: int(sizes.sum())}))
    tree = ranked.DualTree(block, 5)
    tree.walk(np.arange(len(texts)), texts)
    assert tree.scored + tree.met < len(texts) * len(items) / 4


@pytest.mark.parametrize("block_items", [512, 3])
def test_given_tables(spark, block_items):
    sf_dir = "/root/testdata/sf0.001"
    docs, items = (common.read(spark, sf_dir, t) for t in ("documents", "benchmark"))
    items = items.where("item_id < 12")
    plain = plain_search(
        [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.collect()], 50
    )
    assert searched(docs, items, block_items=block_items) == plain


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "plain word"), (1, "plain word"), (2, None), (3, ""), (None, "sentences"), (4, "日本語 İstanbul"), (5, "nowhere")]
    stated = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert searched(odd_docs, stated, k=3) == plain_search(docs, items, 3)
    assert searched(no_docs, stated) == Counter()
    assert searched(odd_docs, stated.limit(0)) == Counter()


def test_items_of_very_many_terms_are_scored_in_whole_numbers():
    block = ranked.Items.of([{"item_id": 1, "text": " ".join(f"a{i}" for i in range(500_000))}])
    block.weigh({-1: 10**9, -2: 10**11})
    assert block.matrix().dtype == np.int64

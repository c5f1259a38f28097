from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.llm import common, simhash


def plain_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple], radius: int) -> list:
    """Smallest doc_id reachable, by brute force over all pairs of rows."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin((rows[i][1] ^ rows[j][1]) & (2**64 - 1)).count("1") <= radius:
                parent[top(i)] = top(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [least.get(top(i)) for i in range(len(rows))]


@given(st.text(alphabet="abAB \t\x0b\x1c\xa0é.", max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(deadline=None, max_examples=30)
@given(st.integers(0, 9), st.integers(1, 400), st.integers(0, 10**6))
def test_bit_sliced_comparison_finds_all_pairs(radius, count, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    codes = base[rng.integers(0, 12, count)]
    for _ in range(int(rng.integers(0, 8))):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64))
    found = {(i, int(j)) for i, hits in simhash.near(codes, radius, probes=64) for j in hits}
    distance = np.bitwise_count(codes[:, None] ^ codes[None, :])
    assert found == {(int(i), int(j)) for i, j in zip(*np.nonzero(distance <= radius)) if i < j}


@pytest.mark.parametrize("bucket_rows", [simhash.BUCKET_ROWS, 7])
def test_components_against_all_pairs(spark, bucket_rows):
    docs = common.read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.code, r.component_id) for r in simhash.near_duplicates(docs, bucket_rows=bucket_rows).collect()]
    assert len(rows) == docs.count()
    assert [r[2] for r in rows] == plain_components([r[:2] for r in rows], simhash.RADIUS)


def test_chain_and_hot_group(spark):
    """Codes one bit apart each form one component, as does a ball of many codes."""
    chain = [sum(1 << b for b in range(n)) for n in range(40)]
    ball = [(1 << 62) ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)]
    codes = spark.createDataFrame([(c,) for c in {*chain, *ball}], "code long")
    links = simhash.compare(simhash.buckets(codes, 4, 50), 4)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert len({roots[c] for c in chain}) == 1
    assert len({roots[c] for c in ball}) == 1


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in simhash.near_duplicates(odd_docs).select("doc_id", "code", "component_id").collect()]
    assert len(rows) == odd_docs.count()
    assert [r[2] for r in rows] == plain_components([r[:2] for r in rows], simhash.RADIUS)
    assert {r[2] for r in rows if r[1] == 0} == {2}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one(spark, odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs, simhash.near_duplicates(odd_docs))
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(2) == 1 and 3 not in ids and ids.count(None) == 2
    assert simhash.keep_one(no_docs, simhash.near_duplicates(no_docs)).count() == 0


def test_keep_one_by_text_and_id(spark):
    """One doc_id on rows of several texts: each group of texts keeps one row, whatever else the id heads."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma"))
    near = a + " end"
    rows = [(1, a, 1), (1, b, 2), (1, b, 2), (2, near, 3), (2, c, 4), (3, c, 5), (4, b, 6)]
    rows += [(None, "some text without an id", 7)] * 5 + [(None, "другой " * 9, 8), (None, c.upper(), 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    groups = simhash.near_duplicates(docs)
    texts = {r.text: simhash.fingerprint(r.text.encode()) for r in docs.collect()}
    assert (texts[a] ^ texts[near]).bit_count() <= simhash.RADIUS
    kept = simhash.keep_one(docs, groups)
    assert kept.columns == docs.columns
    assert sorted(r.n for r in kept.collect()) == [1, 2, 4, 7, 8, 9]

from __future__ import annotations

import pytest

LONG = "word " * 60_000 + "end."
CLASHING = ("label", "score", "code", "row", "group", "component_id", "kept", "start", "position", "content", "kind")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    rows = [
        (1, "A plain text. With two sentences.", "en", "a", 33),
        (1, "A plain text. With two sentences.", "en", "a", 33),
        (2, "", "en", "a", 0),
        (3, None, None, None, None),
        (None, "A text without an id.", "de", "b", 21),
        (None, None, None, None, None),
        (4, LONG, "en", "a", len(LONG)),
        (5, "  \t\n ", "fr", None, 6),
        (6, "日本語 русский İstanbul ﬁ é \x1c\x85", "xx", "c", -5),
        (7, "A plain text. With two sentences!", "en", "a", 33),
    ]
    extra = tuple(f"x{i}" for i in range(len(CLASHING)))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING
    )
    return spark.createDataFrame([r + extra for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

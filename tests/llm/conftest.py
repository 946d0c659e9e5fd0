from __future__ import annotations

import random

import pytest

from meterflow.llm.common import prepare

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # columns that operators use as names of their own
    "score double, code bigint, size bigint, `range` int, r string, fingerprint string, key string, kept boolean"
)
EXTRA = (0.5, 1, 2, 3, "r", "f", "k", True)


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(words))


@pytest.fixture
def table(spark):
    """Documents from `(doc_id, text, lang, source)` rows; shorter rows end in nulls."""
    prepare(spark)

    def build(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *EXTRA))
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties and repeated rows."""
    long = prose(1, 30_000) + " end"
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\r\n\x0b\x0c ", "de", "a"),
        (4, "One of Two copies here, MIT License", None, None),
        (4, "One of Two copies here, MIT License", None, None),
        (5, "one of two copies here, mit license", "en", "b"),
        (None, "text without id", "en", "b"),
        (None, None, None, None),
        (6, long, "en", "é"),
        (7, long, "en", "é"),
        (8, "été à la plage \x1c 中文 😀 !!!", "fr", "b"),
        (50, long + " more", "en", "b"),
        (100, "x", "en", "b"),
    ]

import random
import re
from collections import Counter

import numpy as np
import pytest

from meterflow.llm import repetition as rp
from tests.llm.conftest import prose


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def plain_coverage(text, n):
    """Share of word characters inside n-grams that occurred before."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, inside = set(), set()
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            inside |= set(range(i, i + n))
        seen.add(gram)
    return sum(len(words[i]) for i in inside) / max(1, sum(map(len, words)))


def base_of(row):
    return tuple(row[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_base_counts():
    rng = random.Random(1)
    parts = ["a ", "b ", "é", "\n", " ", "\x0b", "#", "\x1c", " ", "c c c c ", "a b a b ", "one two three four five six seven eight ", "x\r\n"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randrange(60)))
        assert base_of(rp.measure(text)) == plain_base(text), repr(text)


def test_coverage_of_n_grams():
    rng = random.Random(3)
    for _ in range(60):
        text = " ".join(rng.choices(["aa", "b", "ccc", "été"], k=rng.randint(2, 80)))
        assert rp.measure(text)["in_ngrams"] == pytest.approx(max(plain_coverage(text, n) for n in rp.MOST_IN_NGRAMS))


def test_equal_hashes_of_different_n_grams():
    ids = np.array([0, 1, 2, 0, 1, 3, 0, 1, 2])
    order, same = rp.groups(np.zeros(7, np.uint64), ids, 3)
    grams = [tuple(ids[i : i + 3]) for i in order]
    assert [bool(s) for s in same] == [False] + [a == b for a, b in zip(grams, grams[1:])]
    assert sum(same) == 1


def test_verdicts():
    clean = prose(1, 400)
    assert rp.measure(clean)["kept"]
    line = prose(2, 12)
    assert not rp.measure(clean[:300] + ("\n" + line) * 6)["kept"]
    assert not rp.measure("spam " * 50)["kept"]
    assert not rp.measure("too short")["kept"] and rp.measure("too short")["base_failed"]
    # repeats of five words are below the base rule's window, and the method's alone reject them
    five = " ".join(prose(5, 5) + " " + prose(100 + i, 4) for i in range(20))
    found = rp.measure(five)
    assert not found["base_failed"] and not found["kept"]


def test_odd_rows(table, odd_rows):
    rows = rp.repetition_rules(table(odd_rows)).collect()
    assert Counter((r.doc_id, *base_of(r)) for r in rows) == Counter((row[0], *plain_base(row[1])) for row in odd_rows)
    assert all(r.kept <= (not r.base_failed) for r in rows)
    assert rp.repetition_rules(table([]).limit(0)).count() == 0

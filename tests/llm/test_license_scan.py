import random
import re
from collections import Counter

import pytest

from meterflow.llm import license_scan as ls
from tests.llm.conftest import prose

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label)
        for phrase, label in ls.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def base_of(row):
    return tuple(row[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels"))


@pytest.fixture(scope="module")
def scanner():
    return ls.Scanner()


def test_base_places(scanner):
    rng = random.Random(1)
    parts = ["mit", "license", "CC", "by", "BY-NC", "gnu", "general", "public", "Apache", "É", "x.y", "License!", "\x7f", "MIT License"]
    for _ in range(1500):
        text = rng.choice([" ", "-"]).join(rng.choices(parts, k=rng.randrange(40)))
        assert base_of(ls._row(scanner.scan(text))) == plain(text), text


def edited(rng, notice, edits):
    out = list(notice)
    for _ in range(edits):
        at = rng.randrange(1, len(out) - 1)
        what = rng.randrange(3)
        if what == 0:
            out[at] = rng.choice("qxz")
        elif what == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("qxz"))
    return "".join(out)


def test_every_notice_within_its_edits_is_found(scanner):
    rng = random.Random(2)
    for label, notice in scanner.notices:
        for _ in range(40):
            text = edited(rng, notice, rng.randint(0, scanner.edits(notice)))
            if "  " in text:
                continue
            n_words, _, spans = scanner.scan(f"{prose(1, 5)}; {text}. {prose(2, 5)}")
            assert label in {s.label for s in spans}, text
            assert all(0 <= s.first < n_words and s.likeness > 0.85 for s in spans)


def test_spans_and_edits(scanner):
    _, _, spans = scanner.scan("one two Licensd under the Apache-License, version 2.0 end")
    assert [(s.label, s.first, s.words, s.edits) for s in spans if s.first == 2] == [("apache", 2, 8, 1)]
    assert ls._row(scanner.scan("x Relased under the MIT Licence y"))["labels"] == "mit"


def test_clean_text_has_no_label(scanner):
    assert ls._row(scanner.scan(prose(7, 5000)))["labels"] == ""
    assert ls._row(scanner.scan("Licensed under CC BY-NC 4.0."))["labels"] == "cc-by,cc-by-nc"


def test_many_notices_in_one_text(scanner):
    row = ls._row(scanner.scan("Released under the MIT License.\n" * 3000))
    assert row["n_base"] == 3000 and len(row["spans"]) == 3000 and row["last_word"] == 2999 * 5 + 3


def test_odd_rows(table, odd_rows):
    rows = ls.license_scan(table(odd_rows)).collect()
    assert Counter((r.doc_id, *base_of(r)) for r in rows) == Counter((row[0], *plain(row[1])) for row in odd_rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert ls.license_scan(table([]).limit(0)).count() == 0


def distance_anywhere(notice, text):
    """Fewest edits that turn the notice into any part of the text, by the whole table of prefixes."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(notice, 1):
        above, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (a != b)))
    return min(row)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_found_exactly_if_some_place_is_near_enough(scanner):
    """Planted notices with fewer and more edits than the bound, against an edit distance over all places."""
    rng = random.Random(9)
    found_any = missed_any = 0
    for number, (_, notice) in enumerate(scanner.notices):
        for _ in range(12):
            planted = edited(rng, notice, rng.randint(0, scanner.edits(notice) + 3))
            joined = " ".join(f"{prose(rng.random(), 4)} {planted} {prose(rng.random(), 4)}".split())
            spans = {n: (begin, end, edits) for n, begin, end, edits in scanner._fuzzy(joined)}
            least = distance_anywhere(notice, joined)
            assert (number in spans) == (least <= scanner.edits(notice)), (notice, joined)
            if number in spans:
                begin, end, edits = spans[number]
                assert least <= distance(notice, joined[begin:end]) <= edits <= scanner.edits(notice)
                found_any += 1
            else:
                missed_any += 1
    assert found_any > 100 and missed_any > 30


def test_notices_are_a_parameter(table):
    scanner = ls.Scanner(notices={"beer": ("as long as you retain this notice you can do whatever you want",)})
    docs = table([(1, "x As long as you retain this notice, you can do whatver you want. y"), (2, "released under the mit license")])
    rows = {r.doc_id: r for r in ls.license_scan(docs, scanner).collect()}
    assert rows[1].labels == "beer" and [(s.first_word, s.words, s.edits) for s in rows[1].spans] == [(1, 13, 1)]
    assert rows[2].labels == "mit" and rows[2].spans == []

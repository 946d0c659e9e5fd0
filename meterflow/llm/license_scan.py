"""Licence notices in texts: phrases of the base list exactly, notices of the fuzzy list up to some edits.

A notice that occurs with at most k edits contains one of any k + 1 pieces of it unchanged.
One Aho-Corasick pass finds all pieces of all notices; around each hit the regex library
looks for the whole notice within its error bound and reports span and edits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import empty_if_null

# Phrases and labels of the base rule.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices, as words in lower case, by label.
NOTICES = {
    "agpl": ("gnu affero general public license",),
    "all-rights-reserved": ("all rights reserved",),
    "apache": ("licensed under the apache license version 2 0", "apache license version 2 0"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "released under the bsd license",
    ),
    "cc-by": ("creative commons attribution 4 0 international", "licensed under cc by 4 0"),
    "cc-by-nc": ("creative commons attribution noncommercial", "licensed under cc by nc 4 0"),
    "cc-by-sa": ("creative commons attribution sharealike", "licensed under cc by sa 4 0"),
    "cc0": ("creative commons zero v1 0 universal", "cc0 1 0 universal"),
    "gpl": ("gnu general public license", "licensed under the gnu general public license"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose",),
    "lgpl": ("gnu lesser general public license",),
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy"),
    "mpl": ("mozilla public license version 2 0",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 12
#: Windows around seeds whose verification a worker remembers.
REMEMBERED = 20_000

#: Upper case to lower case, and what separates words to spaces; all other bytes as they are.
BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


@dataclass(frozen=True)
class Span:
    label: str
    first: int  # word
    words: int
    edits: int
    likeness: float


class Scanner:
    """The compiled lists. Compares texts as words joined by single spaces."""

    def __init__(self, base: dict[str, str] = BASE, notices: dict[str, tuple[str, ...]] = NOTICES):
        self.base = base
        self.notices = [(label, notice) for label, some in sorted(notices.items()) for notice in some]

    def __getstate__(self):
        return {"base": self.base, "notices": self.notices}

    @staticmethod
    def edits(notice: str) -> int:
        return max(1, len(notice) // CHARS_PER_EDIT)

    @cached_property
    def _seeds(self):
        """Automaton of all pieces: for each the notices it is part of, and where."""
        import ahocorasick

        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, notice) in enumerate(self.notices):
            parts = self.edits(notice) + 1
            cuts = [len(notice) * i // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                found.setdefault(notice[a:b], []).append((number, a))
        automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            automaton.add_word(piece, (len(piece), places))
        automaton.make_automaton()
        return automaton

    @cached_property
    def _patterns(self):
        import regex

        return [
            regex.compile(f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={self.edits(notice)}}}", regex.BESTMATCH)
            for _, notice in self.notices
        ]

    @cached_property
    def _verify(self):
        @lru_cache(REMEMBERED)
        def verify(number: int, window: str) -> tuple[int, int, int] | None:
            match = self._patterns[number].search(window)
            return match and (*match.span(), sum(match.fuzzy_counts))

        return verify

    def _fuzzy(self, joined: str) -> Iterator[tuple[int, int, int, int]]:
        """Notice, begin, end and edits of every occurrence, as places in the joined words."""
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self._seeds.iter(joined):
            for number, offset in places:
                starts.setdefault(number, set()).add(end + 1 - length - offset)
        for number, guesses in starts.items():
            notice = self.notices[number][1]
            edits, done = self.edits(notice), -1
            for guess in sorted(guesses):
                if guess + len(notice) + edits <= done:
                    continue
                at = max(0, guess - edits, done)
                found = self._verify(number, joined[at : guess + len(notice) + edits])
                if found and at + found[1] > done:
                    done = at + found[1]
                    yield number, at + found[0], done, found[2]

    def _best(self, spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Spans less those that overlap a span of another label that needs fewer edits."""
        worse = set()
        for i, (_, end, number, edits) in enumerate(spans):
            for j in range(i + 1, len(spans)):
                begin, _, other, others = spans[j]
                if begin >= end:
                    break
                if self.notices[number][0] != self.notices[other][0] and edits != others:
                    worse.add(i if edits > others else j)
        return [span for i, span in enumerate(spans) if i not in worse]

    def scan(self, text: str) -> tuple[int, list[tuple[str, int]], list[Span]]:
        """Number of words, base places (label, first word) and fuzzy spans of a text, each in order."""
        words = text.encode().translate(BYTES).split()
        joined = b" ".join(words).decode()
        padded = f" {joined} "
        places = []
        for phrase, label in self.base.items():
            at = padded.find(f" {phrase} ")
            while at >= 0:
                places.append((at, label))
                at = padded.find(f" {phrase} ", at + 1)
        spans = self._best(sorted((begin, end, number, edits) for number, begin, end, edits in self._fuzzy(joined)))
        # Words are counted from one place to the next, so that many places cost no more than the text is long.
        ordered = sorted({at for at, _ in places} | {begin for begin, *_ in spans})
        word_of, last, count = {}, 0, 0
        for at in ordered:
            count += joined.count(" ", last, at)
            word_of[at], last = count, at
        return (
            len(words),
            [(label, word_of[at]) for at, label in sorted(places)],
            [
                Span(
                    self.notices[number][0],
                    word_of[begin] + (joined[begin : begin + 1] == " "),
                    len(joined[begin:end].split()),
                    edits,
                    1.0 - edits / len(self.notices[number][1]),
                )
                for begin, end, number, edits in spans
            ],
        )


FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first_word:bigint,words:bigint,edits:bigint,likeness:double>>"
)


def _row(found: tuple[int, list[tuple[str, int]], list[Span]]) -> dict:
    n_words, places, spans = found
    base, starts = {label for label, _ in places}, [word for _, word in places]
    return {
        "n_words": n_words,
        "n_base": len(places),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {span.label for span in spans})),
        "score": 1.0 if places else max((span.likeness for span in spans), default=0.0),
        "spans": [
            {"label": s.label, "first_word": s.first, "words": s.words, "edits": s.edits, "likeness": s.likeness}
            for s in spans
        ],
    }


def _scanned(spark: SparkSession, text: Column, scanner: Scanner) -> Column:
    shared = spark.sparkContext.broadcast(scanner)
    span = [("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("edits", pa.int64()), ("likeness", pa.float64())]
    kind = pa.struct(
        [(name, pa.int64()) for name in ("n_words", "n_base", "first_word", "last_word")]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct(span)))]
    )

    @F.arrow_udf(f"struct<{re.sub(r'(^|, )(\\w+) ', r'\\1\\2: ', FIELDS)}>")
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([_row(shared.value.scan(text)) for text in empty_if_null(texts)], kind)

    return scan(text)


def license_scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """`doc_id` and `FIELDS` of every row; `spans` holds the fuzzy matches with their words and edits.

    A null text has no words. Score 1 stands for a base phrase, else it is the likeness of
    the best notice (0 without any). Every row is scanned by itself, so null and repeated
    ids don't matter; an empty table gives no rows; other columns are ignored.
    """
    found = _scanned(docs.sparkSession, F.col("text"), scanner or Scanner())
    return docs.select("doc_id", found.alias("r")).select("doc_id", "r.*")

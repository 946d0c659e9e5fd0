"""Quality rules on repetition: how much of a text lies in n-grams and lines that it has had before."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import empty_if_null

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: The base rule: documents shorter than this, or with more than this percentage of words in repeated windows, fail.
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
#: The method's rules: largest share of characters in n-grams that occurred before, for each n (after Rae et al. 2021,
#: arXiv 2112.11446, table A1) ...
MOST_IN_NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: ... of characters taken by the most frequent n-gram, of those that occur more than once ...
MOST_IN_TOP = {2: 0.20, 3: 0.18, 4: 0.16}
#: ... and of characters in lines that occurred before.
MOST_IN_LINES = 0.20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Scattered 64-bit values for small numbers."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(hashes: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the n-grams, equal ones side by side in order, and whether each equals the one before it there.

    Equal hashes are compared word by word. Should two different n-grams ever share one,
    the n-grams themselves are sorted instead.
    """
    order = np.argsort(hashes, kind="stable")
    same = np.append(False, hashes[order][1:] == hashes[order][:-1])
    at = np.flatnonzero(same)
    if any((ids[order[at] + i] != ids[order[at - 1] + i]).any() for i in range(n)):
        grams = np.stack([ids[i : len(ids) - n + 1 + i] for i in range(n)])
        order = np.lexsort(grams[::-1])
        same = np.append(False, (grams[:, order[1:]] == grams[:, order[:-1]]).all(axis=0))
    return order, same


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside any of the n-grams that begin at `starts`."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return edges[:-1].cumsum() > 0


def measure(text: str) -> dict:
    """Counts of the base rule, shares of the method's rules, and the verdict."""
    raw = text.encode()
    words = raw.split()
    m = len(words)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    seen_lines: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line in seen_lines:
            dup_lines += 1
            dup_line_chars += len(line) - sum(map(line.count, BLANKS))
        elif line.strip(BLANKS):
            seen_lines.add(line)
    in_ngrams, in_top, repeat_words = dict.fromkeys(MOST_IN_NGRAMS, 0.0), dict.fromkeys(MOST_IN_TOP, 0.0), 0
    if m > 1:
        vocabulary: dict[bytes, int] = {}
        ids = np.fromiter((vocabulary.setdefault(word, len(vocabulary)) for word in words), np.int64, m)
        if text.isascii():
            lengths = np.fromiter(map(len, words), np.int64, m)
        else:
            lengths = np.fromiter((len(word.decode()) for word in words), np.int64, m)
        values = _mixed(ids)
        rolling = values
        for n in range(2, min(m, max(MOST_IN_NGRAMS)) + 1):
            rolling = rolling[:-1] * MULTIPLIER + values[n - 1 :]
            if n not in in_ngrams and n not in in_top and n != WINDOW:
                continue
            order, same = groups(rolling, ids, n)
            again = np.flatnonzero(same)
            if not len(again):
                break  # no longer n-gram is repeated either
            if n in in_ngrams:
                in_ngrams[n] = float(lengths[_covered(order[again], n, m)].sum() / word_chars)
            if n == WINDOW:
                repeat_words = int(_covered(np.concatenate([order[again], order[again - 1]]), n, m).sum())
            if n in in_top:
                counts = np.bincount(np.cumsum(~same) - 1)
                top = int(counts.argmax())
                inside = _covered(order[np.cumsum(~same) - 1 == top], n, m)
                in_top[n] = float(lengths[inside].sum() / word_chars)
    base_failed = m < LEAST_WORDS or 100 * repeat_words > MOST_REPEATED * m
    in_lines = dup_line_chars / word_chars if word_chars else 0.0
    repetitive = (
        in_lines > MOST_IN_LINES
        or any(in_ngrams[n] > most for n, most in MOST_IN_NGRAMS.items())
        or any(in_top[n] > most for n, most in MOST_IN_TOP.items())
    )
    return {
        "n_words": m,
        "word_chars": word_chars,
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "base_failed": base_failed,
        "in_ngrams": max(in_ngrams.values()),
        "in_top": max(in_top.values()),
        "in_lines": in_lines,
        "kept": not base_failed and not repetitive,
    }


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, in_ngrams double, in_top double, in_lines double, kept boolean"
)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """`doc_id` and `FIELDS` of every row.

    A null text has no words, like an empty one, and fails the base rule. Every row is
    judged by itself, so null and repeated ids don't matter; an empty table gives no rows;
    other columns are ignored. Lines without a word never count as repeated.
    """
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    row = pa.struct([(name, kinds[kind]) for name, kind in (field.split() for field in FIELDS.split(", "))])

    @F.arrow_udf(f"struct<{FIELDS.replace(' ', ': ').replace(',:', ',')}>")
    def judge(texts: pa.Array) -> pa.Array:
        return pa.array([measure(text) for text in empty_if_null(texts)], row)

    return docs.select("doc_id", judge("text").alias("r")).select("doc_id", "r.*")

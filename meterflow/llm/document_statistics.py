"""Statistics of a text that tell prose from junk, computed with numpy over its code points and words."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Junk often fills a part of a text only, so shares are also taken over runs of so many words.
WINDOW = 40
UPPER, LETTER, DIGIT, SPACE, SYMBOL, STOP, OTHER, WIDE = (1 << i for i in range(8))
SYMBOLS, STOPS = "#*$%&|<>@^~=+_\\{}[]/", ".!?:;,\"'»…"

NAMES = [
    "log_chars", "upper", "letter", "digit", "space", "symbol", "stop", "other", "wide",
    "log_words", "mean_length", "sd_length", "longest", "distinct", "top_word", "adjacent", "short",
    "all_upper", "with_symbol", "without_letter", "with_stop", "repeated_pairs", "repeated_triples",
    "upper_window", "symbol_window", "adjacent_window", "bare_window", "stop_window", "distinct_window",
    "symbol_windows", "upper_windows", "adjacent_windows",
    "log_lines", "repeated_lines", "mean_line", "exclaimed", "barred",
]


@cache
def _kinds() -> np.ndarray:
    """Kinds of the characters up to U+FFFF; all beyond count as wide ones."""
    kinds = np.zeros(0x10001, np.uint8)
    for code in range(0x10000):
        c = chr(code)
        kind = UPPER | LETTER if c.isupper() else LETTER if c.isalpha() else DIGIT if c.isdigit() else SPACE if c.isspace() else 0
        kind |= SYMBOL if c in SYMBOLS else STOP if c in STOPS else 0
        kinds[code] = (kind or OTHER) | (WIDE if code > 0x24F else 0)
    kinds[0x10000] = WIDE
    return kinds


def _repeated(ids: np.ndarray, n: int) -> float:
    """Share of the n-grams that occurred before."""
    if len(ids) < n:
        return 0.0
    key = ids[: len(ids) - n + 1].astype(np.int64)
    for i in range(1, n):
        key = key * 1_000_003 + ids[i : len(ids) - n + 1 + i]
    return 1.0 - len(np.unique(key)) / len(key)


def statistics(text: str) -> np.ndarray:
    """The values of `NAMES`; zeros for a text without words."""
    out = np.zeros(len(NAMES), np.float32)
    words = text.split()
    if not words:
        return out
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = _kinds()[np.minimum(codes, 0x10000)]
    n, m = len(codes), len(words)
    shares = [np.count_nonzero(kinds & kind) / n for kind in (UPPER, LETTER, DIGIT, SPACE, SYMBOL, STOP, OTHER, WIDE)]
    blank = (kinds & SPACE) != 0
    inside = ~blank
    starts = np.flatnonzero(inside & np.append(True, blank[:-1]))
    found = np.bitwise_or.reduceat(kinds, starts)
    lengths = np.fromiter(map(len, words), np.int32, m)
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int32, m)
    adjacent = np.append(False, ids[1:] == ids[:-1])
    lower = np.bitwise_or.reduceat(np.where((kinds & (LETTER | UPPER)) == LETTER, 1, 0).astype(np.uint8), starts)
    letter = (found & LETTER) != 0
    all_upper = letter & (lower == 0) & (lengths > 1)
    symbol, stop = (found & SYMBOL) != 0, (found & STOP) != 0
    edges = np.arange(0, m, WINDOW)
    sizes = np.diff(np.append(edges, m))
    per = [np.add.reduceat(flag, edges, dtype=np.int32) / sizes for flag in (all_upper, symbol, adjacent, ~letter, stop)]
    first_here = np.append(True, np.zeros(m - 1, bool))
    if m > 1:
        order = np.lexsort((np.arange(m), ids, np.arange(m) // WINDOW))
        same = (ids[order][1:] == ids[order][:-1]) & (order[1:] // WINDOW == order[:-1] // WINDOW)
        first_here[order] = np.append(True, ~same)
    distinct = np.add.reduceat(first_here, edges, dtype=np.int32) / sizes
    full = sizes >= min(WINDOW, m) // 2
    lines = [line for line in text.split("\n") if line.strip()]
    out[:] = [
        np.log1p(n), *shares,
        np.log1p(m), lengths.mean(), lengths.std(), np.log1p(lengths.max()), len(seen) / m,
        np.bincount(ids).max() / m, adjacent.mean(), (lengths <= 3).mean(),
        all_upper.mean(), symbol.mean(), 1 - letter.mean(), stop.mean(), _repeated(ids, 2), _repeated(ids, 3),
        *[share[full].max() for share in per[:4]], per[4][full].min(), distinct[full].min(),
        (per[1] > 0.3).mean(), (per[0] > 0.3).mean(), (per[2] > 0.3).mean(),
        np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        text.count("!") / m, text.count("|") / m,
    ]
    return out

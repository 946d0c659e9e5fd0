"""Suffix automata of symbol sequences, as flat transition tables that numpy walks for many texts at once."""

from __future__ import annotations

import numpy as np

#: Fills up a piece: changes no state and ends no phrase.
PAD = 0
#: Texts are walked in pieces of so many symbols, so many side by side.
PIECE, ABREAST = 512, 8_192
#: Symbols after which pieces that are walked again are looked through for those that are done.
LOOK = 32


def transitions(symbols: list[int]) -> list[dict[int, int]]:
    """The automaton that accepts exactly the substrings of a sequence: per state, the state after each symbol."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in after[state]:
            after[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = after[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(after)
                after.append(dict(after[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                link[target] = link[new] = copy
                while state >= 0 and after[state].get(symbol) == target:
                    after[state][symbol] = copy
                    state = link[state]
        last = new
    return after


def parse_table(symbols: list[int], width: int, base: int) -> np.ndarray:
    """Steps of a parse into longest matches, for all states and symbols in one flat array.

    An entry is the place (from `base` on) of the row to go to. If no match goes on with the
    symbol, the phrase ends: the entry is the complement of the row to start again from,
    which is the root's own step, or the root itself for a symbol that never occurs.
    """
    after = transitions(symbols)
    table = np.empty((len(after), width), np.int32)
    restart = np.full(width, ~base, np.int32)
    for symbol, state in after[0].items():
        restart[symbol] = ~(base + state * width)
    table[:] = restart
    table[:, PAD] = base + np.arange(len(after)) * width
    for state, steps in enumerate(after):
        for symbol, target in steps.items():
            table[state, symbol] = base + target * width
    return table.reshape(-1)


def phrases(table: np.ndarray, roots: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Number of phrases of each text (rows) in each language (columns; `roots` are their rows in the table).

    Pieces of texts are walked side by side, each from the root. A phrase may run over the
    end of a piece, so a piece whose predecessor did not end at the root is walked again from
    where that ended, until it meets its first walk: from there on both are the same. If a
    piece ends elsewhere by that, its successor is walked again too.
    """
    counts = np.array([-(-len(text) // PIECE) for text in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    padded = np.full((int(counts.sum()), PIECE), PAD, np.uint8)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        padded[at : at + n].reshape(-1)[: len(text)] = text
        at += n
    begin = np.repeat(roots[None, :].astype(np.int32), len(padded), axis=0)
    end, ended = np.empty_like(begin), np.zeros(begin.shape, np.int64)
    for first in range(0, len(padded), ABREAST):
        part = slice(first, first + ABREAST)
        end[part], ended[part] = _walk(table, padded[part], begin[part])
    later = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # pieces that continue a text
    moved = later
    while len(moved):
        moved = moved[(begin[moved] != end[moved - 1]).any(axis=1)]
        before = end[moved].copy()
        for first in range(0, len(moved), ABREAST):
            part = moved[first : first + ABREAST]
            _walk_again(table, padded, part, begin, end, ended, end[part - 1])
        changed = moved[(before != end[moved]).any(axis=1)]
        moved = np.intersect1d(changed + 1, later)
    total = np.zeros((len(texts), len(roots)), np.int64)
    np.add.at(total, owner, ended)
    last = np.cumsum(counts)[counts > 0] - 1
    total[counts > 0] += end[last] != roots
    return total


def _step(table: np.ndarray, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after a symbol each, and -1 where that ended a phrase."""
    step = table[state + symbols]
    sign = step >> 31
    return step ^ sign, sign


def _walk(table: np.ndarray, pieces: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces end that begin in some states, and the phrases that ended in them."""
    state, ended = np.ascontiguousarray(begin.T), np.zeros(begin.T.shape, np.int32)
    for symbols in np.ascontiguousarray(pieces.T):
        state, sign = _step(table, state, symbols)
        ended -= sign
    return state.T, ended.T


def _walk_again(table, padded, part, begin, end, ended, carried) -> None:
    """Begin pieces in the states carried into them instead; corrects `begin`, `end` and `ended`."""
    old, new = np.ascontiguousarray(begin[part].T), np.ascontiguousarray(carried.T)
    begin[part] = carried
    left = np.arange(len(part))
    more = np.zeros(new.shape, np.int64)
    for at in range(0, PIECE, LOOK):
        pieces = np.ascontiguousarray(padded[part[left], at : at + LOOK].T)
        for symbols in pieces:
            old, sign_old = _step(table, old, symbols)
            new, sign_new = _step(table, new, symbols)
            more[:, left] += sign_old - sign_new
        apart = (old != new).any(axis=0)
        old, new, left = old[:, apart], new[:, apart], left[apart]
        if not len(left):
            break
    ended[part] += more.T
    end[part[left]] = new.T

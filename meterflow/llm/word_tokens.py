"""Token ids by the tokenizers library, with each distinct word encoded once per worker, as far as memory allows."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from meterflow.llm.memo import Memo

#: Words remembered, twice at most, if they are not longer.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64
#: Bytes of text that are split together, or one text.
TOGETHER = 4_000_000
#: Latin text in which normalisation is lower-casing: no combining marks, no odd spaces, no letter that changes length.
PLAIN = "\t\n\r\x20-\x7e\xa1-įı-ſ"
LATIN = [chr(code) for code in (*range(0x20, 0x7F), *range(0xA1, 0x180))]
LETTERS = "".join(c for c in LATIN if c.isalpha())
NUMBERS = "".join(c for c in LATIN if c.isnumeric())
BLANK = r"\t\n\r "
PRE_TOKENS = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANK}{LETTERS}{NUMBERS}]+"


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(0x100 + i) for i, byte in enumerate(hidden)}


class WordTokens:
    """A tokenizer whose pre-tokens are letters, single digits or other signs, split at white space."""

    def __init__(self, definition: str):
        self.definition = definition

    def __getstate__(self):
        return {"definition": self.definition}

    @cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.definition)

    @cached_property
    def merges(self):
        """The library's model alone, for text that is split and normalised already."""
        return self.library.model

    @cached_property
    def _split(self):
        return re.compile(PRE_TOKENS).findall

    @cached_property
    def _odd(self) -> str:
        """Finds what only the library treats rightly: signs that are not plain, and names of added tokens in any case."""
        added = [re.escape(token.content) for token in self.library.get_added_tokens_decoder().values()]
        return "|".join([f"[^{PLAIN}]", *(f"(?i:{name})" for name in added)])

    @cached_property
    def _letters(self) -> dict[int, str]:
        return _byte_letters()

    @cached_property
    def _memo(self) -> Memo:
        return Memo(self._encode_new, REMEMBERED, LONGEST_REMEMBERED)

    def _encode_new(self, words: list[str]) -> list[bytes]:
        """No pre-token holds white space, so those of a text are those of its words."""
        split = list(map(self._split, words))
        known = {piece: self._encode_piece(piece) for piece in set(chain.from_iterable(split))}.__getitem__
        return [b"".join(map(known, pieces)) for pieces in split]

    def _encode_piece(self, piece: str) -> bytes:
        if not piece.isascii():  # signs of ASCII, blanks aside, stand for themselves
            piece = piece.encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self.merges.tokenize(piece)]).tobytes()

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._encode_some(pa.array(held, pa.string()))
                held, size = [], 0
        yield from self._encode_some(pa.array(held, pa.string()))

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """As `encode`, from a column of texts; null texts are empty ones."""
        texts = pc.fill_null(texts, "")
        part = np.cumsum(pc.binary_length(texts).to_numpy(), dtype="i8") // TOGETHER
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for begin, stop in zip(cuts, cuts[1:]):
            yield from self._encode_some(texts[begin:stop])

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode_some(self, texts: pa.Array) -> Iterator[np.ndarray]:
        odd = pc.match_substring_regex(texts, self._odd)
        ids, cuts = self._encode_plain(texts.filter(pc.invert(odd)))
        wholes, spans = map(self._whole, texts.filter(odd).to_pylist()), zip(cuts, cuts[1:])
        for is_odd in odd.to_pylist():
            yield next(wholes) if is_odd else ids[slice(*next(spans))]

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, list[int]]:
        """The ids of texts, end to end, and the places where texts begin and end."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._memo.known(words).__getitem__, words))
        sizes = np.fromiter(map(len, found), "i8", len(found)) // 4
        word = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[word])])
        shift = (np.cumsum(sizes) - sizes)[word] - ends[:-1]
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(shift, sizes[word]) + np.arange(ends[-1])]
        return ids, ends[split.offsets.to_numpy()].tolist()

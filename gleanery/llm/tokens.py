"""Token ids of texts by a public tokenizer file, fast where words repeat."""

from __future__ import annotations

import functools
import gc
import os
import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np

from .common import KEPT, coded_words, ragged, runs_of

#: Characters below U+0250 by the classes of the splitting pattern (fixed values): letters,
#: numbers and white space; white space beyond that range.
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBER = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACE = "\\x09-\\x0d\\x20\x85\xa0"
_FAR_SPACE = "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Is there a character that the classes above don't cover?
_FAR = re.compile("[^\\x00-\u024f]")
#: The splitting pattern of byte-level BPE over these classes (a fixed value).
_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: For other texts: no piece reaches over the beginning of these larger parts, which the
#: library splits itself.
_PARTS = re.compile(f" ?[^{_SPACE}{_FAR_SPACE}]+|[{_SPACE}{_FAR_SPACE}]+"
                    f"(?![^{_SPACE}{_FAR_SPACE}])|[{_SPACE}{_FAR_SPACE}]+")


def _split(text: str) -> list[str]:
    if not _FAR.search(text):
        return _PIECES.findall(text)
    return [piece for part in _PARTS.findall(text)
            for piece in ((part,) if _FAR.search(part) else _PIECES.findall(part))]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it is printable, else the next free."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class Encoder:
    """Encodes texts with the tokenizers library, each distinct piece of a text once.

    The tokenizer must be byte-level BPE with the usual splitting pattern. The
    ids of pieces are remembered up to `most_pieces` (a bound of memory, not of
    results: beyond it the memory starts anew).
    """

    def __init__(self, path: str, most_pieces: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.id_type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.most_pieces = most_pieces
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        #: The number of each piece, and where the ids of that number lie in `table`.
        self.known: dict[str, int] = {}
        self.starts = self.lengths = np.zeros(0, dtype=np.int64)
        self.table = np.zeros(0, dtype=self.id_type)

    def _merged(self, piece: str) -> list[int]:
        """Ids of one piece: in an ordinary piece the merges of the model, else the library's own."""
        if _FAR.search(piece):
            return self.tokenizer.encode([piece], is_pretokenized=True, add_special_tokens=False).ids
        if piece.isascii() and piece.isprintable():
            line = piece.replace(" ", self.letters[0x20])
        else:
            line = piece.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.tokenizer.model.tokenize(line)]

    def _learn(self, pieces: list[str]) -> None:
        found = [self._merged(piece) for piece in pieces]
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for one in found for i in one), self.id_type, int(lengths.sum()))
        self.starts = np.concatenate([self.starts, len(self.table) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.table = np.concatenate([self.table, ids])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ends of the texts in it)."""
        # many small objects and no cycles: the cycle collector would only walk them
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, distinct, ends = coded_words(texts, _split)
        if len(self.known) > self.most_pieces:
            self._forget()
        if not len(codes):
            return self.table[:0], np.zeros(len(texts), dtype=np.int64)
        of_piece = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(of_piece < 0)
        of_piece[new] = len(self.known) + np.arange(len(new))
        if len(new):
            self._learn([distinct[i] for i in new.tolist()])
        number = of_piece[codes]
        lengths = self.lengths[number]
        ids = self.table[ragged(self.starts[number], lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[ends]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker, until another operator runs there."""
    return Encoder(path)


KEPT.append(encoder.cache_clear)


def encoded(path: str, texts: Sequence[str | None], end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text with `end_id` behind them; a null text is empty."""
    coder = encoder(path)
    texts = [t if isinstance(t, str) else "" for t in texts]
    last = np.array([end_id], dtype=coder.id_type)
    for part in runs_of(texts):
        ids, ends = coder.encode(texts[part])
        start = 0
        for end in ends.tolist():
            yield np.concatenate([ids[start:end], last])
            start = end


def encoded_runs(path: str, texts: Sequence[str | None], end_id: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """For runs of texts: (their slice, the ids of all in a row with `end_id` behind each text, as
    little-endian unsigned 32-bit integers, and the ends of the texts in it)."""
    coder = encoder(path)
    texts = [t if isinstance(t, str) else "" for t in texts]
    for part in runs_of(texts):
        ids, ends = coder.encode(texts[part])
        ends = ends + np.arange(1, len(ends) + 1)
        out = np.empty(len(ids) + len(ends), dtype="<u4")
        inside = np.ones(len(out), dtype=bool)
        inside[ends - 1] = False
        out[inside], out[ends - 1] = ids, end_id
        yield part, out, ends

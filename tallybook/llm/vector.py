"""Texts of a whole Arrow batch at once: words and segments as codes into a dictionary of distinct strings.

All functions work on a slice of a batch: the bytes of its texts one after the other (``buf``) and where each text begins
(``offs``, one more than texts).  A slice holds about ``SLICE_BYTES``, or one text if that is longer, so memory does not
depend on the size of a batch.  NULL texts are empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: 1 for the letters A-Z and a-z, 2 for marks that end phrases.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = 1
_KIND[[*b".,;:!?"]] = 2


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of the first text, buf, offs) of slices of a column of texts, in order; none for an empty column."""
    row = 0
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if not len(chunk):
            continue
        chunk = pc.fill_null(chunk.cast(pa.large_string()), "")
        _, offsets, data = chunk.buffers()
        offs = np.frombuffer(offsets, dtype=np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
        a = 0
        while a < len(chunk):
            b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1)
            yield row + a, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
            a = b
        row += len(chunk)


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The strings between ``offsets`` of ``data``."""
    own = np.ascontiguousarray(data)
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(own))


def _encode(found: pa.Array) -> tuple[np.ndarray, pa.Array]:
    if not len(found):
        return np.zeros(0, dtype=np.int64), found
    coded = found.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def mark_cuts(buf: np.ndarray) -> np.ndarray:
    """Bytes before which a letter of A-Z meets a mark or a mark meets a letter."""
    kind = _KIND[buf]
    out = np.zeros(len(buf), dtype=bool)
    out[1:] = kind[1:] * kind[:-1] == 2
    return out


def word_bounds(buf: np.ndarray, offs: np.ndarray, blank: np.ndarray = BLANK, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are not ``blank``, never over two texts), and which bytes are in words.

    ``cut``: bytes before which a word ends and another one begins as well.
    """
    inside = ~blank[buf]
    first, last = inside.copy(), inside.copy()
    if len(buf):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin = offs[:-1][offs[:-1] < len(buf)]
        first[begin] = inside[begin]
        last[begin[begin > 0] - 1] = inside[begin[begin > 0] - 1]
        if cut is not None:
            first |= cut & inside
            last[:-1] |= cut[1:] & inside[:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1, inside


def word_codes(buf: np.ndarray, offs: np.ndarray, blank: np.ndarray = BLANK, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Code of each word, where each text's words begin (one more than texts), the distinct words, start of each word."""
    starts, ends, inside = word_bounds(buf, offs, blank, cut)
    codes, values = _encode(strings(buf[inside], np.concatenate([[0], np.cumsum(ends - starts)])))
    return codes, np.searchsorted(starts, offs), values, starts


def segment_codes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Like ``word_codes`` for segments that cover the texts without a gap.

    A run of blanks before a word is cut before its last blank; if that is a space it goes with the word, else it is
    a segment of its own.  A run at the end of a text is one segment.  Words are cut between letters and marks.
    """
    starts, ends, _ = word_bounds(buf, offs)
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[offs] = cut[ends] = True
    begin = np.zeros(len(buf) + 1, dtype=bool)
    begin[offs] = True
    after = starts[~begin[starts]]  # these have a blank before them
    cut[after - 1] = True
    cut[after[buf[after - 1] != 0x20]] = True
    cut[:-1] |= mark_cuts(buf)
    cut[starts[begin[starts]]] = True
    at = np.flatnonzero(cut)
    codes, values = _encode(strings(buf, at)) if len(buf) else (np.zeros(0, dtype=np.int64), pa.array([], pa.large_string()))
    return codes, np.searchsorted(at, offs), values


def sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offs[1:]] - total[offs[:-1]]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all the pieces (start, length) of an array, one piece after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


#: Letters that byte-level steps leave as they are but for their spelling: lower and upper case of Latin-1, all composed.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Spelling of a byte in byte-level vocabularies: a printed character is itself, the others follow from U+0100 on.
_SPELLING = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def byte_level(word: str) -> str:
    return word.encode().decode("latin-1").translate(_SPELLING)


class Recent:
    """A cache of at most about twice ``size`` entries, of which those used lately stay when it is full."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def find(self, keys: list[str], make: Callable[[list[str]], list], longest: int = 64, part: int = 4096) -> list:
        """The value of each key; ``make`` gives the values of keys that aren't known.  Keys over ``longest`` characters aren't kept."""
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        out = [new.get(k) for k in keys]
        missed = []
        for i in [i for i, v in enumerate(out) if v is None]:
            value = old.get(keys[i])
            if value is None:
                missed.append(i)
            else:
                out[i] = new[keys[i]] = value
        for a in range(0, len(missed), part):
            at = missed[a : a + part]
            for i, value in zip(at, make([keys[i] for i in at])):
                out[i] = value
                if len(keys[i]) <= longest:
                    new[keys[i]] = value
        return out

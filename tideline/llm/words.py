"""Words of whole Arrow text columns as arrays of positions and 64-bit codes.

A batch's UTF-8 bytes are cut into words by a table of separator bytes (all separators are ASCII, so
this never cuts a character) and every word gets a 64-bit code, a polynomial of its bytes modulo 2**64.
Runs of k words get codes the same way from the words' codes. All of it is arithmetic on whole arrays,
so its cost is a few nanoseconds a byte. Equal words have equal codes; callers which need certainty
compare the bytes of what the codes found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about so many bytes; one longer text is one slice.
SLICE_BYTES = 500_000

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_BYTE_CODES = np.random.default_rng(20_240_601).integers(1, 2**64, 256, dtype=np.uint64)


def byte_table(separators: str) -> np.ndarray:
    """A table that is True at the bytes of the given ASCII characters."""
    table = np.zeros(256, bool)
    table[list(separators.encode("ascii"))] = True
    return table


#: Space and the controls 0x09 to 0x0D.
WHITE = byte_table(" \t\n\v\f\r")
#: Everything in ASCII but digits and lower-case letters, as for folded text.
NOT_ALNUM = byte_table("".join(map(chr, range(128))))
NOT_ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = False

#: Maps A-Z to a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, made once for each length."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)], dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _span_codes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


@dataclass
class Words:
    """Words of some texts: `data[starts[i]:ends[i]]` is word i; those of text d are `first[d]:first[d + 1]`."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    codes: np.ndarray

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of k words within one text, and the runs' codes."""
        n = np.diff(self.first)
        fits = np.ones(len(self.codes), bool)
        last = np.repeat(self.first[1:], n)  # of each word: the end of its text
        fits &= np.arange(len(self.codes)) + k <= last
        at = np.flatnonzero(fits)
        return at, mix(_span_codes(self.codes, at, at + k, _word_powers)) if len(at) else np.zeros(0, np.uint64)

    def text_codes(self) -> np.ndarray:
        """A code of the whole word sequence of each text."""
        return mix(_span_codes(self.codes, self.first[:-1], self.first[1:], _word_powers) + mix(np.diff(self.first).astype(np.uint64)))

    def joined(self, a: int, b: int) -> bytes:
        """Words a to b joined by single spaces."""
        return b" ".join(bytes(self.data[s:e]) for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True))


def cut(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE, fold: bool = False) -> Words:
    """Words of the texts `data[offsets[d]:offsets[d + 1]]`."""
    if fold:
        data = FOLD[data]
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(separators[data], out=inside[1:-1])
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] = inside[1:-1][edges]
    end[edges - 1] = inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    codes = mix(_span_codes(_BYTE_CODES[data], starts, ends, _byte_powers) + (ends - starts).astype(np.uint64)) if len(starts) else np.zeros(0, np.uint64)
    return Words(data, starts, ends, np.searchsorted(starts, offsets).astype(np.int64), codes)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about `most` bytes; null is an empty text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, len(texts))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def per_text(covered: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a value of each word over each text."""
    sums = np.zeros(len(covered) + 1, np.int64)
    np.cumsum(covered, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def covered_words(n: int, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of n words lie in a span that starts at one of `at`."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    return np.cumsum(edges[:-1]) > 0


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) of each run of `width` values."""
    span = 1
    while span * 2 <= width:
        x = least(x[:-span], x[span:])
        span *= 2
    return least(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def winnow(codes: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Places of the least codes: every `width` neighbouring codes of one text hold one that is chosen.

    The choice depends on those codes alone, so texts with such a run in common have a chosen code in common.
    """
    n = len(codes)
    if n < width:
        return np.zeros(0, np.int64)
    codes = np.maximum(codes, np.uint64(1))
    least = sliding(codes, width, np.minimum)
    least[text[: n - width + 1] != text[width - 1 :]] = 0
    around = np.zeros(n + width - 1, np.uint64)
    around[width - 1 :][: len(least)] = least  # at width - 1 + i: the run that starts at i
    return np.flatnonzero(sliding(around, width, np.maximum) == codes)

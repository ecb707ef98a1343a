"""Vectorised text helpers over Arrow batches.

A batch of texts is seen as one uint8 buffer with document offsets, so words, word hashes and
n-gram hashes of thousands of documents come out of a handful of numpy passes. A word is a maximal
run of bytes that the folding table maps to something other than 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_B = 0x9E3779B97F4A7C15 | 1
_BINV = pow(_B, -1, 1 << 64)
CHUNK_BYTES = 1 << 20

#: Byte tables: raw keeps bytes and splits on ASCII white space; folded lowers ASCII and splits on all but letters, digits and non-ASCII.
RAW = np.arange(256, dtype=np.uint8)
RAW[[0, 9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 0
FOLDED = np.zeros(256, np.uint8)
FOLDED[128:] = np.arange(128, 256)
for _c in range(128):
    if chr(_c).isalnum():
        FOLDED[_c] = ord(chr(_c).lower())


def powers(n: int, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """At least n powers of the hash base, and of its inverse, mod 2^64."""
    if _kept.get("n", 0) < n:
        n = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            for k, b in (("p", _B), ("i", _BINV)):
                a = np.full(n, b, U64)
                a[0] = 1
                _kept[k] = np.cumprod(a, dtype=U64)
        _kept["n"] = n
    return _kept["p"], _kept["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> U64(30))
        h = h * U64(0xBF58476D1CE4E5B9)
        h ^= h >> U64(27)
        h = h * U64(0x94D049BB133111EB)
        h ^= h >> U64(31)
    return h


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows, from 0; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about `most` bytes of text, one row at least, with their bytes and offsets."""
    for batch in batches:
        b, o = strings(batch.column(batch.schema.get_field_index(text)))
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(o, o[at] + most, "right")) - 1)
            yield batch.slice(at, to - at), b[o[at] : o[to]], o[at : to + 1] - o[at]
            at = to


class Words:
    """starts, ends: byte positions; first: index of each document's first word, with the count at the end; hashes; doc."""

    def __init__(self, b: np.ndarray, offsets: np.ndarray, table: np.ndarray = RAW):
        v = table[b]
        if table is FOLDED and len(b):
            # Latin-1 capitals in UTF-8 (C3 80..9E) fold to C3 A0..BE
            cap = np.flatnonzero(b == 0xC3)
            cap = cap[cap + 1 < len(b)] + 1
            cap = cap[(b[cap] >= 0x80) & (b[cap] <= 0x9E) & (b[cap] != 0x97)]
            v[cap] |= 0x20
        on = np.zeros(len(b) + 2, bool)
        on[1:-1] = v != 0
        edge = on[1:] != on[:-1]
        # a document's end also ends a word
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(b))]
        both = np.unique(cut[on[cut] & on[cut + 1]]) if len(cut) else cut
        at = np.flatnonzero(edge)
        self.starts, self.ends = at[::2], at[1::2]
        if len(both):
            self.starts = np.sort(np.concatenate([self.starts, both]))
            self.ends = np.sort(np.concatenate([self.ends, both]))
        self.first = np.searchsorted(self.starts, offsets, "left")
        p, i = powers(len(b) + 1)
        with np.errstate(over="ignore"):
            s = np.zeros(len(b) + 1, U64)
            np.cumsum(v.astype(U64) * p[: len(b)], out=s[1:])
            self.hashes = mix((s[self.ends] - s[self.starts]) * i[self.starts] + (self.ends - self.starts).astype(U64))
        self._sums, self._inverse = s, i

    def heads(self, n: int) -> np.ndarray:
        """Hash of the first n bytes of each word."""
        ends = np.minimum(self.ends, self.starts + n)
        with np.errstate(over="ignore"):
            return mix((self._sums[ends] - self._sums[self.starts]) * self._inverse[self.starts] + U64(n << 32))

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each word on, and whether they lie in one document."""
    h = words.hashes
    total = len(h)
    out = np.zeros(total, U64)
    with np.errstate(over="ignore"):
        for j in range(n):
            m = total - j
            if m > 0:
                out[:m] = out[:m] * U64(_B) + h[j:]
    last = np.repeat(words.first[1:], np.diff(words.first))
    return mix(out), np.arange(total) + n <= last


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i+w]; shorter at the end by w - 1."""
    if len(x) < w:
        return x[:0]
    have, step = x, 1
    while step * 2 <= w:
        have = np.minimum(have[: len(have) - step], have[step:])
        step *= 2
    n = len(x) - w + 1
    return np.minimum(have[:n], have[w - step : w - step + n])


def take_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all the ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return skip + np.arange(total)


def characters(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8, and their byte positions."""
    at = np.flatnonzero((b & 0xC0) != 0x80)
    out = b[at].astype(np.int64)
    many = np.flatnonzero(out >= 0xC0)
    if len(many):
        x, k, c = np.concatenate([b, np.zeros(3, np.uint8)]).astype(np.int64), at[many], out[many]
        d, e, f = x[k + 1] & 63, x[k + 2] & 63, x[k + 3] & 63
        out[many] = np.where(c < 0xE0, (c & 31) << 6 | d, np.where(c < 0xF0, (c & 15) << 12 | d << 6 | e, (c & 7) << 18 | d << 12 | e << 6 | f))
    return out, at

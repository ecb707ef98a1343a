"""Substring dedup with a compressed FM-index per shard.

Every shard holds the pieces of text that share an anchor with another document (see _passages) in an
FM-index: the Burrows-Wheeler transform of their words, in a wavelet tree (in its matrix form: one bit
vector with ranks for each bit of a symbol). The pieces are then streamed against the index, many in
lockstep. Backward search extends a match leftwards while the interval of rows holds two documents, so
its length is the matching statistic against other documents; a search that fails at a word rules out
all windows that hold the failing piece, so clean text costs a few steps for `least` words. Reported are
the unions of all windows of `least` words that occur in another document.

Suffixes are sorted to the depth of the longest pattern, which is all that backward search needs.

Defined results: null ids, null texts and texts shorter than `least` words give nothing; rows that share
a doc_id are one document, so a passage that repeats only among them is not reported; words compare byte
for byte; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import _passages
from ._batch import take_ranges
from ._passages import Pieces

U64 = np.uint64
#: Probes of a piece after which its windows are searched one by one, all at once.
PROBES = 12


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of s ordered by the next `depth` symbols or more, by prefix doubling from four symbols on."""
    n = len(s)
    t = np.zeros(n + 4, U64)
    t[:n] = s
    key = t[:n] << U64(48) | t[1 : n + 1] << U64(32) | t[2 : n + 2] << U64(16) | t[3 : n + 3]
    have = 4
    while True:
        sa = np.argsort(key)
        k = key[sa]
        new = np.zeros(n, np.int64)
        new[1:] = k[1:] != k[:-1]
        np.cumsum(new, out=new)
        if have >= depth or new[-1] == n - 1:
            return sa
        rank = np.zeros(n + have, U64)
        rank[sa] = new.astype(U64) + U64(1)
        key = rank[:n] << U64(32) | rank[have : n + have]
        have *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector with counts for each bit, from the highest."""

    def __init__(self, s: np.ndarray, sigma: int):
        n, self.levels = len(s), max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        x = s.astype(np.uint16)
        for level in range(self.levels):
            bit = (x >> (self.levels - 1 - level)) & 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: (n + 7) // 8] = np.packbits(bit.astype(np.uint8), bitorder="little")
            w = packed.view(U64)
            c = np.zeros(len(w), np.int32)
            np.cumsum(np.bitwise_count(w)[:-1], out=c[1:])
            one = bit.astype(bool)
            x = np.concatenate([x[~one], x[one]])
            self.words.append(w)
            self.counts.append(c)
            self.zeros.append(n - int(one.sum()))
        self.base = self._follow(np.arange(sigma), np.zeros(sigma, np.int64))

    def _follow(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            w = i >> 6
            ones = self.counts[level][w] + np.bitwise_count(self.words[level][w] & ((U64(1) << (i & 63).astype(U64)) - U64(1)))
            i = np.where((c >> (self.levels - 1 - level)) & 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before i."""
        return self._follow(c, i) - self.base[c]


class FMIndex:
    """Index of distinct pieces of text, each with the least and the greatest of its documents.

    Its symbols are the words' hashes made dense; 0 separates pieces.
    """

    def __init__(self, p: Pieces, low: np.ndarray, high: np.ndarray, depth: int):
        n = self.n = len(p.symbols) + len(p.lengths)
        size = p.lengths.astype(np.int64) + 1
        at = np.cumsum(size)
        self.begin = at - size
        own = np.ones(n, bool)
        own[at - 1] = False
        present = np.zeros(1 << 16, bool)
        present[p.symbols] = True
        dense = np.cumsum(present)
        self.text = np.zeros(n, np.int64)
        self.text[own] = dense[p.symbols]
        sigma = int(dense[-1]) + 1
        sa = suffix_order(self.text, depth)
        self.tree = WaveletMatrix(self.text[sa - 1], sigma)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=sigma))])
        piece = np.repeat(np.arange(len(size)), size)[sa]
        low, many = low[piece], (low != high)[piece]
        change = np.append(np.flatnonzero((low[1:] != low[:-1]) | many[1:] | many[:-1]) + 1, n)
        #: the end of the shortest interval from a row on that holds two documents
        self.two = np.append(np.repeat(change, np.diff(np.concatenate([[0], change]))) + 1, n + 1)
        self.two[:-1][many] = np.flatnonzero(many) + 1

    def back(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One step of backward search by the symbols at `at`: the new intervals, and whether they hold two documents."""
        m, c = len(at), np.tile(self.text[at], 2)
        r = self.less[c] + self.tree.rank(c, np.concatenate([lo, hi]))
        lo, hi = r[:m], r[m:]
        return lo, hi, self.two[lo] <= hi


def match(p: Pieces, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, last): runs of windows that two documents hold, in words of the document.

    Equal pieces are indexed and searched once. A search has a window a, a last window b, and a probe
    text[s..e] that runs backwards from e; all searches step together, each from probe to probe:
    whole (a to b's end), then single windows from a on, and from a hit the longest match by halves.
    """
    _, which, inverse = np.unique(p.contents(), return_index=True, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    first = np.searchsorted(inverse[order], np.arange(len(which)))
    q = p.take(which)
    index = FMIndex(q, np.minimum.reduceat(p.docs[order], first), np.maximum.reduceat(p.docs[order], first), int(q.lengths.max()))
    piece = np.arange(len(q.lengths))
    a = index.begin.copy()
    b = index.begin + q.lengths - least
    whole, window, halves = 0, 1, 2
    mode = np.zeros(len(piece), np.int8)
    low, high, mid = a.copy(), b + 1, b.copy()
    at = b + least - 1
    lo, hi = np.zeros(len(piece), np.int64), np.full(len(piece), index.n)
    probes = np.zeros(len(piece), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def keep(rows: np.ndarray, f: np.ndarray, t: np.ndarray) -> None:
        if len(rows):
            found.append((piece[rows], f.copy(), t.copy()))

    while len(piece):
        lo, hi, good = index.back(at, lo, hi)
        over = np.flatnonzero(~good | (at <= a))
        if len(over):
            f, ok, m = at[over], good[over], mode[over]
            # whole: either every window is hit, or those behind the failing word are
            w = over[(m == whole) & ok]
            keep(w, a[w], b[w])
            a[w] = b[w] + 1
            w, fw = over[(m == whole) & ~ok], f[(m == whole) & ~ok]
            some = fw < b[w]
            keep(w[some], np.maximum(fw[some] + 1, a[w[some]]), b[w[some]])
            b[w] = np.minimum(b[w] - 1, fw)
            # a window that fails rules out all that hold the failing word and its end
            w = over[(m == window) & ~ok]
            a[w] = f[(m == window) & ~ok] + 1
            hit = over[(m == window) & ok]
            low[hit], high[hit] = a[hit], b[hit] + 1
            w = over[m == halves]
            low[w], high[w] = np.where(ok[m == halves], mid[w], low[w]), np.where(ok[m == halves], high[w], mid[w])
            mode[over] = window
            w = np.concatenate([hit, w])
            done = high[w] - low[w] <= 1
            keep(w[done], a[w[done]], low[w[done]])
            a[w[done]] = low[w[done]] + 1
            w = w[~done]
            mode[w], mid[w] = halves, (low[w] + high[w]) // 2
            at[over] = np.where(mode[over] == halves, mid[over], a[over]) + least - 1
            lo[over], hi[over] = 0, index.n
            good[over] = False
        at[good] -= 1
        if len(over):
            probes[over] += 1
            # many short matches in a row, as in periodic text: the windows left are searched side by side
            many = over[(probes[over] >= PROBES) & (a[over] < b[over])]
            n = b[many] - a[many] + 1
            each, windows = np.repeat(piece[many], n), take_ranges(a[many], n)
            a[many] = b[many] + 1
            on = a <= b
            if not on.all():
                piece, a, b, mode, low, high, mid, at, lo, hi, probes = (x[on] for x in (piece, a, b, mode, low, high, mid, at, lo, hi, probes))
            if len(each):
                z = np.zeros_like(windows)
                new = (each, windows, windows, np.full(len(z), window, np.int8), windows, windows + 1, windows, windows + least - 1, z, z + index.n, z)
                piece, a, b, mode, low, high, mid, at, lo, hi, probes = (np.concatenate(x) for x in zip((piece, a, b, mode, low, high, mid, at, lo, hi, probes), new))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    piece, begin, end = (np.concatenate(x) for x in zip(*found))
    # back from distinct pieces to all that are equal to them
    count = np.diff(np.append(first, len(order)))
    own = order[take_ranges(first[piece], count[piece])]
    n = count[piece]
    base = p.starts[own] - np.repeat(index.begin[piece], n)
    return p.docs[own], np.repeat(begin, n) + base, np.repeat(end, n) + base


def repeated_passages(docs: DataFrame, least: int = 50) -> DataFrame:
    """(doc_id, start_word, n_words) of the passages of `least` words or more that occur in another document too."""
    return _passages.matched(_passages.shards(docs, least), lambda p: match(p, least), least)

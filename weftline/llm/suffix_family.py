"""Suffix-array dedup with a logarithmic index family.

Documents arrive in batches. In every shard (see _passages) a new batch gets its suffix array: its windows
of `least` words in lexical order, with what the order makes adjacent grouped. It is merge-scanned against
each existing level for equal windows of different documents, which are then marked on both sides, and
joins the family as a level of rank 0; two levels of equal rank are merged into one of the next rank, so
after n batches there are no more than log2(n) + 1 levels, and a window is merged that often.

Defined results: as for the FM-index. Null ids, null texts and texts shorter than `least` words give
nothing; rows that share a doc_id are one document, in whichever batch; an empty batch changes nothing;
words compare byte for byte. Only doc_id, text and the batch are read; the result does not depend on how
documents are spread over batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _passages
from ._batch import take_ranges
from ._passages import Pieces


class Level:
    """Sorted windows: keys (one for each group of equal windows), their documents' least and greatest, the members of each group."""

    def __init__(self, keys: np.ndarray, low: np.ndarray, high: np.ndarray, edges: np.ndarray, members: np.ndarray, rank: int):
        self.keys, self.low, self.high, self.edges, self.members, self.rank = keys, low, high, edges, members, rank

    @staticmethod
    def of(keys: np.ndarray, docs: np.ndarray, windows: np.ndarray) -> Level:
        """Suffix array of a batch: keys are its windows' words."""
        order = np.argsort(keys, kind="stable")
        k, d = keys[order], docs[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        return Level(k[first], np.minimum.reduceat(d, first), np.maximum.reduceat(d, first), np.append(first, len(k)), windows[order], 0)

    def of_groups(self, groups: np.ndarray) -> np.ndarray:
        return self.members[take_ranges(self.edges[groups], self.edges[groups + 1] - self.edges[groups])]

    def scan(self, other: Level) -> tuple[np.ndarray, np.ndarray]:
        """Groups of self and of other that are equal."""
        at = np.searchsorted(other.keys, self.keys)
        at[at == len(other.keys)] = 0
        mine = np.flatnonzero(other.keys[at] == self.keys)
        return mine, at[mine]

    def merged(self, other: Level) -> Level:
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")  # a merge: both halves are sorted runs
        k = keys[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        size = np.concatenate([np.diff(self.edges), np.diff(other.edges)])[order]
        start = np.concatenate([self.edges[:-1], other.edges[:-1] + len(self.members)])[order]
        members = np.concatenate([self.members, other.members])[take_ranges(start, size)]
        low, high = np.concatenate([self.low, other.low])[order], np.concatenate([self.high, other.high])[order]
        return Level(k[first], np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), np.append(0, np.cumsum(np.add.reduceat(size, first))), members, max(self.rank, other.rank) + 1)


class Family:
    """Levels of one shard. add() gives the windows that match, of the batch and of earlier ones."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, new: Level) -> np.ndarray:
        hits = [new.of_groups(np.flatnonzero(new.low != new.high))]
        for level in self.levels:
            mine, theirs = new.scan(level)
            differ = np.minimum(new.low[mine], level.low[theirs]) != np.maximum(new.high[mine], level.high[theirs])
            hits += [new.of_groups(mine[differ]), level.of_groups(theirs[differ])]
        self.levels.append(new)
        while len(self.levels) > 1 and self.levels[-1].rank == self.levels[-2].rank:
            last = self.levels.pop()
            self.levels.append(self.levels.pop().merged(last))
        return np.concatenate(hits)


def match(p: Pieces, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, last): runs of windows that two documents hold, batch after batch."""
    n = p.lengths.astype(np.int64) - least + 1
    begin = np.cumsum(p.lengths.astype(np.int64)) - p.lengths
    at = take_ranges(begin, n)
    piece = np.repeat(np.arange(len(n)), n)
    rows = np.lib.stride_tricks.sliding_window_view(p.symbols, least)
    family, hit = Family(), np.zeros(len(at), bool)
    batch = p.batches[piece]
    for k in np.unique(p.batches):
        w = np.flatnonzero(batch == k)
        keys = np.ascontiguousarray(rows[at[w]]).view(f"S{2 * least}").ravel()
        hit[family.add(Level.of(keys, p.docs[piece[w]], w))] = True
    on = np.concatenate([[False], hit, [False]])
    edge = np.zeros(len(hit) + 1, bool)
    edge[1:-1] = piece[1:] != piece[:-1]
    begins = np.flatnonzero(hit & (~on[:-2] | edge[:-1]))
    ends = np.flatnonzero(hit & (~on[2:] | edge[1:]))
    base = p.starts[piece] - begin[piece]
    return p.docs[piece[begins]], at[begins] + base[begins], at[ends] + base[ends]


def repeated_passages(docs: DataFrame, least: int = 50, batch: Column | None = None, batches: int = 8) -> DataFrame:
    """(doc_id, start_word, n_words) of the passages of `least` words or more that occur in another document too.

    batch: number of the batch in which a document arrives; a hash of its id over `batches` of them if None.
    """
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)) if batch is None else batch
    return _passages.matched(_passages.shards(docs, least, batch), lambda p: match(p, least), least)

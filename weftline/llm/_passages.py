"""Routing of passages to shards, shared by the two substring operators.

A text is a sequence of white-space separated words; each word is a 16-bit symbol, its hash (1 to 65535). A window is
`least` words in a row. Its anchor is the smallest hash of the k-grams in it, so equal windows have equal
anchors wherever they stand, and all occurrences of a window reach the shard of its anchor: matching
inside the shards finds every match of `least` words or more, with no shard seen by another's text. A run
of windows with one anchor travels as one piece of text. A piece whose anchor occurs in one document only
can match nothing elsewhere and is not indexed.

Symbols of 16 bits make two different windows equal with probability 2^-16 for each word in which they
differ: a passage may come out a word too long at either end about once in 2^16 times, and is never missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._batch import RAW, Words, chunks, mix, ngrams, powers, sliding_min, take_ranges
from ._spark import shuffle_partitions

K = 8
#: Windows in a piece at most; a longer run of one anchor is cut into several pieces.
RUN = 64
_FLUSH_WORDS = 2 << 20
_BLOCK = "part int, anchors binary, docs binary, batches binary, starts binary, lengths binary, symbols binary"
#: Symbols indexed at once inside a shard; anchors are never split.
SUBSHARD = 4 << 20


class Pieces:
    """anchors, docs, batches, starts (word index of the first symbol), lengths, symbols (concatenated)."""

    def __init__(self, anchors, docs, batches, starts, lengths, symbols):
        self.anchors, self.docs, self.batches, self.starts, self.lengths, self.symbols = anchors, docs, batches, starts, lengths, symbols

    def take(self, which: np.ndarray) -> Pieces:
        at = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        lengths = self.lengths[which]
        return Pieces(self.anchors[which], self.docs[which], self.batches[which], self.starts[which], lengths, self.symbols[take_ranges(at[which], lengths.astype(np.int64))])

    def contents(self) -> np.ndarray:
        """Hash of each piece's words and their number."""
        p, inverse = powers(len(self.symbols) + 1)
        at = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        s = np.zeros(len(self.symbols) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(self.symbols.astype(np.uint64)) * p[: len(self.symbols)], out=s[1:])
            return mix((s[at[1:]] - s[at[:-1]]) * inverse[at[:-1]] + self.lengths.astype(np.uint64))

    @staticmethod
    def join(parts: list[Pieces]) -> Pieces:
        return Pieces(*(np.concatenate([getattr(p, a) for p in parts]) for a in ("anchors", "docs", "batches", "starts", "lengths", "symbols")))


def cut(b: np.ndarray, offsets: np.ndarray, ids: np.ndarray, batches: np.ndarray, least: int) -> Pieces:
    """Pieces of the documents in a buffer."""
    words = Words(b, offsets, RAW)
    grams, _ = ngrams(words, K)
    low = sliding_min(grams, least - K + 1)
    symbols = ((words.hashes >> np.uint64(33)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    counts = np.diff(words.first)
    windows = np.maximum(counts - least + 1, 0)
    at = take_ranges(words.first[:-1], windows)
    doc = np.repeat(np.arange(len(counts)), windows)
    anchor = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    more = (size - 1) // RUN
    if more.any():
        first = take_ranges(np.zeros(len(size), np.int64), more + 1) * RUN + np.repeat(first, more + 1)
        size = np.minimum(RUN, np.repeat(np.cumsum(size), more + 1) - first)
    begin, lengths = at[first], (size + least - 1).astype(np.int32)
    d = doc[first]
    return Pieces(anchor[first], ids[d], batches[d], (begin - words.first[d]).astype(np.int32), lengths, symbols[take_ranges(begin, lengths.astype(np.int64))])


def _blocks(held: list[Pieces], parts: int) -> Iterator[pa.RecordBatch]:
    p = Pieces.join(held)
    part = (p.anchors % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    p, part = p.take(order), part[order]
    edges = np.searchsorted(part, np.arange(parts + 1))
    at = np.concatenate([[0], np.cumsum(p.lengths, dtype=np.int64)])
    rows: list[list] = [[] for _ in range(7)]
    for k in np.flatnonzero(np.diff(edges)):
        i, j = edges[k], edges[k + 1]
        for r, v in zip(rows, (int(k), p.anchors[i:j].tobytes(), p.docs[i:j].tobytes(), p.batches[i:j].tobytes(), p.starts[i:j].tobytes(), p.lengths[i:j].tobytes(), p.symbols[at[i] : at[j]].tobytes())):
            r.append(v)
    names = ["part", "anchors", "docs", "batches", "starts", "lengths", "symbols"]
    n = len(rows[0])
    for i in range(0, n, 256):
        yield pa.RecordBatch.from_arrays([pa.array(r[i : i + 256], pa.int32() if k == 0 else pa.binary()) for k, r in enumerate(rows)], names=names)


def shards(docs: DataFrame, least: int, batch=None) -> DataFrame:
    """The pieces of docs as blocks, one Spark partition for each shard."""
    if least < K + 2:
        raise ValueError(f"passages have {K + 2} words at least")
    parts = shuffle_partitions(docs.sparkSession)
    src = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.lit(0) if batch is None else batch).cast("int").alias("batch"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rb, b, o in chunks(batches):
            held.append(cut(b, o, rb.column(0).to_numpy(), rb.column(1).to_numpy(), least))
            size += len(held[-1].symbols)
            if size > 3 * _FLUSH_WORDS:
                yield from _blocks(held, parts)
                held, size = [], 0
        if held:
            yield from _blocks(held, parts)

    return src.mapInArrow(run, _BLOCK).repartitionById(parts, F.col("part"))


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Pieces | None:
    """All pieces of a shard whose anchor occurs in two documents or more, sorted by anchor."""
    kinds = (np.uint64, np.int64, np.int32, np.int32, np.int32, np.uint16)
    got: list[list[np.ndarray]] = [[] for _ in kinds]
    for rb in batches:
        for i in range(rb.num_rows):
            for k, kind in enumerate(kinds):
                got[k].append(np.frombuffer(rb.column(k + 1)[i].as_buffer(), kind))
    if not got[0]:
        return None
    p = Pieces(*(np.concatenate(g) for g in got))
    del got
    order = np.argsort(p.anchors, kind="stable")
    a, d = p.anchors[order], p.docs[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    hot = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
    keep = order[np.repeat(hot, np.diff(np.append(first, len(a))))]
    return p.take(keep) if len(keep) else None


def subshards(p: Pieces, most: int = SUBSHARD) -> Iterator[Pieces]:
    """p, cut between anchors into parts of about `most` symbols."""
    first = np.flatnonzero(np.append(True, p.anchors[1:] != p.anchors[:-1]))
    size = np.add.reduceat(p.lengths.astype(np.int64), first)
    group = (np.cumsum(size) - size) // most
    edges = np.append(first[np.flatnonzero(np.append(True, group[1:] != group[:-1]))], len(p.anchors))
    for i, j in zip(edges[:-1], edges[1:]):
        yield p.take(np.arange(i, j))


def matched(blocks: DataFrame, match: Callable[[Pieces], tuple[np.ndarray, np.ndarray, np.ndarray]], least: int) -> DataFrame:
    """(doc_id, start_word, n_words): unions of the runs of windows that match() finds in the shards, as (doc, first window, last window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = read_blocks(batches)
        if p is None:
            return
        for part in subshards(p):
            doc, first, last = match(part)
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(first, pa.int32()), pa.array(last + least, pa.int32())], names=["doc_id", "lo", "hi"])

    runs = blocks.mapInArrow(run, "doc_id long, lo int, hi int")
    order = W.partitionBy("doc_id").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    return (
        runs.withColumn("new", F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0))
        .withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("doc_id", "island")
        .agg(F.min("lo").alias("start_word"), (F.max("hi") - F.min("lo")).alias("n_words"))
        .drop("island")
    )

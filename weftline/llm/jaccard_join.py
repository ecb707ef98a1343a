"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is its set of word n-grams (folded words; a document of fewer words has the one gram of all).
The grams have a global order, rare first, by a count sketch over all documents. If two sets have a
Jaccard similarity of `threshold`, then for every l the prefixes of length |x| - ceil(threshold |x|) + l
share at least l grams. Each document takes the l up to MOST_L with the least estimated cost: reading its
prefix's posting lists, and verifying its candidates, of which there are at most the lengths of these
lists less those of the l - 1 longest. A pair is a candidate if its prefixes share min(l, l') grams.

Of a document's heaviest lists up to l - 1 are no "seeds" for it: a list pairs two documents only if it is a
seed for one of them. A pair then has to be met in min(l, l') lists less the smaller number of its lists that
are no seeds, and lists that very many documents have (a licence line) cost no pairs between them.

Near copies share grams in most parts of the index, and a group of n of them has n^2 / 2 pairs. A document whose
prefix is mostly of frequent grams therefore takes its LEAST seeds of least hash to all its postings. If two
have as many of them in common as they have to share, the part with the least one alone reports the pair;
all other pairs are counted over all parts.

Candidates are verified exactly, by components of the candidate graph; a large component is cut into pairs of blocks.
Equal sets are one node, of which one content is compared. A link is a pair of documents whose sets reach the
threshold; n_links counts a document's links, with all copies, and the class is what links connect. So the result has one
row for each document with a link, however many pairs a group of near copies has, and every pair is counted.

Defined results: null ids, null texts and texts without words give nothing, nor do documents without a link; rows that repeat are
the same document; a doc_id with different texts counts the links of each of them and has the least of their classes;
an empty table gives an empty result. Ids have to be integers. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._batch import FOLDED, Words, chunks, mix, ngrams, take_ranges
from ._graph import by_document, sized, verified
from ._spark import anti_join, checkpointed, shuffle_partitions

U64 = np.uint64
SKETCH = 1 << 20
SLOTS = 16
MOST_L = 4
#: Cost of verifying a candidate, in postings read.
VERIFY = 50.0
#: Chance that sets which share a gram by chance share another.
CHANCE = 0.02
#: Postings beyond the mean from which on a list may be left to the other grams of a pair.
HEAVY = 100.0
_FLUSH = 1 << 20
#: Seeds that a document of a large group takes to its postings.
LEAST = 5


class Grams:
    """Distinct grams of each document of a buffer: values, sorted within a document, and first, their offsets."""

    def __init__(self, b: np.ndarray, offsets: np.ndarray, n: int):
        words = Words(b, offsets, FOLDED)
        h, inside = ngrams(words, n)
        doc = words.doc
        counts = np.diff(words.first)
        short = np.flatnonzero((counts > 0) & (counts < n))
        values, doc = h[inside], doc[inside]
        if len(short):
            with np.errstate(over="ignore"):
                one = np.array([mix(np.array([sum(int(x) * 31**k for k, x in enumerate(words.hashes[words.first[d] : words.first[d + 1]])) % (1 << 64)], U64))[0] for d in short], U64)
            values, doc = np.concatenate([values, one]), np.concatenate([doc, short])
        order = np.argsort(values)
        order = order[np.argsort(doc[order], kind="stable")]
        values, doc = values[order], doc[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
        self.values, self.doc = values[new], doc[new]
        self.first = np.searchsorted(self.doc, np.arange(len(offsets)))
        self.sizes = np.diff(self.first)

    def keys(self) -> np.ndarray:
        """Hash of each document's set."""
        s = np.zeros(len(self.values) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(self.values ^ U64(0x5851F42D4C957F2D)), out=s[1:])
            return mix(s[self.first[1:]] - s[self.first[:-1]] + self.sizes.astype(U64))


def _source(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


class Sketch:
    """Document frequencies of grams, by bucket, and the mean length of a posting list beyond the document itself.

    The latter comes from samples of the grams by hash, each a fourth of the one before, of which the first
    that is sparse in its buckets is used. Its size is fixed, whatever the input.
    """

    LEVELS, WIDTH = 12, 1 << 14
    SIZE = SKETCH + LEVELS * WIDTH

    @classmethod
    def count(cls, values: np.ndarray) -> np.ndarray:
        out = np.zeros(cls.SIZE, np.int64)
        out[:SKETCH] = np.bincount((values >> U64(44)).astype(np.int64), minlength=SKETCH)
        v = values
        for k in range(cls.LEVELS):
            at = SKETCH + k * cls.WIDTH
            out[at : at + cls.WIDTH] = np.bincount(((v >> U64(24)) & U64(cls.WIDTH - 1)).astype(np.int64), minlength=cls.WIDTH)
            v = v[((v >> U64(2 * k)) & U64(3)) == 0]
        return out

    def __init__(self, counts: np.ndarray):
        self.buckets = counts[:SKETCH]
        self.mean = float(self.buckets.mean())
        self.background = 0.0
        for level in counts[SKETCH:].reshape(self.LEVELS, self.WIDTH).astype(np.float64):
            if level.sum() and (level > 0).mean() < 0.2:
                # a list in a bucket of its own: chance sharing of buckets is taken off
                self.background = max(0.0, float((level * (level - 1)).sum() / level.sum()) - float(level.mean()))
                break


def survey(docs: DataFrame, n: int) -> DataFrame:
    """One pass over docs: rows (slot, counts) of the sketch and rows (slot -1, ids, keys) of the documents' sets; kept on disk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(Sketch.SIZE, np.int64)
        for rb, b, o in chunks(batches):
            g = Grams(b, o, n)
            total += Sketch.count(g.values)
            on = g.sizes > 0
            yield _rows([-1], [None], [rb.column(0).to_numpy()[on].tobytes()], [g.keys()[on].tobytes()])
        if total.any():
            yield _rows(list(range(SLOTS)), [x.astype(np.int32).tobytes() for x in total.reshape(SLOTS, -1)], [None] * SLOTS, [None] * SLOTS)

    def _rows(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.binary()) for k, c in enumerate(columns)], names=["slot", "counts", "ids", "keys"])

    return checkpointed(docs.mapInArrow(run, "slot int, counts binary, ids binary, keys binary"))


def sketch_of(rows: DataFrame) -> Sketch:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rb in batches:
            for slot, x in zip(rb.column(0).to_pylist(), rb.column(1)):
                sums[slot] = sums.get(slot, 0) + np.frombuffer(x.as_buffer(), np.int32).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(x, 2**31 - 1).astype(np.int32).tobytes() for x in sums.values()], pa.binary())], names=["slot", "counts"])

    out = np.zeros((SLOTS, Sketch.SIZE // SLOTS), np.int32)
    for slot, x in rows.where("slot >= 0").select("slot", "counts").repartitionById(SLOTS, F.col("slot")).mapInArrow(add, "slot int, counts binary").collect():
        out[slot] = np.frombuffer(x, np.int32)
    return Sketch(out.ravel())


def nodes_of(rows: DataFrame) -> DataFrame:
    """(doc_id, node) of every document with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for ids, keys in zip(rb.column(0), rb.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids.as_buffer(), np.int64)), pa.array(np.frombuffer(keys.as_buffer(), np.int64))], names=["doc_id", "node"])

    return rows.where("slot = -1").select("ids", "keys").mapInArrow(run, "doc_id long, node long")


def prefixes(g: Grams, sketch: Sketch, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(positions of the prefixes' grams in g, their documents, whether each is listed as a seed, each document's l, how many of its grams are no seeds, and whether most are frequent)."""
    df = sketch.buckets[(g.values >> U64(44)).astype(np.int64)]
    order = np.lexsort((g.values, df, g.doc))
    m = g.sizes.astype(np.int64)
    t = np.ceil(threshold * m - 1e-9).astype(np.int64)
    # what a bucket holds beyond the mean and its noise is the gram's own
    f = np.maximum(df[order] - sketch.mean - 3 * math.sqrt(sketch.mean), 0.0)
    run = np.concatenate([[0.0], np.cumsum(f)])
    heavy = np.concatenate([[0], np.cumsum(f > HEAVY)])
    begin = g.first[:-1]
    best, none, least = np.ones(len(m), np.int64), np.zeros(len(m), np.int64), np.full(len(m), np.inf)
    for k in range(1, MOST_L + 1):
        end = begin + np.clip(m - t + k, 0, m)
        # the prefix is sorted by frequency: its heavy lists are its last ones
        h = np.minimum(k - 1, heavy[end] - heavy[begin])
        read = run[end - h] - run[begin] + sketch.background * (end - h - begin)
        cost = (end - begin) + read * (1 + VERIFY * CHANCE ** (k - h - 1))
        better = (cost < least) & ((k <= t) | (k == 1))
        best[better], none[better], least[better] = k, h[better], cost[better]
    length = np.clip(m - t + best, 0, m) * (m > 0)
    at = take_ranges(begin, length)
    doc = np.repeat(np.arange(len(m)), length)
    rank = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    often = np.concatenate([[0], np.cumsum(f > 0)])
    crowd = (often[begin + length] - often[begin]) * 2 > length
    return order[at], doc, rank < (length - none)[doc], best, none, crowd


def least_seeds(values: np.ndarray, doc: np.ndarray, documents: int) -> np.ndarray:
    """The LEAST least values of each document, 0 where it has fewer."""
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    rank = np.arange(len(d)) - np.searchsorted(d, d)
    out = np.zeros((documents, LEAST), U64)
    on = rank < LEAST
    out[d[on], rank[on]] = v[on]
    return out


def _in_common(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how many values the rows of x and y have in common, the least of these)."""
    count, least = np.zeros(len(x), np.int32), np.full(len(x), ~U64(0))
    for p in range(LEAST):
        for q in range(LEAST):
            same = (x[:, p] == y[:, q]) & (x[:, p] != 0)
            count += same
            np.minimum(least, x[:, p], out=least, where=same)
    return count, least


_BLOCK = "part int, grams binary, flags binary, nodes binary, sizes binary, needs binary, least binary"


def _postings(docs: DataFrame, n: int, threshold: float, sketch, parts: int) -> DataFrame:
    """Prefix grams of all sets, in blocks by part of the gram's hash: 32 bits of the gram, the set and whether it is a seed; for each set its size, l and number of grams that are no seeds, and the least seeds if it is in a crowd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, b, o in chunks(batches):
            g = Grams(b, o, n)
            at, doc, seed, need, none, crowd = prefixes(g, sketch.value, threshold)
            keys = g.keys()
            own = seed & crowd[doc]
            named = np.flatnonzero(crowd)
            held.append((g.values[at], keys[doc], seed, g.sizes[doc].astype(np.int32), (crowd << 7 | need << 4 | none)[doc].astype(np.uint8), keys[named], least_seeds(g.values[at][own], doc[own], len(crowd))[named]))
            size += len(at)
            if size > _FLUSH:
                yield from blocks(held)
                held, size = [], 0
        if size:
            yield from blocks(held)

    def blocks(held: list) -> Iterator[pa.RecordBatch]:
        grams, nodes, seed, sizes, needs, named, least = (np.concatenate(x) for x in zip(*held))
        by_name = np.argsort(named)
        named, least = named[by_name], least[by_name]
        part = (grams % U64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        some = np.flatnonzero(np.diff(edges))
        for c in range(0, len(some), 64):
            rows: list[list] = [[] for _ in range(7)]
            for k in some[c : c + 64]:
                own = order[edges[k] : edges[k + 1]]
                # the sets of a block as a table: a posting takes 4 bytes for the gram and 4 for set and seed
                node, first, index = np.unique(nodes[own], return_index=True, return_inverse=True)
                short = (grams[own] // U64(parts)).astype(np.uint32)
                need = needs[own[first]]
                mine = least[np.searchsorted(named, node[need >= 128])]
                for r, v in zip(rows, (int(k), short.tobytes(), (index.astype(np.uint32) << 1 | seed[own]).tobytes(), node.tobytes(), sizes[own[first]].tobytes(), need.tobytes(), mine.tobytes())):
                    r.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int32() if k == 0 else pa.binary()) for k, r in enumerate(rows)], names=["part", "grams", "flags", "nodes", "sizes", "needs", "least"])

    return docs.mapInArrow(run, _BLOCK).repartitionById(parts, F.col("part"))


def _pairs_of_lists(grams: np.ndarray, node: np.ndarray, sizes: np.ndarray, seed: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes in one list, one of them a seed there, whose sizes allow the threshold; some million at a time."""
    order = np.lexsort((sizes[node], grams))
    g, v, s = grams[order], node[order], seed[order]
    z = sizes[v].astype(np.float64)
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    count = np.diff(np.append(first, len(g)))
    # lists are sorted by size: a posting's partners are those behind it, up to the size limit
    group = np.repeat(np.arange(len(first)), count)
    scale = float(z.max() + 1) if len(z) else 1.0
    reach = np.searchsorted(group * scale + z, group * scale + np.minimum(np.floor(z / threshold + 1e-9), scale - 1), "right")
    n = reach - np.arange(len(g)) - 1
    total, at = np.cumsum(n), 0
    while at < len(g):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), "right")))
        i = np.repeat(np.arange(at, to), n[at:to])
        j = take_ranges(np.arange(at, to) + 1, n[at:to])
        ok = (s[i] | s[j]) & (v[i] != v[j])
        yield v[i[ok]], v[j[ok]]
        at = to


def _candidates(postings: DataFrame, threshold: float, parts: int) -> DataFrame:
    """(a, b) of the nodes whose prefixes share as many grams as they have to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.uint32, np.uint32, U64, np.int32, np.uint8, U64)
        got: list[list[np.ndarray]] = [[] for _ in kinds]
        base, mine = 0, 0
        for rb in batches:
            mine = rb.column(0)[0].as_py() if rb.num_rows else mine
            for i in range(rb.num_rows):
                x = [np.frombuffer(rb.column(k + 1)[i].as_buffer(), kind) for k, kind in enumerate(kinds)]
                x[1] = x[1] + np.uint32(2 * base)
                base += len(x[2])
                for g, v in zip(got, x):
                    g.append(v)
        if not base:
            return
        grams, flags, nodes, sizes, needs, least = (np.concatenate(x) for x in got)
        del got
        at = np.cumsum(needs >= 128) - 1
        names, first, index = np.unique(nodes, return_index=True, return_inverse=True)
        sizes, needs, at = sizes[first], needs[first], at[first]
        crowd = needs >= 128
        least = np.append(least, np.zeros(LEAST, U64)).reshape(-1, LEAST)
        at[~crowd] = len(least) - 1  # none in common with any
        needs = (needs & 127).astype(np.int32)
        # one posting for each gram and set, of those grams that several sets have
        posting = np.unique(grams.astype(U64) << U64(32) | (index[flags >> 1].astype(U64) << U64(1)) | (flags & 1).astype(U64))
        gram = posting >> U64(32)
        same = gram[1:] == gram[:-1]
        posting = posting[np.append(same, False) | np.append(False, same)]
        node = ((posting & U64(0xFFFFFFFF)) >> U64(1)).astype(np.int64)
        for i, j in _pairs_of_lists(posting >> U64(32), node, sizes, (posting & U64(1)).astype(bool), threshold):
            pair, count = np.unique(np.minimum(i, j) << 32 | np.maximum(i, j), return_counts=True)
            i, j = pair >> 32, pair & 0xFFFFFFFF
            need = np.minimum(needs[i] >> 4, needs[j] >> 4) - np.minimum(needs[i] & 15, needs[j] & 15)
            both = np.flatnonzero(crowd[i] & crowd[j])
            if len(both):
                common, owner = _in_common(least[at[i[both]]], least[at[j[both]]])
                known = common >= need[both]
                count[both[known]] = need[both[known]]
                keep = np.ones(len(i), bool)
                keep[both[known & (owner % U64(parts) != U64(mine))]] = False
                i, j, count, need = i[keep], j[keep], count[keep], need[keep]
            yield pa.RecordBatch.from_arrays([pa.array(names[i].view(np.int64)), pa.array(names[j].view(np.int64)), pa.array(count.astype(np.int32)), pa.array(need.astype(np.int32))], names=["a", "b", "n", "need"])

    pairs = postings.mapInArrow(run, "a long, b long, n int, need int")
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.first("need").alias("need")).where("n >= need").select("a", "b")


def _prepare(threshold: float):
    def prepare(sets: list[np.ndarray]):
        """Jaccard similarities of pairs of the sets, from bit vectors over the grams that two of them have; from sorted sets where these would be too large."""
        a = [x.view(U64) for x in sets]
        sizes = np.array([len(x) for x in a])
        names, index, count = np.unique(np.concatenate(a), return_inverse=True, return_counts=True)
        shared = count > 1
        width = (int(shared.sum()) + 63) // 64
        bits = None
        if width * len(a) <= 8 << 20:
            column = np.cumsum(shared) - 1
            on = shared[index]
            bits = np.zeros((len(a), max(width, 1)), U64)
            c = column[index[on]]
            np.bitwise_or.at(bits, (np.repeat(np.arange(len(a)), sizes)[on], c >> 6), U64(1) << (c & 63).astype(U64))
            a = None
        step = max(1, (1 << 20) // max(width, 1))

        def compare(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if bits is None:
                both = np.array([len(np.intersect1d(a[x], a[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
            else:
                both = np.zeros(len(i), np.int64)
                for k in range(0, len(i), step):
                    both[k : k + step] = np.bitwise_count(bits[i[k : k + step]] & bits[j[k : k + step]]).sum(axis=1, dtype=np.int64)
            similar = both / (sizes[i] + sizes[j] - both)
            return similar, similar >= threshold - 1e-12

        return compare

    return prepare


def _encode(n: int):
    def encode(b: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        g = Grams(b, o, n)
        return g.keys().view(np.int64), [g.values[i:j].tobytes() for i, j in zip(g.first[:-1], g.first[1:])]

    return encode


def jaccard_join(docs: DataFrame, n: int = 4, threshold: float = 0.5) -> DataFrame:
    """(doc_id, class_id, n_links) of every document that another one reaches the threshold with."""
    spark: SparkSession = docs.sparkSession
    src, parts = _source(docs), shuffle_partitions(spark)
    rows = survey(src, n)
    sketch = spark.sparkContext.broadcast(sketch_of(rows))
    nodes = checkpointed(nodes_of(rows).distinct())
    each = sized(nodes)
    candidates = checkpointed(_candidates(_postings(src, n, threshold, sketch, parts), threshold, parts))
    return by_document(nodes, each, checkpointed(verified(src, each, candidates, _encode(n), _prepare(threshold), parts)))


def deduplicated(docs: DataFrame, n: int = 4, threshold: float = 0.5) -> DataFrame:
    """docs with one document of each class: the one with the least doc_id. Rows with a null id or text stay; of rows with one doc_id one stays."""
    lost = jaccard_join(docs, n, threshold).where("doc_id <> class_id").select("doc_id")
    known = docs.where("doc_id is not null and text is not null").dropDuplicates(["doc_id"])
    return anti_join(known, lost, ["doc_id"]).unionByName(docs.where("doc_id is null or text is null"))

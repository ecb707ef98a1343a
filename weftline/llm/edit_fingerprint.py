"""Document fingerprints by randomised edit embedding.

A shared random walk reads a document from each of its anchors: at step t it writes the character c under its pointer and
moves on by the random bit R[t, c]. Anchors are content-defined: the grams of GRAM characters fall into BINS bins by their
hash, and in each bin the gram with the least hash is the document's anchor (the first place, if the gram is repeated). So an
edit moves only the anchors and walks that touch it, wherever it is and however long, at the head and the tail too. A band is
`samples` places of one walk, with the anchor's gram and a class of the text's length (a text whose partners may be longer than its
class has the next one as well); the fingerprint of a document is its BINS bands, of which a byte each travels with every band.

Texts of PLAIN characters or more are candidates if they agree in AGREE bands, shorter ones in one, and if the lengths
of what is before and behind the anchors and the counts of their characters, which no edit changes by more than one each, allow it. Candidate pairs are never sent: a task reports a forest of those of its bands, and the texts of
a connected group meet (by classes of length and in blocks, if there are more than BLOCK_BYTES of them), where every pair of the group with so many bands in
common is decided exactly: its edit distance is at most floor(rate * length of the longer text), in characters, or not; most_edits,
if it is given, caps the limit. In large groups distances to a few texts decide most pairs by the triangle
inequality; what it leaves open is worked out pair by pair.

A link is a pair of documents within the limit; equal texts are, at distance 0. The result has one row for each document
with a link, and every link between different texts that is found counts. The search is approximate: tests hold its recall
against brute force at 0.9 or more.

Short texts have shorter walks, by KINDS of length. A document whose length is within the limit of the kind below has
both, so a pair within the limit always shares one. samples has to grow with the logarithm of the corpus: at 12
characters with about 4 bits each chance agreements are rare up to some 10^10 documents.

Defined results: null ids, null texts and empty texts give nothing, nor do documents without a link; rows that repeat are one
document; a doc_id with different texts counts the links of each of them and has the least of their classes; an empty table
gives an empty result. Ids have to be integers. Only doc_id and text are read, so other columns may have any name; the anchors
and the distances cover whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import characters, chunks, mix, powers, take_ranges
from ._graph import LINKS, by_document, components, links_of, sized, stars
from ._spark import checkpointed, semi_join, shuffle_partitions

U64 = np.uint64
BINS, GRAM, STRIDE = 16, 6, 3
#: Grams of a bin that are sorted, of long texts.
KEPT = 8
#: Lengths from which walks have twice the samples.
KINDS = (48, 96, 192)
#: Text whose fingerprints are sent in one row for each part.
HELD_BYTES = 48 << 20
#: Length from which texts have full walks only, and have to agree in AGREE bands.
PLAIN = 204
#: Ratio of the lengths in a class.
CLASS_RATIO = 1.35
#: Text of a connected group that is compared in one task; more is cut by length, and then into blocks by hash.
BLOCK_BYTES = 2 << 20
#: Texts of small groups that are compared side by side.
SIDE_BYTES = 1 << 20
#: Bands that texts of PLAIN characters or more have to agree in.
AGREE = 3
#: Classes of characters that are counted, up to 255 each.
BAG = 32


@lru_cache(4)
def _bits(steps: int) -> np.ndarray:
    """R of so many steps and 256 characters."""
    return np.random.default_rng(7919).integers(0, 2, (steps, 256), np.uint8)


def edit_limit(length, most_edits: int | None, rate: float):
    limit = np.floor(rate * np.asarray(length) + 1e-9).astype(np.int64)
    return limit if most_edits is None else np.minimum(most_edits, limit)


def longest(length: np.ndarray, most_edits: int | None, rate: float) -> np.ndarray:
    """No text within its limit of these lengths is longer."""
    most = np.floor((length + 1) / (1 - rate)).astype(np.int64)
    return most if most_edits is None else np.minimum(most, length + most_edits)


def kind(length: np.ndarray) -> np.ndarray:
    return np.searchsorted(KINDS, length, "right")


def fold(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points in one byte each, and the offsets of the texts in characters."""
    points, at = characters(b)
    return ((points * 0x9E3779B1) >> 7 & 255).astype(np.uint8), np.searchsorted(at, offsets)


def anchors(chars: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash of the gram) of the texts' anchors."""
    size = np.diff(offsets)
    text = np.repeat(np.arange(len(size)), size)
    at, end = np.arange(len(chars)), offsets[1:][text]
    p, inverse = powers(len(chars) + 1)
    sums = np.zeros(len(chars) + 1, U64)
    stop = np.minimum(at + GRAM, end)
    with np.errstate(over="ignore"):
        np.cumsum((chars.astype(U64) + U64(1)) * p[: len(chars)], out=sums[1:])
        h = mix((sums[stop] - sums[:-1]) * inverse[: len(chars)])
    low = h & U64((1 << 60) - 1)
    # a long text's least grams are all among its small hashes
    small = np.minimum(2.0**60, 2.0**60 * KEPT * BINS / np.maximum(size, 1)).astype(U64)
    whole = (at + GRAM <= end) | (at == offsets[:-1][text])
    bins = text * BINS + (h >> U64(60)).astype(np.int64)

    def least(some: np.ndarray) -> np.ndarray:
        some = some[np.lexsort((low[some], bins[some]))]
        return some[np.diff(bins[some], prepend=-1) != 0]

    some = least(np.flatnonzero(whole & (low <= small[text])))
    # but not of one that repeats few grams
    again = (np.bincount(text[some], minlength=len(size)) < BINS) & (size > KEPT * BINS)
    if again.any():
        some = np.concatenate([some[~again[text[some]]], least(np.flatnonzero(whole & again[text]))])
    return text[some], some, h[some]


def text_signatures(chars: np.ndarray, offsets: np.ndarray, samples: int, most_edits: int | None, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, signature, place of the anchor in the text, byte of the fingerprint) of texts that can have a near one, and their fingerprints: (text, 0 for full and 1 for shortened walks, bin)."""
    n = np.diff(offsets)
    text, at, h = anchors(chars, offsets)
    can = edit_limit(longest(n, most_edits, rate), most_edits, rate) > 0
    text, at, h = text[can[text]], at[can[text]], h[can[text]]
    own, lower = kind(n)[text], kind(n - edit_limit(n, most_edits, rate))[text]
    lanes = [(k, on) for k in range(len(KINDS) + 1) if len(on := np.flatnonzero((lower <= k) & (k <= own)))]
    padded, bits = np.append(chars, np.uint8(0)), _bits(samples * STRIDE)
    prints = np.zeros((len(n), 2, BINS), np.uint8)
    out = []
    for k, on in lanes:
        sig, x, end = h[on] + U64(k), at[on].copy(), offsets[1:][text[on]]
        for step in range(max(1, samples >> (len(KINDS) - k)) * STRIDE):
            c = np.where(x < end, padded[np.minimum(x, end)], 0)
            if step % STRIDE == 0:
                with np.errstate(over="ignore"):
                    sig = sig * U64(0x100000001B3) + c.astype(U64) + U64(1)
            x += bits[step][c]
        sig = mix(sig)
        byte = (sig % U64(255) + U64(1)).astype(np.uint8)
        own_bin = (h[on] >> U64(60)).astype(np.int64)
        for which, kinds in ((0, own), (1, lower)):
            mine = kinds[on] == k
            prints[text[on][mine], which, own_bin[mine]] = byte[mine]
        out.append((text[on], sig, at[on] - offsets[:-1][text[on]]))
    if not out:
        return text, h, at, prints
    return *(np.concatenate(x) for x in zip(*out)), prints


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bytes two fingerprints have in common."""
    return ((x == y) & (x != 0)).sum(axis=1)


def bags(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each text has the characters of each class, 255 at most."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    n = np.bincount(text * BAG + chars % BAG, minlength=(len(offsets) - 1) * BAG)
    return np.minimum(n, 255).astype(np.uint8).reshape(-1, BAG)


def bag_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """No more than the edit distance: an edit takes one character away, brings one, or both."""
    more = x.astype(np.int32) - y
    total, net = np.abs(more).sum(axis=1, dtype=np.int64), more.sum(axis=1, dtype=np.int64)
    return (total + np.abs(net)) // 2


_BLOCK = "part int, signatures binary, nodes binary, lengths binary, places binary, prints binary, bags binary"
_NAMES = ["part", "signatures", "nodes", "lengths", "places", "prints", "bags"]


def _bands(docs: DataFrame, samples: int, most_edits: int | None, rate: float, parts: int) -> DataFrame:
    """The bands of docs (node, text) in blocks by part of the signature: (signature, node, length, place, fingerprint, counts of characters)."""
    ratio = np.log(max(CLASS_RATIO, 1.2 / (1 - rate)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rb, b, o in chunks(batches):
            nodes = rb.column(0).to_numpy()
            c, at = fold(b, o)
            # equal texts of a chunk walk once
            _, first = np.unique(nodes, return_index=True)
            n = np.diff(at)[first]
            c, at = c[take_ranges(at[:-1][first], n)], np.concatenate([[0], np.cumsum(n)])
            own, sig, place, prints = text_signatures(c, at, samples, most_edits, rate)
            low, high = (np.floor(np.log(np.maximum(x[own], 1)) / ratio).astype(np.int64) for x in (n, longest(n, most_edits, rate)))
            each = np.repeat(np.arange(len(own)), high - low + 1)
            with np.errstate(over="ignore"):
                sig = mix(sig[each] + take_ranges(low, high - low + 1).astype(U64))
            own, place = own[each], place[each]
            held.append((sig, nodes[first][own], n[own].astype(np.int32), place.astype(np.int32), prints[own, 0], bags(c, at)[own]))
            size += len(b)
            if size > HELD_BYTES:
                yield from blocks(held)
                held, size = [], 0
        if held:
            yield from blocks(held)

    def blocks(held: list) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(x) for x in zip(*held)]
        part = (columns[0] % U64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        columns, edges = [x[order] for x in columns], np.searchsorted(part[order], np.arange(parts + 1))
        for k in np.flatnonzero(np.diff(edges)):
            row = [[int(k)], *([x[edges[k] : edges[k + 1]].tobytes()] for x in columns)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(row)], names=_NAMES)

    return docs.mapInArrow(run, _BLOCK)


def _reach(group: np.ndarray, length: np.ndarray, most_edits: int | None, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the rows of the same group whose lengths allow a near text; rows are sorted by group and length."""
    most = longest(length, most_edits, rate)
    scale = int(most.max()) + 2
    at, far = group * scale + length, group * scale + most
    return np.searchsorted(far, at, "left"), np.searchsorted(at, far, "right")


def _forest(bands: DataFrame, most_edits: int | None, rate: float, parts: int) -> DataFrame:
    """(a, b) that connect all nodes which are candidates by their bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for rb in batches:
            for i in range(rb.num_rows):
                for g, k, kind in zip(got, (1, 2, 3, 4, 5, 6), (U64, np.int64, np.int32, np.int32, np.uint8, np.uint8)):
                    g.append(np.frombuffer(rb.column(k)[i].as_buffer(), kind))
        if not got[0]:
            return
        sig, node, length, place, prints, bag = (np.concatenate(g) for g in got)
        prints, bag = prints.reshape(-1, BINS), bag.reshape(-1, BAG)
        order = np.lexsort((node, length, sig))
        new = np.ones(len(sig), bool)
        new[1:] = (sig[order][1:] != sig[order][:-1]) | (node[order][1:] != node[order][:-1])
        order = order[new]
        # a band that one text alone has is left out
        same = np.append(sig[order][1:] == sig[order][:-1], False)
        order = order[same | np.append(False, same[:-1])]
        if not len(order):
            return
        sig, node, length, place, prints, bag = sig[order], node[order], length[order].astype(np.int64), place[order].astype(np.int64), prints[order], bag[order]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        count = np.diff(np.append(first, len(sig)))
        group = np.repeat(np.arange(len(first)), count)

        def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            limit = edit_limit(np.maximum(length[i], length[j]), most_edits, rate)
            # what is before the anchors differs by so many characters, and what is behind them
            before, longer = place[j] - place[i], length[j] - length[i]
            ok = np.flatnonzero(np.abs(before) + np.abs(longer - before) <= limit)
            few = (length[i[ok]] >= PLAIN) & (length[j[ok]] >= PLAIN)
            ok = ok[~few | (agreeing(prints[i[ok]], prints[j[ok]]) >= AGREE)]
            # texts with the same head only, which many have, would make one group of most of a large corpus
            return ok[bag_distance(bag[i[ok]], bag[j[ok]]) <= limit[ok]]

        # of a crowded band's texts, most are near its middle one: these need no look at each other
        rows = np.arange(len(sig))
        middle = (first + count // 2)[group]
        close = near(rows, middle)
        with_middle = np.zeros(len(sig), bool)
        with_middle[close] = True
        edges = [stars(node[close], node[middle[close]])]
        low, high = _reach(group, length, most_edits, rate)
        low = np.where(with_middle, rows, low)
        high = np.where(with_middle, rows, high)
        n, at = high - low, 0
        total = np.cumsum(n)
        while at < len(sig):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), "right")))
            i, j = np.repeat(np.arange(at, to), n[at:to]), take_ranges(low[at:to], n[at:to])
            ok = near(i, j)
            edges.append(stars(node[i[ok]], node[j[ok]]))
            if len(edges) > 16:
                edges = [stars(*(np.concatenate(x) for x in zip(*edges)))]
            at = to
        a, b = stars(*(np.concatenate(x) for x in zip(*edges)))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return bands.repartitionById(parts, F.col("part")).mapInArrow(run, "a long, b long")


def bounded_distances(texts: list[np.ndarray], i: np.ndarray, j: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Edit distances of texts[i] and texts[j], limit + 1 where they are above it: furthest reaching diagonals, all pairs side by side."""
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(size) - size
    text = np.concatenate([*texts, np.zeros(1, np.int64)]).astype(U64)
    p, inverse = powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(text + U64(1)) * p[: len(text)], out=sums[1:])

    def same(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (sums[x + n] - sums[x]) * inverse[x] == (sums[y + n] - sums[y]) * inverse[y]

    def common(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common text from x and y on, up to `most`: by doubling, then by halves."""
        done = np.zeros(len(x), np.int64)
        live = np.flatnonzero((most > 0) & (text[x] == text[y]))
        step = np.ones(len(live), np.int64)
        grow = np.ones(len(live), bool)
        while len(live):
            k = np.minimum(step, most[live] - done[live])
            ok = (k > 0) & same(x[live] + done[live], y[live] + done[live], k)
            done[live[ok]] += k[ok]
            grow &= ok
            step = np.where(grow, step * 2, step // 2)
            on = (step > 0) & (done[live] < most[live])
            live, step, grow = live[on], step[on], grow[on]
        return done

    out = limits + 1
    n, m, a, b = size[i], size[j], at[i], at[j]
    top = int(limits.max()) if len(limits) else 0
    far = np.full((len(i), 2 * top + 3), -1, np.int64)
    mid = top + 1
    pair = np.flatnonzero(np.abs(m - n) <= limits)
    for e in range(top + 1):
        if not len(pair):
            break
        d = np.arange(-e, e + 1)
        if e:
            f = far[pair]
            x = np.maximum(np.maximum(f[:, mid - e : mid + e + 1] + 1, f[:, mid - e - 1 : mid + e]), f[:, mid - e + 1 : mid + e + 2] + 1)
            # a diagonal that nothing has reached yet stays out
            none = (f[:, mid - e : mid + e + 1] < 0) & (f[:, mid - e - 1 : mid + e] < 0) & (f[:, mid - e + 1 : mid + e + 2] < 0)
        else:
            x, none = np.zeros((len(pair), 1), np.int64), np.zeros((len(pair), 1), bool)
        x = np.minimum(x, np.minimum(n[pair][:, None], m[pair][:, None] - d))
        none |= (x < 0) | (x + d < 0)
        r, c = np.nonzero(~none)
        xs, ys = x[r, c], x[r, c] + d[c]
        q = pair[r]
        far_x = xs + common(a[q] + xs, b[q] + ys, np.minimum(n[q] - xs, m[q] - ys))
        x[none] = -1
        x[r, c] = far_x
        far[pair, mid - e : mid + e + 1] = x
        diagonal = m[pair] - n[pair]
        inside = np.abs(diagonal) <= e
        done = inside & (x[np.arange(len(pair)), np.clip(diagonal + e, 0, 2 * e)] >= n[pair])
        out[pair[done]] = e
        pair = pair[~done & (limits[pair] > e)]
    return out


#: Edits up to which diagonals are followed; beyond it they cost more than the columns of far_distance.
NEAR_EDITS = 8


def far_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two texts, or limit + 1 where it is above it: Myers' bit vectors, a column of the table in one integer."""
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short -= head
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    m, n = len(a), len(b)
    if abs(m - n) > limit:
        return limit + 1
    if not m or not n:
        return m + n
    where = {int(c): int.from_bytes(np.packbits(a == c, bitorder="little").tobytes(), "little") for c in np.unique(a)}
    # of a column only the rows within the limit of the diagonal; what is outside counts as too much
    lo = hi = up = down = score = 0
    chars = b.tolist()
    for k in range(0, n, 256):
        was, old, lo, hi = lo, hi, max(0, k - limit), min(m, k + 256 + limit)
        # the distance of the first k characters of both can't fall by more than the difference of the lengths
        if k and k < m and score - (up >> (k - was)).bit_count() + (down >> (k - was)).bit_count() - abs(m - n) > limit:
            return limit + 1
        up, down, score = (up | (1 << (hi - was)) - (1 << (old - was))) >> (lo - was), down >> (lo - was), score + hi - old
        full, top = (1 << (hi - lo)) - 1, hi - lo - 1
        now = {c: w >> lo & full for c, w in where.items()}
        for c in chars[k : k + 256]:
            eq = now.get(c, 0)
            v = eq | down
            h = (((eq & up) + up) ^ up) | eq
            right, left = down | (full & ~(h | up)), up & h
            score += (right >> top & 1) - (left >> top & 1)
            right, left = (right << 1 | 1) & full, left << 1 & full
            up, down = left | (full & ~(v | right)), right & v
    return min(score, limit + 1)


#: Pairs from which on columns of all of them are worked out side by side, and memory for the places of the characters of their texts.
SIDE_BY_SIDE, PLACES_BYTES = 64, 32 << 20
#: Words of the columns of so many pairs together, about; with fewer, the calls take longer than the work.
SIDE_WORDS = 24 << 10
COLUMNS = 64


def band_distances(texts: list[np.ndarray], i: np.ndarray, j: np.ndarray, limits: np.ndarray) -> np.ndarray | None:
    """As far_distance for many pairs whose lengths differ by no more than the limit: a band of bit vectors, a column of every pair at a time. None if the places of the characters would take too much memory."""
    used, index = np.unique(np.concatenate([i, j]), return_inverse=True)
    own = [texts[u] for u in used]
    size = np.array([len(t) for t in own], np.int64)
    names, codes = np.unique(np.concatenate(own), return_inverse=True)
    x, y = index[: len(i)], index[len(i) :]
    swap = size[x] < size[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    m, n, limit = size[x], size[y], limits.copy()
    # a path over a diagonal has at least as many edits as it is away from that of the start and that of the end
    above, under = int(((limits - m + n) // 2).max()), int(((limits + m - n) // 2).max())
    w = (COLUMNS + above + under + 63) // 64
    # words of the places: some zeros before the text and behind it
    words = (int(size.max()) + COLUMNS + above) // 64 + w + 1
    wide = len(names) + 1
    if len(own) * wide * words * 8 > PLACES_BYTES:
        return None
    places = np.zeros((len(own) * wide, words * 8), np.uint8)
    begin = np.cumsum(size) - size
    text, at = np.repeat(np.arange(len(own)), size), np.arange(len(codes)) - np.repeat(begin, size)
    np.bitwise_or.at(places, (text * wide + codes, (at + above) // 8), (1 << ((at + above) % 8)).astype(np.uint8))
    places = places.view(U64).ravel()
    padded = np.full((len(own), int(size.max()) + COLUMNS), wide - 1, np.int32)
    padded[text, at] = codes
    out = limits + 1
    live = np.arange(len(i))
    one, shift = U64(1), U64(63)
    offset = np.arange(w)[:, None]

    def down_to(row: np.ndarray, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """By how much the distances grow from the window's first row to these."""
        keep = np.clip(row - 64 * offset, 0, 64)
        mask = np.where(keep == 64, ~U64(0), (one << keep.astype(U64) % U64(64)) - one)
        return np.bitwise_count(up[:, some] & mask).sum(axis=0, dtype=np.int64) - np.bitwise_count(down[:, some] & mask).sum(axis=0, dtype=np.int64)

    # row 0 of the window is row k - above of the table; rows before the first count as nothing
    keep = np.clip(64 * (np.arange(w) + 1) - above, 0, 64).tolist()
    up = np.repeat(np.array([(1 << 64) - (1 << 64 - q) if q else 0 for q in keep], U64)[:, None], len(live), axis=1)
    down = np.zeros((w, len(live)), U64)
    # distance at the window's first row, which grows by one with every column
    score = np.zeros(len(live), np.int64)
    for k in range(0, int(n[live].max()) if len(live) else 0, COLUMNS):
        # word of every column's places, and arrays that all columns use again
        first = np.ascontiguousarray((padded[y[live], k : k + COLUMNS].astype(np.int64) * words + ((x[live] * wide) * words + k // 64)[:, None]).T)
        end = n[live]
        ends = {}
        for p in np.flatnonzero(end <= k + COLUMNS):
            ends.setdefault(int(end[p]), []).append(p)
        if k in ends:  # texts of no characters
            out[live[ends[k]]] = m[live[ends[k]]]
        eq, v, h, t = (np.empty((w, len(live)), U64) for _ in range(4))
        both, carry = np.empty((2, w, len(live)), U64), np.empty((2, w - 1, len(live)), U64)
        right, left = both
        over, ones, at = np.empty((w, len(live)), bool), np.empty((w - 1, len(live)), bool), np.empty((w, len(live)), np.int64)
        for c in range(COLUMNS):
            np.add(first[c], offset, out=at)
            places.take(at, out=eq, mode="clip")
            np.bitwise_or(eq, down, out=v)
            np.bitwise_and(eq, up, out=t)
            np.add(t, up, out=h)
            np.less(h, t, out=over)
            np.add(h[1:], over[:-1], out=h[1:])
            # a word of ones passes on what is carried
            np.equal(h[1:], 0, out=ones)
            np.logical_and(ones, over[:-1], out=ones)
            if w > 2 and ones[:-1].any():
                for q in range(2, w):
                    if ones[q - 2].any():
                        h[q] += ones[q - 2]
                        ones[q - 1] |= ones[q - 2] & (h[q] == 0)
            np.bitwise_xor(h, up, out=h)
            np.bitwise_or(h, eq, out=h)
            np.bitwise_or(h, up, out=right)
            np.invert(right, out=right)
            np.bitwise_or(right, down, out=right)
            np.bitwise_and(up, h, out=left)
            np.right_shift(both[:, :-1], shift, out=carry)
            np.left_shift(both, one, out=both)
            np.bitwise_or(both[:, 1:], carry, out=both[:, 1:])
            np.bitwise_or(right[0], one, out=right[0])
            np.bitwise_or(v, right, out=up)
            np.invert(up, out=up)
            np.bitwise_or(up, left, out=up)
            np.bitwise_and(right, v, out=down)
            if k + c + 1 in ends:
                p = np.array(ends[k + c + 1])
                out[live[p]] = score[p] + c + 1 + down_to(m[live[p]] - k + above, p)
        # distances don't fall along the diagonal of the end
        so_far = score + COLUMNS + down_to((m - n)[live] + above + COLUMNS)
        score = score + COLUMNS + down_to(np.full(len(live), 64))
        stay = (end > k + COLUMNS) & (so_far <= limit[live])
        live, up, down, score = live[stay], up[:, stay], down[:, stay], score[stay]
        if not len(live):
            break
        # the window moves on by a word; its new rows count as one more each than the one before
        up = np.concatenate([up[1:], np.full((1, len(live)), ~U64(0))])
        down = np.concatenate([down[1:], np.zeros((1, len(live)), U64)])
    return np.minimum(out, limits + 1)


def within(texts: list[np.ndarray], i: np.ndarray, j: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Edit distances of texts[i] and texts[j], as code points; limit + 1 where they are above it."""
    size = np.array([len(t) for t in texts], np.int64)
    near = np.minimum(limits, NEAR_EDITS)
    got = limits + 1
    counts = np.zeros((len(texts), BAG), np.int32)
    for u in np.unique(np.concatenate([i, j])):
        counts[u] = np.bincount(texts[u] % BAG, minlength=BAG)
    least = np.concatenate([np.zeros(0, np.int64), *(bag_distance(counts[i[k : k + 32768]], counts[j[k : k + 32768]]) for k in range(0, len(i), 32768))])
    few, at = np.flatnonzero(least <= near), 0
    while at < len(few):
        # some 4096 pairs, of 1 M characters or one pair
        some = few[at : at + 4096]
        some = some[: max(1, int(np.searchsorted(np.cumsum(size[i[some]] + size[j[some]]), 1 << 20, "right")))]
        used, index = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
        h = len(index) // 2
        got[some] = bounded_distances([texts[u] for u in used], index[:h], index[h:], near[some])
        at += len(some)
    got[got > near] = limits[got > near] + 1
    far = np.flatnonzero((got > limits) & (near < limits) & (least <= limits))
    # pairs that are next to each other have about the same band
    far = far[np.lexsort((i[far], np.abs(size[i] - size[j])[far] // 8, limits[far] // 8))]
    while len(far):
        some = far[: min(max(256, SIDE_WORDS // (int(limits[far[0]]) // 64 + 2)), int(np.searchsorted(limits[far] // 8, (1.25 * limits[far[0]] + 16) // 8, "right")))]
        d = None
        while len(some) >= SIDE_BY_SIDE and (d := band_distances(texts, i[some], j[some], limits[some])) is None:
            some = some[: len(some) // 2]
        if d is None:
            d = [far_distance(texts[i[k]], texts[j[k]], int(limits[k])) for k in some]
        got[some] = d
        far = far[len(some) :]
    return got


def decided(texts: list[np.ndarray], i: np.ndarray, j: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Whether the pairs are within their limits. While many pairs are open, a text is compared with all that are in them, and the triangle inequality decides others.

    Copies of one text differ by about the sum of their distances to it, so a text in the middle decides most pairs: the next one
    to be compared is the one that is nearest to those before.
    """
    ok, aside = np.zeros(len(i), bool), []
    left = np.arange(len(i))
    while len(left) >= 64:
        degree = np.bincount(i[left], minlength=len(texts)) + np.bincount(j[left], minlength=len(texts))
        pivot = int(degree.argmax())
        if degree[pivot] < 16:
            break
        # a cluster: the texts that the one with most open pairs is in a pair with, and itself
        inside = np.zeros(len(texts), bool)
        inside[i[left[j[left] == pivot]]] = inside[j[left[i[left] == pivot]]] = inside[pivot] = True
        mine = inside[i[left]] | inside[j[left]]
        left, own = left[~mine], left[mine]
        away = np.zeros(len(texts))
        for k in range(12):
            a, b = i[own], j[own]
            # from the pivot to every text of an open pair, up to three limits
            most = np.zeros(len(texts), np.int64)
            np.maximum.at(most, a, 3 * limits[own])
            np.maximum.at(most, b, 3 * limits[own])
            most[pivot] = 0
            others = np.flatnonzero(most)
            if len(own) < 24 * len(others):
                break
            far, beyond = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
            far[others] = within(texts, np.full(len(others), pivot), others, most[others])
            beyond[others] = far[others] > most[others]
            x, y, u, v = far[a], far[b], beyond[a], beyond[b]
            yes = ~u & ~v & (x + y <= limits[own])
            # a text beyond three limits is at least so far away
            no = (~v & (x - y > limits[own])) | (~u & (y - x > limits[own])) | ((a == pivot) | (b == pivot)) & ~yes
            ok[own[yes]] = True
            own = own[~(yes | no)]
            away += far
            away[pivot] = np.inf
            if k > 1 and (yes | no).sum() < 2 * len(others) or not len(own):
                break
            open_ = np.bincount(i[own], minlength=len(texts)) + np.bincount(j[own], minlength=len(texts))
            pivot = int(np.where(open_ > 0, away, np.inf).argmin())
        aside.append(own)
    left = np.concatenate([left, *aside])
    if len(left):
        ok[left] = within(texts, i[left], j[left], limits[left]) <= limits[left]
    return ok


def _links(docs: DataFrame, each: DataFrame, home: DataFrame, samples: int, most_edits: int | None, rate: float, parts: int) -> DataFrame:
    """Rows of LINKS for the pairs of nodes of one component that have bands in common and are within the limit. docs: (doc_id, node, text); each: (node, rep, size, octets, chars).

    A component of more than BLOCK_BYTES is cut by classes of length, as bands are, and a pair is compared in the class of its longer text; a class that is
    still larger is cut into blocks by hash, each pair of which is a task.
    """
    ratio = float(np.log(max(CLASS_RATIO, 1.2 / (1 - rate))))
    most = F.floor((F.col("chars") + 1) / F.lit(1 - rate))
    most = most if most_edits is None else F.least(most, F.col("chars") + most_edits)
    low, high = (F.floor(F.log(F.greatest(x, F.lit(1))) / ratio) for x in (F.col("chars"), most))
    some = each.join(home, "node")
    large = some.groupBy("component").agg(F.sum("octets").alias("total")).where(F.col("total") > BLOCK_BYTES).select("component", F.lit(True).alias("large"))
    some = some.join(large, "component", "left").withColumn("class", F.explode(F.when(F.col("large"), F.sequence(low, high)).otherwise(F.array(F.lit(-1).cast("bigint")))))
    some = checkpointed(some.select("component", "class", F.col("rep").alias("doc_id"), "node", "size", "octets", (F.col("large").isNull() | (F.col("class") == low)).alias("own")))
    blocks = some.where("class >= 0").groupBy("component", "class").agg(F.sum("octets").alias("octets")).where(F.col("octets") > BLOCK_BYTES).select("component", "class", F.ceil(F.col("octets") / BLOCK_BYTES).alias("blocks"))
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    key = F.when(F.col("blocks").isNull(), F.xxhash64("component", "class")).otherwise(F.xxhash64("component", "class", F.least("block", "other"), F.greatest("block", "other")))
    some = some.join(blocks, ["component", "class"], "left").withColumn("block", F.pmod(F.xxhash64(F.lit(11), "node"), F.col("blocks"))).withColumn("other", F.explode(other))
    some = checkpointed(some.select("doc_id", "node", "size", "own", key.alias("key"), F.when(F.col("blocks").isNull() | (F.col("block") == F.col("other")), F.lit(-1)).otherwise(F.col("block")).alias("block")))
    texts_of = semi_join(docs, some.select("doc_id", "node").distinct(), ["doc_id", "node"]).join(some, ["doc_id", "node"])
    rows = texts_of.select(F.pmod("key", F.lit(parts)).cast("int").alias("part"), "key", "block", "node", F.when(F.col("own"), F.col("size")).otherwise(-F.col("size")).alias("size"), "text").repartitionById(parts, F.col("part")).sortWithinPartitions("key")

    def solve(group: np.ndarray, block: np.ndarray, node: np.ndarray, size: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch | None:
        """Links of the texts of several groups."""
        size_of = np.array([len(t) for t in blobs], np.int64)
        slices, prints, texts = np.cumsum(size_of) // SIDE_BYTES, [], []
        for k in np.unique(slices):
            # a slice of the texts at a time: arrays of a number for each character are large
            some = np.flatnonzero(slices == k)
            o = np.concatenate([[0], np.cumsum(size_of[some])])
            b = np.frombuffer(b"".join(blobs[some[0] : some[-1] + 1]), np.uint8)
            c, at = fold(b, o)
            prints.append(text_signatures(c, at, samples, most_edits, rate)[3])
            points = characters(b)[0].astype(np.uint32)
            texts += [points[i:j] for i, j in zip(at[:-1], at[1:])]
        length, prints = np.array([len(t) for t in texts], np.int64), np.concatenate(prints)
        _, group = np.unique(group, return_inverse=True)
        order = np.lexsort((node, length, group))
        new = np.ones(len(order), bool)
        # rows that repeat
        new[1:] = (group[order][1:] != group[order][:-1]) | (node[order][1:] != node[order][:-1])
        order = order[new]
        texts = [texts[k] for k in order]
        group, block, node, size, length, prints = (x[order] for x in (group, block, node, size, length, prints))
        _, high = _reach(group, length, most_edits, rate)
        n = high - np.arange(len(order)) - 1
        total, start, pairs = np.cumsum(n), 0, []
        while start < len(order):
            to = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + (1 << 19), "right")))
            i, j = np.repeat(np.arange(start, to), n[start:to]), take_ranges(np.arange(start, to) + 1, n[start:to])
            # of texts that were sent from the class below, the size is negative: they are no pair's longer text
            ok = ((block[i] == -1) | (block[i] != block[j])) & (size[j] > 0)
            i, j = i[ok], j[ok]
            long = (length[i] >= PLAIN) & (length[j] >= PLAIN)
            ok = np.zeros(len(i), bool)
            ok[long] = agreeing(prints[i[long], 0], prints[j[long], 0]) >= AGREE
            short = np.flatnonzero(~long)
            for p in (0, 1):
                for q in (0, 1):
                    ok[short] |= agreeing(prints[i[short], p], prints[j[short], q]) > 0
            pairs.append((i[ok], j[ok]))
            start = to
        i, j = (np.concatenate(x) for x in zip(*pairs))
        limits = edit_limit(np.maximum(length[i], length[j]), most_edits, rate)
        ok = decided(texts, i, j, limits)
        return links_of(i[ok], j[ok], node, np.abs(size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, octets, last = [], 0, None
        for rb in batches:
            keys = rb.column(1).to_numpy()
            blobs = rb.column(5).cast(pa.binary())
            edge = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for i, j in zip(edge[:-1], edge[1:]):
                if i == j:
                    continue
                if keys[i] != last and octets > SIDE_BYTES:
                    if (out := solve(*together(held))) is not None:
                        yield out
                    held, octets = [], 0
                last = keys[i]
                texts = blobs[i:j].to_pylist()
                held.append((keys[i:j], *(rb.column(k)[i:j].to_numpy() for k in (2, 3, 4)), texts))
                octets += sum(map(len, texts))
        if held and (out := solve(*together(held))) is not None:
            yield out

    def together(held: list) -> tuple:
        *columns, texts = zip(*held)
        return *(np.concatenate(x) for x in columns), [t for some in texts for t in some]

    return rows.mapInArrow(run, LINKS)


def edit_links(docs: DataFrame, most_edits: int | None = None, rate: float = 0.05, samples: int = 12) -> DataFrame:
    """(doc_id, class_id, n_links) of every document that another one is within the limit of."""
    parts = shuffle_partitions(docs.sparkSession)
    src = docs.where("doc_id is not null and text is not null and text <> ''").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("node"), "text")
    nodes = checkpointed(src.select("doc_id", "node", F.octet_length("text").alias("octets"), F.length("text").alias("chars")).distinct())
    each = sized(nodes)
    home = checkpointed(components(checkpointed(_forest(_bands(src.select("node", "text"), samples, most_edits, rate, parts), most_edits, rate, parts))))
    links = checkpointed(_links(src, each, home, samples, most_edits, rate, parts))
    return by_document(nodes.select("doc_id", "node"), each.select("node", "rep", "size"), links)

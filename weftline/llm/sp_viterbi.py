"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Texts are cut where no piece can cross: before a run of spaces and around control characters that no piece has. The distinct
words of a batch that a worker has not met yet are grouped by their length in characters, and those of one
length advance together: at each end position the hashes of all substrings that end there probe the sorted
piece keys, and the vectorised maximum over the pieces found stores a backpointer.

What the maximum is over depends on the model. For a unigram model it is the sum of the pieces' scores. A
BPE model's result is no such maximum, but it obeys the same recurrence: the encoding of a prefix is that
of a shorter prefix and one more piece, and of the pieces that end there exactly one stays apart from the
piece before it when the two are encoded together. So a transition is admitted if its pair of pieces
stays apart, which is worked out by undoing both pieces' merges side by side and is kept by pair.
The ids equal those of the SentencePiece library for both kinds.

Characters without a piece fall back to bytes. Models with a normaliser other than identity, or that strip
spaces, are refused.

Defined results: null and empty texts have no ids; null ids stay null; repeated rows give repeated
results; an empty table gives an empty result. A text that has the mark for spaces itself decodes to spaces
there, as in the library. Texts are encoded whole. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import Words, characters, chunks, mix, take_ranges

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
SPACE = "▁"
UNKNOWN = -1
#: Words of more characters are encoded one by one, with a heap of merges, or by a scalar Viterbi.
LONG = 128
#: Distinct words a worker remembers.
KEPT = 3 << 19
_CACHE = 1 << 20


def _varint(b: bytes, at: int) -> tuple[int, int]:
    x = shift = 0
    while True:
        x |= (b[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if b[at - 1] < 128:
            return x, at


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(b):
        tag, at = _varint(b, at)
        kind = tag & 7
        if kind == 0:
            v, at = _varint(b, at)
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                n, at = _varint(b, at)
            v, at = b[at : at + n], at + n
        yield tag >> 3, v


class Model:
    """A SentencePiece model file: pieces, scores, types, and what its encoder needs."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            blob = f.read()
        self.pieces: list[str] = []
        scores, self.types, self.kind = [], [], 1
        prefix, strip, charsmap, self.byte_fallback = True, True, b"", False
        for tag, v in _fields(blob):
            if tag == 1:
                piece, score, kind = "", 0.0, 1
                for t, x in _fields(v):
                    if t == 1:
                        piece = x.decode()
                    elif t == 2:
                        score = float(np.frombuffer(x, "<f4")[0])
                    elif t == 3:
                        kind = x
                self.pieces.append(piece)
                scores.append(score)
                self.types.append(kind)
            elif tag == 2:
                for t, x in _fields(v):
                    if t == 3:
                        self.kind = x
                    elif t == 35:
                        self.byte_fallback = bool(x)
            elif tag == 3:
                for t, x in _fields(v):
                    if t == 2:
                        charsmap = x
                    elif t == 3:
                        prefix = bool(x)
                    elif t == 4:
                        strip = bool(x)
        if charsmap or strip or not prefix or self.kind not in (1, 2) or not self.byte_fallback:
            raise ValueError("only unigram and BPE models with identity normalisation, a dummy prefix and byte fallback are supported")
        self.bpe = self.kind == 2
        self.scores = np.array(scores, np.float64)
        self.bytes = np.zeros(256, np.int32)
        for i, (p, t) in enumerate(zip(self.pieces, self.types)):
            if t == 6:
                self.bytes[int(p[3:5], 16)] = i
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == 1}
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or any("\0" in p for p in self.ids):
            raise ValueError("a piece crosses words")
        #: bytes that end a word: the space, and control characters that no piece has
        self.table = np.arange(256, dtype=np.uint8)
        self.table[[32, *({*range(32)} - {ord(c) for p in self.ids for c in p})]] = 0
        keys = np.array([_hash(p) for p in self.ids], U64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(self.ids.values()), np.int64)[order]
        #: a merge's priority is its piece's place by score, the best first
        self.rank = np.zeros(len(scores), np.int64)
        self.rank[np.argsort(-self.scores, kind="stable")] = np.arange(len(scores))
        if self.bpe:
            self._merges()
        self._tables()

    def _merges(self) -> None:
        """All pairs of pieces whose concatenation is a piece, and the two parts from which each piece is made."""
        n = len(self.pieces)
        pairs, made = [], []
        self.left, self.right = np.arange(n), np.arange(n)
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs.append(a * n + b)
                    made.append(self.rank[i])
        order = np.argsort(pairs)
        self.pairs, self.made = np.array(pairs, np.int64)[order], np.array(made, np.int64)[order]
        for p, i in self.ids.items():
            if len(p) > 1:
                last: list = []
                if self.merge(p, last) == [i] and last:
                    self.left[i], self.right[i] = last[-1]

    def _tables(self) -> None:
        text = [bytes([int(p[3:5], 16)]) if t == 6 else p.replace(SPACE, " ").encode() if t == 1 else b"" for p, t in zip(self.pieces, self.types)]
        self.text_len = np.array([len(t) for t in text], np.int64)
        self.text_at = np.cumsum(self.text_len) - self.text_len
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.memo_key, self.memo = np.full(_CACHE, -1, np.int64), np.zeros(_CACHE, bool)

    def merge(self, s: str, log: list | None = None) -> list[int]:
        """Ids of s by its merges, best first and leftmost among equals; -1 - code point for a character without a piece."""
        sym: list[str | None] = list(s)
        nxt, prv = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        heap: list[tuple[float, int, str]] = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < len(s) and (k := self.ids.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-self.scores[k], i, sym[i] + sym[j]))

        for i in range(len(s) - 1):
            push(i)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = nxt[i] if sym[i] is not None else len(s)
            if j >= len(s) or sym[i] is None or sym[i] + sym[j] != p:
                continue
            if log is not None:
                log.append((self.ids[sym[i]], self.ids[sym[j]]))
            sym[i], sym[j] = p, None
            nxt[i] = nxt[j]
            if nxt[i] < len(s):
                prv[nxt[i]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [self.ids[x] if x in self.ids else -1 - ord(x) for x in sym if x is not None]

    def scalar(self, s: str) -> list[int]:
        """Ids of one word, without batching."""
        if self.bpe:
            return self._spelt(self.merge(s))
        best, back = [0.0] + [-np.inf] * len(s), [0] * (len(s) + 1)
        low = float(self.scores.min()) - 10.0
        for i in range(1, len(s) + 1):
            for k in range(max(0, i - self.longest), i):
                j = self.ids.get(s[k:i])
                v = best[k] + (self.scores[j] if j is not None else low) if j is not None or i - k == 1 else -np.inf
                if v > best[i]:
                    best[i], back[i] = v, k
        out, i = [], len(s)
        while i:
            k = back[i]
            out.append(self.ids.get(s[k:i], -1 - ord(s[k])))
            i = k
        return self._spelt(out[::-1])

    def _spelt(self, ids: list[int]) -> list[int]:
        out: list[int] = []
        for i in ids:
            out += [i] if i >= 0 else [int(self.bytes[b]) for b in chr(-1 - i).encode()]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b stay apart when their concatenation is encoded; characters without a piece always do."""
        key = a * len(self.pieces) + b
        slot = (mix(key.astype(U64)) & U64(_CACHE - 1)).astype(np.int64)
        out = (a < 0) | (b < 0)
        known = self.memo_key[slot] == key
        out |= known & self.memo[slot]
        ask = np.flatnonzero(~known & (a >= 0) & (b >= 0))
        if len(ask):
            ask = ask[np.unique(key[ask], return_index=True)[1]]
            got = self._apart(a[ask], b[ask])
            self.memo_key[slot[ask]], self.memo[slot[ask]] = key[ask], got
            # two keys of this call may share a slot: look again, and work out what was displaced
            left = np.flatnonzero(~known & (a >= 0) & (b >= 0))
            again = self.memo_key[slot[left]] == key[left]
            out[left[again]] = self.memo[slot[left[again]]]
            rest = left[~again]
            if len(rest):
                out[rest] = self._apart(a[rest], b[rest])
        return out

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges of both pieces from the last on; if the pieces that meet at the border could have merged before what was undone, they would have."""
        n, out = len(self.pieces), np.ones(len(a), bool)
        live, a, b = np.arange(len(a)), a.copy(), b.copy()
        top = np.int64(1) << 40
        limit = np.full(len(a), top)  # a merge of this rank or better comes first; of equal ranks the left one
        while len(live):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined = (self.pairs[at] == key) & (self.made[at] * 2 + 1 < limit)
            out[live[joined]] = False
            # the merge undone next is the later one of the two; within equal ranks the right one is later
            ra = np.where(self.left[a] == a, -1, self.rank[a] * 2)
            rb = np.where(self.left[b] == b, -1, self.rank[b] * 2 + 2)
            on = ~joined & ((ra >= 0) | (rb >= 0))
            use_a = ra > rb
            limit = np.where(use_a, ra, rb)[on]
            a, b = np.where(use_a, self.right[a], a)[on], np.where(use_a, b, self.left[b])[on]
            live = live[on]
        return out

    def words(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of equal length, a row of code points each: (ids by end position, piece lengths by end position); -1 for a character without a piece."""
        m, n = chars.shape
        with np.errstate(over="ignore"):
            h = np.zeros((m, n + 1), U64)
            for i in range(n):
                h[:, i + 1] = h[:, i] * U64(_BASE) + mix(chars[:, i].astype(U64) + U64(1))
            power = [U64(pow(_BASE, k, 1 << 64)) for k in range(self.longest + 1)]
            last = np.full((m, n + 1), UNKNOWN, np.int64)
            length = np.zeros((m, n + 1), np.int64)
            total = np.zeros((m, n + 1))
            low = float(self.scores.min()) - 10.0
            for i in range(1, n + 1):
                k = min(i, self.longest)
                sub = np.stack([h[:, i] - h[:, i - j] * power[j] for j in range(1, k + 1)], axis=1)
                at = np.minimum(np.searchsorted(self.keys, sub), len(self.keys) - 1)
                found = self.keys[at] == sub
                word, size = np.nonzero(found)
                piece = self.key_ids[at[word, size]]
                size = size + 1
                if self.bpe:
                    # the beginning of the word admits every piece
                    ok = (size == i) | self.apart(last[word, i - size], piece)
                    word, size, piece = word[ok], size[ok], piece[ok]
                    value = np.zeros(len(word))
                else:
                    value = total[word, i - size] + self.scores[piece]
                best = np.full(m, -np.inf)
                np.maximum.at(best, word, value)
                top = value == best[word]
                last[word[top], i], length[word[top], i] = piece[top], size[top]
                none = ~np.isfinite(best)
                last[none, i], length[none, i] = UNKNOWN, 1
                if not self.bpe:
                    alone = np.isfinite(best) & ~found[:, 0] & (total[:, i - 1] + low > best)
                    last[alone, i], length[alone, i] = UNKNOWN, 1
                    total[:, i] = np.where(none | alone, total[:, i - 1] + low, best)
        return last, length


def _hash(s: str) -> int:
    h = 0
    for x in mix(np.array([ord(c) for c in s], U64) + U64(1)):
        h = (h * _BASE + int(x)) % (1 << 64)
    return h


class Encoder:
    """Encodes batches; remembers the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()
        self.spaces = lru_cache(4096)(lambda n, body: np.array(model.scalar(SPACE * n + body), np.int32))

    def forget(self) -> None:
        # keys with their places in at and len; the recent ones apart, so that few of them are sorted in again
        self.sorted = [(np.zeros(0, U64), np.zeros(0, np.int64))] * 2
        self.at, self.len = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _add(self, keys: np.ndarray) -> None:
        old, recent = self.sorted
        places = np.arange(len(self.at) - len(keys), len(self.at))
        recent = (np.concatenate([recent[0], keys]), np.concatenate([recent[1], places]))
        if len(recent[0]) * 4 > len(old[0]):
            old, recent = (np.concatenate([old[0], recent[0]]), np.concatenate([old[1], recent[1]])), (keys[:0], places[:0])
            order = np.argsort(old[0])
            old = (old[0][order], old[1][order])
        else:
            order = np.argsort(recent[0])
            recent = (recent[0][order], recent[1][order])
        self.sorted = [old, recent]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of words, -1 for those not known."""
        out = np.full(len(keys), -1, np.int64)
        for known, places in self.sorted:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                out[hit] = places[at[hit]]
        return out

    def _learn(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, spaces: np.ndarray, b: np.ndarray) -> None:
        """Adds distinct words, given by their bytes in b and the spaces before them (2 stands for more, told by the bytes)."""
        model = self.model
        n = ends - starts
        bytes_ = b[take_ranges(starts, n)]
        chars, at = characters(bytes_)
        first = np.searchsorted(at, np.cumsum(n) - n)
        count = np.diff(np.append(first, len(chars)))
        size = count + spaces
        new_at, new_len, parts, base = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), [], len(self.tokens)
        for length in np.unique(size):
            own = np.flatnonzero(size == length)
            if length > LONG or length == 0:
                for w in own:
                    t = np.array(model.scalar(SPACE * int(spaces[w]) + bytes(b[starts[w] : ends[w]]).decode("utf-8", "replace")), np.int32)
                    new_at[w], new_len[w] = base, len(t)
                    parts.append(t)
                    base += len(t)
                continue
            rows = np.full((len(own), int(length)), ord(SPACE), np.int64)
            for s in (0, 1):
                k = spaces[own] == s
                if k.any():
                    rows[k, s:] = chars[take_ranges(first[own[k]], count[own[k]])].reshape(-1, int(length) - s)
            last, back = model.words(rows)
            # backpointers from the end on, for all words of this length
            out, row, end = [], np.arange(len(own)), np.full(len(own), int(length))
            while len(row):
                out.append((row, end, last[row, end]))
                end = end - back[row, end]
                row, end = row[end > 0], end[end > 0]
            row, end, piece = (np.concatenate(x) for x in zip(*out))
            order = np.lexsort((end, row))
            row, end, piece = row[order], end[order], piece[order]
            lost = np.flatnonzero(piece < 0)
            if len(lost):
                spelt = [np.array([model.bytes[x] for x in chr(int(rows[row[k], end[k] - 1])).encode("utf-8", "replace")], np.int64) for k in lost]
                many = np.ones(len(piece), np.int64)
                many[lost] = [len(x) for x in spelt]
                row, at_ = np.repeat(row, many), np.cumsum(many) - many
                full = np.repeat(piece, many)
                full[take_ranges(at_[lost], many[lost])] = np.concatenate(spelt)
                piece = full
            k = np.bincount(row, minlength=len(own))
            new_len[own], new_at[own] = k, base + np.cumsum(k) - k
            parts.append(piece.astype(np.int32))
            base += len(piece)
        self.tokens = np.concatenate([self.tokens, *parts])
        self.at, self.len = np.concatenate([self.at, new_at]), np.concatenate([self.len, new_len])
        self._add(keys)

    def encode(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        model, docs = self.model, len(offsets) - 1
        b, offsets = _marks_as_spaces(b, offsets)
        if len(self.at) > KEPT:
            self.forget()
        words = Words(b, offsets, model.table)
        starts, ends = words.starts, words.ends
        space = b == 32
        begin = offsets[:-1][np.diff(offsets) > 0]
        # runs of spaces, cut at documents
        on = np.zeros(len(b) + 1, bool)
        on[:-1] = space
        new = on.copy()
        new[1:] &= ~on[:-1]
        new[begin] |= on[begin]
        run = np.flatnonzero(new[:-1])
        stop = np.flatnonzero(~on)
        cut = np.append(begin, len(b))
        run_end = np.minimum(stop[np.searchsorted(stop, run)], cut[np.searchsorted(cut, run, "right")]) if len(run) else run
        size = run_end - run + np.isin(run, begin)
        # a run belongs to the word behind it, unless a control character or the text's end is behind it
        word = np.searchsorted(starts, run_end)
        joins = (word < len(starts)) & (starts[np.minimum(word, len(starts) - 1)] == run_end) & ~np.isin(run_end, begin) if len(starts) else np.zeros(len(run), bool)
        before = np.zeros(len(starts), np.int64)
        before[word[joins]] = size[joins]
        before[np.isin(starts, begin)] = 1
        control = np.flatnonzero((model.table[b] == 0) & ~space)
        dummy = begin[(model.table[b[begin]] == 0) & ~space[begin]]  # a text that begins with a control character has its dummy space alone
        one = before < 2
        with np.errstate(over="ignore"):
            keys = mix(words.hashes + before.astype(U64) * U64(0xD6E8FEB86659FD93))
        distinct, first, index = np.unique(keys[one], return_index=True, return_inverse=True)
        at = self.find(distinct)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            w = np.flatnonzero(one)[first[fresh]]
            self._learn(distinct[fresh], starts[w], ends[w], before[w], b)
            at = self.find(distinct)
        store, extra = [self.tokens], len(self.tokens)

        def stored(x: np.ndarray) -> tuple[int, int]:
            nonlocal extra
            store.append(x)
            extra += len(x)
            return extra - len(x), len(x)

        pos, tok_at, tok_len = [starts[one] * 2], [self.at[at][index] if len(distinct) else at[:0]], [self.len[at][index] if len(distinct) else at[:0]]
        for w in np.flatnonzero(~one):
            i, n = stored(self.spaces(int(before[w]), bytes(b[starts[w] : ends[w]]).decode("utf-8", "replace")))
            pos.append([starts[w] * 2]), tok_at.append([i]), tok_len.append([n])
        loose = {int(n): stored(self.spaces(int(n), "")) for n in np.unique(size[~joins])}
        pos.append(run[~joins] * 2), tok_at.append([loose[int(n)][0] for n in size[~joins]]), tok_len.append([loose[int(n)][1] for n in size[~joins]])
        if len(dummy):
            i, n = stored(self.spaces(1, ""))
            pos.append(dummy * 2 - 1), tok_at.append(np.full(len(dummy), i)), tok_len.append(np.full(len(dummy), n))
        if len(control):
            i, _ = stored(model.bytes[:32].astype(np.int32))
            pos.append(control * 2), tok_at.append(i + b[control].astype(np.int64)), tok_len.append(np.ones(len(control), np.int64))
        pos, tok_at, tok_len = (np.concatenate([np.asarray(x, np.int64) for x in y]) for y in (pos, tok_at, tok_len))
        order = np.argsort(pos, kind="stable")
        pos, tok_at, tok_len = pos[order], tok_at[order], tok_len[order]
        ids = np.concatenate(store)[take_ranges(tok_at, tok_len)]
        ends_ = np.concatenate([[0], np.cumsum(tok_len)])
        return ids, ends_[np.searchsorted(pos, offsets * 2 - 1)] if docs else np.zeros(1, np.int64)


def _marks_as_spaces(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The model's own mark for a space, where a text has it, is a space to the encoder."""
    at = np.flatnonzero(b == 0xE2)
    at = at[at + 2 < len(b)]
    at = at[(b[at + 1] == 0x96) & (b[at + 2] == 0x81)]
    if not len(at):
        return b, offsets
    b, keep = b.copy(), np.ones(len(b), bool)
    b[at] = 32
    keep[at + 1] = keep[at + 2] = False
    return b[keep], offsets - 2 * np.searchsorted(at, offsets)


def decode(model: Model, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each), without the dummy spaces."""
    n = model.text_len[ids]
    b = model.text[take_ranges(model.text_at[ids], n)]
    ends = np.concatenate([[0], np.cumsum(n)])[offsets]
    some = np.diff(ends) > 0
    drop = ends[:-1][some]
    drop = drop[b[drop] == 32]
    keep = np.ones(len(b), bool)
    keep[drop] = False
    return b[keep], ends - np.searchsorted(drop, ends)


@lru_cache(2)
def load(path: str) -> tuple[Model, Encoder]:
    model = Model(path)
    return model, Encoder(model)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, exact) of every document; exact: the ids decode to the text, byte for byte.

    model_path: a SentencePiece model file that all executors can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encoder = load(model_path)
        for rb, b, o in chunks(batches):
            ids, at = encoder.encode(b, o)
            back, ends = decode(model, ids, at)
            same = np.diff(ends) == np.diff(o)
            if len(back) == len(b) and same.all():
                wrong = np.concatenate([[0], np.cumsum(back != b)])
                same &= wrong[o[1:]] == wrong[o[:-1]]
            else:
                same = np.array([bytes(back[ends[k] : ends[k + 1]]) == bytes(b[o[k] : o[k + 1]]) for k in range(len(same))], bool)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(np.diff(at).astype(np.int32)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32())), pa.array(same)], names=["doc_id", "n_tokens", "ids", "exact"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens int, ids array<int>, exact boolean")

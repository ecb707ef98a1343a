"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. A passage is encoded by the log odds that its words, and
the first 4, 6 and 8 bytes of its words, have for each label (their maximum and mean), and by its shares of symbols,
capitals, digits, line ends, repeated neighbours and by its size. For each head (low quality, toxic) a gated
attention network learns, from document labels alone, the passages' weights

    a_k = softmax_k( w . (tanh(V h_k) * sigmoid(U h_k)) ),

and the score of a document is sigmoid(c . sum_k a_k h_k + b). A document is kept if neither score is
above `reject_above`.

The log odds are fitted on one half of a bounded sample of labelled documents (`most_labelled`, those with
the least hashes of their ids), the network on the other half; every document of the table is scored whole.

Defined results: a null or empty text, or one without words, has no passage and scores the share of
its label in the sample; labels that are null, or whose document or text is missing, are left out; of repeated labels of one
document the greatest of each kind counts; a head that saw only one class scores that share, 0 or 1;
without labels all scores are 0 and every document is kept; repeated rows score alike; an empty table gives
an empty result. Of docs only doc_id and text are read, of labels doc_id, quality and toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import CHUNK_BYTES, FOLDED, Words, chunks

PASSAGE = 64
BUCKETS = 1 << 18
HEADS = (0, 4, 6, 8)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "*#%$&|!{}<>\\^~=_@+/[]"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Bags:
    """Passages of the documents of a buffer: first (of each document, with the end), buckets of the words, shapes."""

    def __init__(self, b: np.ndarray, offsets: np.ndarray):
        words = Words(b, offsets, FOLDED)
        counts = np.diff(words.first)
        n = -(-counts // PASSAGE)
        self.first = np.concatenate([[0], np.cumsum(n)])
        doc = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(doc)) - self.first[doc]
        self.word = words.first[doc] + k * PASSAGE
        self.end = np.minimum(self.word + PASSAGE, words.first[doc + 1])
        self.words = len(words.hashes)
        self.buckets = [((words.heads(h) if h else words.hashes) % np.uint64(BUCKETS)).astype(np.int32) for h in HEADS]
        if not len(doc):
            self.shapes = np.zeros((0, 6), np.float32)
            return
        begin = np.where(k == 0, offsets[doc], words.starts[self.word])
        stop = np.where(self.end < words.first[doc + 1], words.starts[np.minimum(self.end, self.words - 1)], offsets[doc + 1])
        size = (self.end - self.word).astype(np.float64)

        def share(kind: np.ndarray) -> np.ndarray:
            c = np.concatenate([[0], np.cumsum(kind, dtype=np.int64)])
            return c[stop] - c[begin]

        same = np.zeros(self.words, bool)
        same[1:] = words.hashes[1:] == words.hashes[:-1]
        c = np.concatenate([[0], np.cumsum(same, dtype=np.int64)])
        length = np.maximum(stop - begin, 1)
        self.shapes = np.stack(
            [np.minimum(share(_SYMBOL[b]) / size, 4.0), share(_UPPER[b]) / length, share(_DIGIT[b]) / length, share(b == 10) / size, (c[self.end] - c[self.word]) / size, size / PASSAGE], axis=1
        ).astype(np.float32)

    def encode(self, odds: np.ndarray) -> np.ndarray:
        """Features of the passages. odds: (label, head, bucket)."""
        if not len(self.word):
            return np.zeros((0, 2 * odds.shape[0] * len(HEADS) + 6), np.float32)
        out = []
        for table in odds:
            for bucket, t in zip(self.buckets, table):
                s = t[bucket]
                out += [np.maximum.reduceat(s, self.word), np.add.reduceat(s, self.word) / (self.end - self.word)]
        return np.concatenate([np.stack(out, axis=1), self.shapes], axis=1).astype(np.float32)


def log_odds(one: np.ndarray, every: np.ndarray, ones: int, all_: int) -> np.ndarray:
    """Log odds of label 1 for documents that have each bucket, shrunk where few have it: `one` of the `ones` with label 1 and `every` of `all_` documents."""
    odds = np.log((one + 0.5) / (ones + 1)) - np.log((every - one + 0.5) / (all_ - ones + 1))
    return (odds * every / (every + 3)).astype(np.float32)


class Attention:
    """Gated attention over the passages of a bag, and a logistic unit on the weighted passage."""

    def __init__(self, features: int, hidden: int = 8, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {"V": r.normal(0, 0.3, (features, hidden)), "U": r.normal(0, 0.3, (features, hidden)), "w": r.normal(0, 0.3, hidden), "c": np.zeros(features), "b": np.zeros(1)}
        self.mean, self.scale = np.zeros(features), np.ones(features)

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(score of each bag, attention, ...) of standardised passages; bags aren't empty."""
        p = self.p
        t, s = np.tanh(x @ p["V"]), 1 / (1 + np.exp(-np.clip(x @ p["U"], -30, 30)))
        e = (t * s) @ p["w"]
        n = np.diff(np.append(first, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), n))
        a /= np.repeat(np.add.reduceat(a, first), n)
        z = np.add.reduceat(a[:, None] * x, first)
        return 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30))), a, z, t, s, n

    def fit(self, x: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = 250, rate: float = 0.05, decay: float = 1e-3) -> Attention:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        m, v = ({k: np.zeros_like(q) for k, q in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            y, a, z, t, s, n = self.forward(x, first)
            d = (y - label) / len(label)
            dx = x @ self.p["c"] * np.repeat(d, n)  # of the attention
            de = a * (dx - np.repeat(np.add.reduceat(a * dx, first), n))
            dh = de[:, None] * self.p["w"]
            g = {"c": d @ z, "b": np.array([d.sum()]), "w": de @ (t * s), "V": x.T @ (dh * s * (1 - t * t)), "U": x.T @ (dh * t * s * (1 - s))}
            for k in self.p:
                g[k] = g[k] + decay * self.p[k] * (k != "b")
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale, first)[0]


class Classifier:
    """Log odds, and for each label its network, or the share that every document scores."""

    def __init__(self, texts: list[str] | pa.Array, labels: np.ndarray):
        n = len(labels)
        self.share = labels.mean(axis=0) if n else np.zeros(2)
        self.odds = np.zeros((2, len(HEADS), BUCKETS), np.float32)
        self.nets: list[Attention | None] = [None, None]
        if not n:
            return
        table = pa.table({"text": pa.array(texts, pa.string())})
        half = np.arange(n) % 2 == 0
        one, every = np.zeros((2, len(HEADS), BUCKETS)), np.zeros((len(HEADS), BUCKETS))
        for _, b, o, rows in self._halves(table, half):
            bags = Bags(b, o)
            doc = np.repeat(np.arange(len(o) - 1), np.diff(bags.first))
            doc = np.repeat(doc, bags.end - bags.word).astype(np.int64)
            for k, bucket in enumerate(bags.buckets):
                seen = np.unique(doc * BUCKETS + bucket)
                d, bucket = rows[seen // BUCKETS], seen % BUCKETS
                every[k] += np.bincount(bucket, minlength=BUCKETS)
                for y in range(2):
                    one[y, k] += np.bincount(bucket, weights=labels[d, y], minlength=BUCKETS)
        for y in range(2):
            if 0 < labels[half, y].sum() < half.sum():
                for k in range(len(HEADS)):
                    self.odds[y, k] = log_odds(one[y, k], every[k], labels[half, y].sum(), half.sum())
        del one, every
        x, own = [np.zeros((0, 4 * len(HEADS) + 6), np.float32)], [np.zeros(0, np.int64)]
        for _, b, o, rows in self._halves(table, ~half):
            bags = Bags(b, o)
            x.append(bags.encode(self.odds))
            own.append(np.repeat(rows, np.diff(bags.first)))
        x, own = np.concatenate(x), np.concatenate(own)
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
        for y in range(2):
            t = labels[own[first], y].astype(np.float64)
            if len(t) and 0 < t.sum() < len(t):
                self.nets[y] = Attention(x.shape[1]).fit(x.astype(np.float64), first, t)

    @staticmethod
    def _halves(table: pa.Table, use: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        """chunks of the rows in use, with their row numbers."""
        rows, at = np.flatnonzero(use), 0
        for rb, b, o in chunks(iter(table.filter(pa.array(use)).to_batches()), most=CHUNK_BYTES // 2):
            yield rb, b, o, rows[at : at + rb.num_rows]
            at += rb.num_rows

    def score(self, b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(document, label) scores of the documents of a buffer."""
        bags = Bags(b, offsets)
        out = np.tile(self.share, (len(offsets) - 1, 1)).astype(np.float64)
        some = np.flatnonzero(np.diff(bags.first))
        if len(some):
            x = bags.encode(self.odds)
            for y, net in enumerate(self.nets):
                if net is not None:
                    out[some, y] = net.score(x, bags.first[some])
        return out


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = 10_000) -> Classifier:
    """Classifier of (low quality, toxic), fitted on `most_labelled` labelled documents at most."""
    rows = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled)
    d = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    got = d.join(F.broadcast(rows), "doc_id").dropDuplicates(["doc_id"]).toArrow()
    order = np.argsort(np.array(got.column("doc_id")), kind="stable")
    got = got.take(pa.array(order))
    y = np.stack([1 - np.array(got.column("quality"), np.float64), np.array(got.column("toxic"), np.float64)], axis=1) if len(got) else np.zeros((0, 2))
    return Classifier(got.column("text").combine_chunks() if len(got) else [], y)


def classify(docs: DataFrame, labels: DataFrame, reject_above: float = 0.5, most_labelled: int = 10_000) -> DataFrame:
    """(doc_id, p_low, p_toxic, keep) of every document."""
    return _scored(docs.select("doc_id", "text"), fit(docs, labels, most_labelled), reject_above)


def _scored(docs: DataFrame, model: Classifier, reject_above: float, keep_columns: bool = False) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, b, o in chunks(batches):
            p = shared.value.score(b, o)
            keep = (p <= reject_above).all(axis=1)
            if keep_columns:
                yield rb.filter(pa.array(keep))
            else:
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(np.round(p[:, 0], 6)), pa.array(np.round(p[:, 1], 6)), pa.array(keep)], names=["doc_id", "p_low", "p_toxic", "keep"])

    if keep_columns:
        return docs.mapInArrow(run, docs.schema)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, p_low double, p_toxic double, keep boolean")


def accepted(docs: DataFrame, labels: DataFrame, reject_above: float = 0.5, most_labelled: int = 10_000) -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns."""
    return _scored(docs, fit(docs, labels, most_labelled), reject_above, keep_columns=True)

"""Graphs of similar documents: nodes are distinct contents, edges candidates or verified pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import chunks
from ._spark import checkpointed, semi_join


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the edges, without the least nodes themselves."""
    names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = index[: len(a)], index[len(a) :]
    label = np.arange(len(names))
    while True:
        x, y = label[i], label[j]
        on = x != y
        if not on.any():
            break
        i, j, x, y = i[on], j[on], x[on], y[on]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up
    own = np.flatnonzero(label != np.arange(len(names)))
    return names[own], names[label[own]]


def forest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, of which a partition has fewer than nodes: what a dense group sends on grows with its nodes, not its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rb in batches:
            held.append((rb.column(0).to_numpy(), rb.column(1).to_numpy()))
            size += rb.num_rows
            if size > 1 << 20:
                held = [stars(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0]) // 2
        if held:
            a, b = stars(*(np.concatenate(x) for x in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return edges.select("a", "b").where("a is not null and b is not null").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph with edges (a, b): the least node of each connected component, by alternating large and small stars."""
    e = checkpointed(forest(edges).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every greater neighbour is linked to the least one
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: every lesser neighbour, and the node itself, are linked to the least one
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(near.select("u", F.col("m").alias("v"))).distinct()
        new = checkpointed(small)
        changed = new.join(e, ["u", "v"], "left_anti").limit(1).count() or e.join(new, ["u", "v"], "left_anti").limit(1).count()
        e = new
        if not changed:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


#: Nodes of a component whose contents are compared in one task; a larger one is cut into blocks by hash, and each pair of blocks with candidates is a task of its own.
BLOCK_NODES = 1000
LINKS = "a long, b long, n long"


def links_of(x: np.ndarray, y: np.ndarray, names: np.ndarray, weights: np.ndarray) -> pa.RecordBatch | None:
    """Rows of LINKS for the links between names[x] and names[y], each once: a forest (a, b) of the linked nodes, and (a, null, documents that the node is linked to)."""
    if not len(x):
        return None
    a, b = stars(names[x], names[y])
    n = np.bincount(x, weights[y], len(names)) + np.bincount(y, weights[x], len(names))
    own = np.flatnonzero(n)
    none = pa.nulls(len(own), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, names[own]])), pa.chunked_array([pa.array(b), none]).combine_chunks(), pa.array(np.concatenate([np.zeros(len(a)), n[own]]).astype(np.int64))], names=["a", "b", "n"])


def sized(nodes: DataFrame) -> DataFrame:
    """(node, rep, size): the least doc_id and the number of documents of each content; nodes are (doc_id, node) without repeated rows."""
    return nodes.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"), *(F.max(c).alias(c) for c in ("octets", "chars") if c in nodes.columns))


def verified(
    docs: DataFrame, nodes: DataFrame, candidates: DataFrame, encode: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, list[bytes]]], prepare: Callable[[list[np.ndarray]], Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]], parts: int
) -> DataFrame:
    """Rows of LINKS for the candidate pairs (a, b) of nodes that hold.

    nodes: (node, rep, size). encode(bytes, offsets) gives each document's node and content; prepare(contents) a
    function of (i, j) that gives the values of pairs of contents and whether they hold. The contents of a component of
    candidates of up to BLOCK_NODES meet in one task, once each; those of a larger one by pairs of blocks, a content where it
    has a candidate. A task's rows are sorted by key, contents first, so a worker holds the contents of one key and one
    batch of its pairs.
    """
    home = checkpointed(components(candidates))
    large = home.groupBy("component").count().where(F.col("count") > BLOCK_NODES).select("component", F.ceil(F.col("count") / BLOCK_NODES).alias("blocks"))
    home = home.join(large, "component", "left")

    def block(x):
        return F.pmod(F.xxhash64(F.lit(11), x), F.col("blocks"))

    key = F.when(F.col("blocks").isNull(), F.xxhash64("component")).otherwise(F.xxhash64("component", F.least(block("a"), block("b")), F.greatest(block("a"), block("b"))))
    edges = candidates.join(home.withColumnRenamed("node", "a"), "a").select(key.alias("key"), "a", "b", "blocks")
    whole = home.where("blocks is null").select(F.xxhash64("component").alias("key"), "node")
    cut = edges.where("blocks is not null")
    where = whole.unionByName(cut.select("key", F.col("a").alias("node")).unionByName(cut.select("key", F.col("b").alias("node"))).distinct())
    some = checkpointed(nodes.join(where, "node").select("key", "node", "rep", "size"))

    def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, b, o in chunks(batches):
            keys, blobs = encode(b, o)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(keys), pa.array(blobs, pa.binary())], names=["rep", "node", "content"])

    own = semi_join(docs, some.select(F.col("rep").alias("doc_id")).distinct(), ["doc_id"]).select("doc_id", "text").mapInArrow(content, "rep long, node long, content binary")
    part = F.pmod("key", F.lit(parts)).cast("int").alias("part")
    own = own.join(some, ["rep", "node"]).select(part, "key", F.col("node").alias("a"), F.col("size").alias("b"), "content")
    edges = edges.select(part, "key", "a", "b", F.lit(None).cast("binary").alias("content"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, sizes, held, compare = None, [], [], [], None
        for rb in batches:
            group, a = (rb.column(k).to_numpy() for k in (1, 2))
            has = rb.column(4).is_valid().to_numpy(zero_copy_only=False)
            b = rb.column(3).to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]])
            for i, j in zip(edge[:-1], edge[1:]):
                if i == j:
                    continue
                if group[i] != now:
                    now, names, sizes, held, compare = group[i], [], [], [], None
                for r in i + np.flatnonzero(has[i:j]):
                    if not names or a[r] != names[-1]:
                        names.append(int(a[r]))
                        sizes.append(int(b[r]))
                        held.append(np.frombuffer(rb.column(4)[int(r)].as_py(), np.uint8))
                pairs = i + np.flatnonzero(~has[i:j])
                if len(pairs):
                    if compare is None:
                        compare, held = prepare(held), []
                        names, sizes = np.array(names, np.int64), np.array(sizes, np.float64)
                    x, y = np.searchsorted(names, a[pairs]), np.searchsorted(names, b[pairs])
                    ok = compare(x, y)[1]
                    if (out := links_of(x[ok], y[ok], names, sizes)) is not None:
                        yield out

    rows = own.unionByName(edges).repartitionById(parts, F.col("part")).sortWithinPartitions("key", F.col("content").isNull(), "a")
    return rows.mapInArrow(verify, LINKS)


def by_document(nodes: DataFrame, each: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) of the documents that have a link, one row each.

    nodes: (doc_id, node) without repeated rows; each: sized(nodes); links: rows of LINKS. A document is linked to those of the same
    node and to those of the nodes that its node is linked to. A class is what links connect; its id is its least doc_id.
    """
    count = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    some = checkpointed(each.join(count, "node", "left").where("n is not null or size > 1").join(components(links.where("b is not null")), "node", "left").withColumn("component", F.coalesce("component", "node")))
    # copies of one text, most of which have no other link, need no look at their component
    least = some.where("n is not null").groupBy("component").agg(F.min("rep").alias("least"))
    per = some.join(least, "component", "left").select("node", F.coalesce("least", "rep").alias("class_id"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    return nodes.join(per, "node").groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.sum("n_links").cast("bigint").alias("n_links"))

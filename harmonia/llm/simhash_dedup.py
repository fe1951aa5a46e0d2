"""SimHash near-duplicates with BK-trees.

Documents get a 64-bit fingerprint; equal fingerprints fold into one class before anything else, so a
group of copies costs one node.  Classes whose fingerprints differ in at most ``radius`` bits link.

Two fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bands of their bits.
Each band's leading bits name a shard; every shard holds about ``tree_size`` fingerprints whatever the
size of the corpus.  In each shard a BK-tree is built (a child hangs under its parent by the integer
Hamming distance between them) and the shard's own fingerprints search it, following only the edges
whose distance lies within the radius of the query's.  All trees together are all fingerprints, so
they are not sent through the driver: the shuffle brings a shard's tree and its queries together.  A
shard that a hot band value has swollen is cut into blocks of nodes and blocks of queries, and each
tree goes to every block of queries.  Within a task the links found are folded into a forest, so a
dense group sends a link per member and not one per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bound_batches, fresh, materialise, table, utf8
from .graph import components

SHINGLE = 3
RADIUS = 2
TREE_SIZE = 4096
#: Shingles hashed at a time, which bounds the memory of a very long text.
SLICE = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles, repeats included; zero without words."""
    words = text.translate(LOWER).split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    total = n - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, SLICE):
        to = min(total, at + SLICE)
        spans = zip(starts[at:to].tolist(), ends[at + shingle - 1:to + shingle - 1].tolist())
        hashes = np.fromiter((digest(joined[i:j], 42) for i, j in spans), dtype="<u8", count=to - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, to: str = "fp") -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column."""
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return docs.withColumn(to, fp(utf8(F.col(text))))


class BKTree:
    """BK-tree over distinct unsigned 64-bit values; node i is ``values[i]``, node 0 the root."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.child = np.full((max(1, len(values)), 65), -1, dtype=np.int32)
        plain = values.tolist()
        child: list[dict[int, int]] = [{} for _ in plain]
        for node in range(1, len(plain)):
            v, at = plain[node], 0
            while True:
                d = (v ^ plain[at]).bit_count()
                below = child[at].get(d)
                if below is None:
                    child[at][d] = node
                    self.child[at, d] = node
                    break
                at = below

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query index, node) pairs within the radius; all queries walk the tree level by level."""
        found_q, found_n = [], []
        if len(self.values):
            q = np.arange(len(queries))
            node = np.zeros(len(queries), dtype=np.int32)
            while len(q):
                d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
                hit = d <= radius
                found_q.append(q[hit])
                found_n.append(node[hit])
                next_q, next_n = [], []
                for edge in range(-radius, radius + 1):
                    e = d + edge
                    below = self.child[node, np.clip(e, 0, 64)]
                    go = (below >= 0) & (e >= 0) & (e <= 64)
                    next_q.append(q[go])
                    next_n.append(below[go])
                q, node = np.concatenate(next_q), np.concatenate(next_n)
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_n).astype(np.int64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` items over the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def link_fingerprints(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Forest links (u, v) that connect exactly the distinct values of ``fps.fp`` within ``radius`` bits."""
    n = fps.count()
    bands = radius + 1
    width = 64 // bands
    bits = min(width, max(0, math.ceil(math.log2(max(1, n) / tree_size))))
    keys = [F.lit(0).cast("long")] if bits == 0 else [
        F.shiftrightunsigned("fp", 64 - b * width - bits).bitwiseAND(F.lit((1 << bits) - 1)) for b in range(bands)]
    rows = fps.select("fp", F.posexplode(F.array(*keys)).alias("band", "shard"))
    blocks = (rows.groupBy("band", "shard").count()
              .select("band", "shard", F.ceil(F.col("count") / (4 * tree_size)).cast("int").alias("blocks")))
    i = F.sequence(F.lit(0), F.col("blocks") - 1)
    place = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("t"), F.lit(0).alias("q"), F.lit(3).alias("role")))).otherwise(
        F.flatten(F.transform(i, lambda x: F.array(
            F.struct(F.col("own").alias("t"), x.alias("q"), F.lit(1).alias("role")),
            F.struct(x.alias("t"), F.col("own").alias("q"), F.lit(2).alias("role"))))))
    placed = (rows.join(blocks, ["band", "shard"])
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
              .select("band", "shard", "fp", F.explode(place).alias("p")).select("band", "shard", "fp", "p.*"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        role = pdf["role"].to_numpy()
        nodes, queries = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        values = fp.view(np.uint64)
        tree = BKTree(values[nodes])
        a, b = [], []
        for at in range(0, len(queries), tree_size):
            part = queries[at:at + tree_size]
            q, node = tree.search(values[part], radius)
            other = nodes[node]
            apart = values[part[q]] != values[other]
            a.append(part[q][apart])
            b.append(other[apart])
        if not a:
            return pd.DataFrame({"u": fp[:0], "v": fp[:0]})
        label = forest(len(fp), np.concatenate(a), np.concatenate(b))
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"u": fp[linked], "v": fp[label[linked]]})

    return placed.groupBy("band", "shard", "t", "q").applyInPandas(search, "u long, v long")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of ``radius`` bits or fewer.  Null
    and empty texts have the zero fingerprint and link like any other; repeated rows each get a row;
    a null doc_id never names a component unless all its members are null; an empty table gives no
    rows.  Other columns of ``docs`` are ignored.
    """
    bound_batches(docs.sparkSession)
    fps = materialise(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
                      .select("doc_id", "fp"), "simhash-fp")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-class")
    roots = components(link_fingerprints(classes.select("fp"), radius, tree_size), "simhash-links")
    rooted = (classes.join(roots, classes.fp == roots.node, "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept: that of smallest (doc_id, hash of the text), null ids last.

    So near copies that share an id, or have none, leave one row too, and repeated rows (same doc_id and text) leave one;
    rows of one id whose texts are in different components are different documents.  An empty table gives no rows.
    """
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit("")), F.lit(3)).alias("h"))
    found = materialise(simhash_components(docs.select(who.alias("doc_id"), "text"), shingle=shingle, radius=radius)
                        .select("doc_id", "component_id"), "simhash-kept")

    def key_of(no_id: Column, doc_id: Column, h: Column) -> Column:
        return F.concat_ws(":", h.cast("string"), F.when(no_id, F.lit("")).otherwise(F.concat(F.lit("id "), doc_id.cast("string"))))

    key = fresh(docs, "kept_key")
    named = found.where("doc_id <=> component_id").select(key_of(F.col("doc_id.no_id"), F.col("doc_id.id"), F.col("doc_id.h")).alias("kept"))
    keyed = docs.withColumn(key, key_of(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")), F.lit(3))))
    keep = named.distinct()
    # the build side of each task is a part of the kept keys; documents stream past it and are not sorted
    kept = keyed.join(keep.hint("shuffle_hash"), keyed[key] == keep["kept"], "left_semi")
    if named.groupBy("kept").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([key])
    return kept.select(*docs.columns)


def op3_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))

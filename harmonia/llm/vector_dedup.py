"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector o is turned by a random rotation and kept as the signs of its coordinates.  With
x = signs / sqrt(d) and the stored correction factor f = <x, turned o>, the inner product with any unit
vector q is estimated without bias by <x, turned q> / f, and the estimate errs by more than
``sigmas * sqrt((1 - f^2) / f^2 / (d - 1))`` only with a probability that falls off like a normal tail.
Only pairs whose upper bound reaches the threshold are recomputed, in double precision.

Equal vectors fold into one class first.  Pairs of classes are looked for in cells: the leading bits of
a code name a cell, and several rotations give every vector several cells.  The number of bits
follows from the number of classes, so a cell holds about ``CELL`` of them at any size; the number of
rotations follows from the chance that a pair at the threshold shares a cell at least once.  A pair that
meets in several cells is counted in the first.  A cell that a dense cluster has swollen is cut
into blocks, and each pair of blocks is compared in a task of its own.  A task returns a link count per
vector and a forest of its links, not the pairs.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, table
from .graph import components
from .simhash_dedup import forest

THRESHOLD = 0.9
#: Classes in a cell, about; cells over four times as many are cut into blocks.
CELL = 512
#: Chance that a pair at the threshold shares a cell (closer pairs do more often).
RECALL = 0.99
#: Standard deviations of the estimate's error that the bound allows for.
SIGMAS = 4.0
SEED = 2


@lru_cache(maxsize=64)
def rotation(d: int, number: int, seed: int = SEED) -> np.ndarray:
    """Random d x d rotation; the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng([seed, number, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def usable(vector: Column) -> Column:
    """A vector that can link: not null, every component finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def tables_for(bits: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Rotations needed so that a pair at the threshold shares ``bits`` leading bits at least once."""
    if bits == 0:
        return 1
    shared = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - shared))


def encode(unit: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signs as booleans, correction factors, turned vectors) of unit row vectors."""
    turned = unit @ rotation(unit.shape[1], number).T
    return turned > 0, np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1]), turned


def estimate(signs: np.ndarray, factor: np.ndarray, turned: np.ndarray, sigmas: float = SIGMAS) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of <q, o> (queries x codes) and the half width of each code's confidence bound."""
    d = turned.shape[1]
    x = (2.0 * signs - 1.0).astype(np.float32) / np.float32(math.sqrt(d))
    inner = (turned.astype(np.float32) @ x.T) / factor.astype(np.float32)
    return inner, sigmas * np.sqrt(np.maximum(0.0, 1 - factor ** 2) / factor ** 2 / max(1, d - 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)   # huge and tiny components square safely
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _cells(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Rows (key, vector, copies, cells, d, t, cell): ``cells`` lists the class's cell in every rotation."""
    def place(batches):
        for pdf in batches:
            out = []
            dims = pdf["vector"].map(len).to_numpy()
            for d in np.unique(dims):
                part = pdf[dims == d]
                unit = _unit(np.stack(part["vector"].to_numpy()).astype(np.float64))
                own = np.zeros((len(part), tables), dtype="<i4")
                used = min(bits, int(d))
                for t in range(tables if used else 0):
                    # leading bits of the turned vector's signs
                    lead = unit @ rotation(int(d), t)[:used].T > 0
                    own[:, t] = lead @ (1 << np.arange(used))
                out.append(part.assign(d=int(d), cells=[r.tobytes() for r in own], own=list(own)))
            if out:
                yield pd.concat(out)[["key", "vector", "copies", "d", "cells", "own"]]
    placed = classes.mapInPandas(place, "key long, vector array<double>, copies long, d int, cells binary, own array<int>")
    return placed.select("key", "vector", "copies", "d", "cells", F.posexplode("own").alias("t", "cell"))


def link(classes: DataFrame, n: int, threshold: float = THRESHOLD, cell: int = CELL, recall: float = RECALL,
         sigmas: float = SIGMAS) -> DataFrame:
    """Rows (key, links, root) of ``classes`` (key, vector, copies): partial link counts, and forest links where root is not null."""
    bits = max(0, math.ceil(math.log2(max(1, n) / cell)))
    tables = tables_for(bits, threshold, recall)
    rows = materialise(_cells(classes, bits, tables), "vector-cells")
    sizes = rows.groupBy("d", "t", "cell").count().select(
        F.col("d").alias("d_"), F.col("t").alias("t_"), F.col("cell").alias("cell_"), F.ceil(F.col("count") / (4 * cell)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j")))
    dealt = (rows.join(sizes, (F.col("d") == F.col("d_")) & (F.col("t") == F.col("t_")) & (F.col("cell") == F.col("cell_")))
             .withColumn("block", block).withColumn("pair", F.explode(pair)).select(
                 "d", "t", "cell", "pair.i", "pair.j", "block", "key", "vector", "copies", "cells"))

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        d, t, _, i, j = map(int, key)
        pdf = pdf.sort_values("key").reset_index(drop=True)
        unit = _unit(np.stack(pdf["vector"].to_numpy()).astype(np.float64))
        signs, factor, turned = encode(unit, t)
        cells = np.stack([np.frombuffer(c, "<i4") for c in pdf["cells"]])
        block, copies, keys = pdf["block"].to_numpy(), pdf["copies"].to_numpy(), pdf["key"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links, found_a, found_b = np.zeros(len(pdf), dtype=np.int64), [], []
        for at in range(0, len(left), 1024):
            q = left[at:at + 1024]
            about, width = estimate(signs[right], factor[right], turned[q], sigmas)
            a, b = np.nonzero(about + width >= threshold)
            a, b = q[a], right[b]
            once = a < b if i == j else a != b
            a, b = a[once], b[once]
            # met in an earlier rotation already?
            earlier = (cells[a, :t] == cells[b, :t]).any(axis=1) if t else np.zeros(len(a), dtype=bool)
            a, b = a[~earlier], b[~earlier]
            near = (unit[a] * unit[b]).sum(axis=1) >= threshold
            a, b = a[near], b[near]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            found_a.append(a)
            found_b.append(b)
        label = forest(len(pdf), np.concatenate(found_a or [left[:0]]), np.concatenate(found_b or [left[:0]]))
        linked = np.flatnonzero(links)
        roots = pd.array(keys[label[linked]], dtype="Int64")
        roots[label[linked] == linked] = pd.NA
        return pd.DataFrame({"key": keys[linked], "links": links[linked], "root": roots})

    return dealt.groupBy("d", "t", "cell", "i", "j").applyInPandas(compare, "key long, links long, root long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
                    cell: int = CELL, recall: float = RECALL, sigmas: float = SIGMAS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    ``n_links`` counts the other rows whose cosine is at least ``threshold``, ``component_id`` is the
    smallest vec_id reachable over links.  Vectors that are null, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths; repeated rows link like any equal vectors.  An
    empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    good = rows.where(usable(F.col("vector")))
    classes = materialise(good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                          .withColumn("key", F.monotonically_increasing_id()), "vector-class")
    found = materialise(link(classes.select("key", "vector", "copies"), classes.count(), threshold, cell, recall, sigmas), "vector-links")
    counts = found.groupBy("key").agg(F.sum("links").alias("links")).withColumnRenamed("key", "counted")
    roots = components(found.where("root is not null").select(F.col("key").alias("u"), F.col("root").alias("v")), "vector-components")
    named = (classes.join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key"))
             .join(counts, F.col("key") == F.col("counted"), "left"))
    component = named.groupBy(F.col("root").alias("of_root")).agg(F.min("rep").alias("component_id"))
    known = named.join(component, F.col("root") == F.col("of_root")).select(
        F.col("vector").alias("known"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = good.join(known, F.col("vector") == F.col("known")).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable(F.col("vector"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_vector_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))

"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``MOST`` copies.  Among all rates that take a source's target
number of words, the entropy is largest at ``MOST / (1 + exp(-tilt * size / mean size))``: document
rates tilted exponentially in their size, with one tilt per source, the optimum of a convex dual.
The dual is solved by Newton iterations: each is an aggregation by source over the table of
(source, size, documents), every step held inside a shrinking bracket.  Rates are then rounded into
whole copies, largest documents first, each size carrying its rounding error in words to the next, so
a source ends within a few words of its target.  Which documents of a size get the extra copy is
settled by a hash of the doc_id and the text, so reruns agree; rows that tie in it (repeats of one document) are split
by their place, so exactly as many take the copy as the rounding asks for.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
TOLERANCE = 1e-9
ITERATIONS = 100
#: Cells (source, size) that every task may hold, 40 bytes each and a source's name.  They grow with the sizes that occur, not the documents.
HELD_CELLS = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: words to take from each.

    Sources in code-point order, null last, weigh ``weights``, repeating.  A target stops at ``most``
    times its source; the excess is shared anew by weight.  The result is the water level L at which
    the sum of min(cap, weight * L) meets the budget.  One row per source is ordered in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                       (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    capped = listed.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("fills_at", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level is that of the first source, in the order of filling, that isn't full when all before it are
    leveled = capped.withColumn("level", level).withColumn("level", F.when(F.col("level") <= F.col("fills_at"), F.col("level")))
    return (leveled.withColumn("level", F.max("level").over(everything))
            .select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target")))


def tilts(cells: DataFrame, wanted: DataFrame, most: int = MOST, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, target, source_size, mean, tilt) by safeguarded Newton iterations on the dual.

    The tilt is null where the target takes everything.
    """
    means = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = wanted.join(means, wanted["source"].eqNullSafe(means["source"])).select(
        wanted["source"], "source_size", "target", "mean")
    state = materialise(state.select(
        "*", F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        (F.col("target") >= F.col("source_size") * F.lit(most * (1 - 1e-12))).alias("full"), F.lit(None).cast("double").alias("miss")), "mix-tilt")
    for _ in range(ITERATIONS):
        c = cells.join(state, cells["source"].eqNullSafe(state["source"])).where("not full")
        x = F.col("size") / F.col("mean")
        rate = 1 / (1 + F.exp(-F.col("tilt") * x))
        sums = c.groupBy(state["source"].alias("s")).agg(
            F.sum(F.lit(float(most)) * rate * F.col("size") * F.col("n")).alias("words"),
            F.sum(F.lit(float(most)) * rate * (1 - rate) * F.col("size") * x * F.col("n")).alias("slope"))
        gap = F.col("target") - F.col("words")
        low, high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap < 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + gap / F.col("slope")
        held = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left").withColumn("miss", F.abs(gap) / F.col("target"))
        # outside the bracket, or without slope: halve the bracket (double the tilt while it is open)
        halved = F.when(high >= 1e6, F.greatest(F.lit(1.0), 2 * F.col("tilt"))).when(low <= -1e6, F.least(F.lit(-1.0), 2 * F.col("tilt"))).otherwise((low + high) / 2)
        moved = F.when(F.col("miss") <= tolerance, F.col("tilt")).when((newton > low) & (newton < high), newton).otherwise(halved)
        state = materialise(held.select(
            "source", "source_size", "target", "mean", F.when(F.col("words").isNull(), F.col("tilt")).otherwise(moved).alias("tilt"),
            F.coalesce(low, F.lit(-1e6)).alias("low"), F.coalesce(high, F.lit(1e6)).alias("high"), "full", "miss"), "mix-tilt")
        worst = state.where("not full").agg(F.max("miss")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return state.select("source", "source_size", "target", "mean", F.when(~F.col("full"), F.col("tilt")).alias("tilt"))


def allot(cells: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """``cells`` with ``rate``, whole ``copies`` of each document and ``extra``: how many get one more.

    One group per source, one row per distinct size in it; sizes, not documents, bound a group.
    """
    def rounded(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False, kind="stable").reset_index(drop=True)
        size, n = pdf["size"].to_numpy(dtype=float), pdf["n"].to_numpy(dtype=float)
        rate = np.full(len(pdf), float(most))
        if pdf["tilt"].notna().all() and pdf["mean"].iloc[0] > 0:
            rate = most / (1 + np.exp(np.clip(-pdf["tilt"].to_numpy() * size / pdf["mean"].to_numpy(), -700, 700)))
        copies = np.minimum(np.floor(rate), most - 1)
        extra, owed = np.zeros(len(pdf)), 0.0
        for i in range(len(pdf)):
            owed += n[i] * (rate[i] - copies[i]) * size[i]
            if size[i] > 0:
                extra[i] = min(n[i], max(0.0, round(owed / size[i])))
                owed -= extra[i] * size[i]
        return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "source_size": pdf["source_size"], "target": pdf["target"],
                             "rate": rate, "copies": copies.astype(np.int64), "extra": extra.astype(np.int64)})

    s = solved.withColumnRenamed("source", "s")
    joined = cells.join(s, cells["source"].eqNullSafe(s["s"])).drop("s")
    return joined.groupBy("source").applyInPandas(
        rounded, "source string, size long, source_size long, target double, rate double, copies long, extra long")


def _last_taken(rows: DataFrame, allotted: DataFrame) -> DataFrame:
    """(source, size, last, last_row): the row at which a (source, size) has given out its ``extra`` copies, in order of hash, then row.

    A histogram of the hashes' leading bits finds the bucket, and only that bucket's distinct hashes are ranked.
    Where rows tie in the last hash and only some take the copy, counts by the rows' input partition find
    the partition, and only its tied rows are ranked.  So neither a size nor a document that holds a third of all
    rows is sorted in one task.  ``last_row`` is null if all rows of the last hash take the copy.
    """
    bucketed = rows.withColumn("b", F.shiftrightunsigned("h", 52)).withColumn("ordered", _ordered(F.col("h")))
    counts = bucketed.groupBy("source", "size", "b").count()
    upto = Window.partitionBy("source", "size").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    a = allotted.where("extra > 0").select(F.col("source").alias("s"), F.col("size").alias("z"), "extra")
    of_cell = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    crossing = (counts.withColumn("upto", F.sum("count").over(upto)).join(a, of_cell)
                .where("upto >= extra and upto - count < extra")
                .select("s", "z", F.col("b").alias("at"), (F.col("extra") - F.col("upto") + F.col("count")).alias("need")))
    hashes = bucketed.join(crossing, of_cell & (F.col("b") == F.col("at"))).groupBy("s", "z", "need", "ordered").count()
    upto = Window.partitionBy("s", "z").orderBy("ordered").rowsBetween(Window.unboundedPreceding, 0)
    last = materialise(hashes.withColumn("upto", F.sum("count").over(upto)).where("upto >= need and upto - count < need")
                       .select("s", "z", F.col("ordered").alias("last"), (F.col("need") - F.col("upto") + F.col("count")).alias("need"),
                               F.col("count").alias("tied")), "mix-last")
    split = last.where("need < tied")
    if split.isEmpty():
        return last.select(F.col("s").alias("source"), F.col("z").alias("size"), "last", F.lit(None).cast("long").alias("last_row"))
    ties = bucketed.withColumn("part", F.shiftrightunsigned("row", 33)).join(split, of_cell & (F.col("ordered") == F.col("last")))
    upto = Window.partitionBy("s", "z").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    within = (ties.groupBy("s", "z", "last", "need", "part").count().withColumn("upto", F.sum("count").over(upto))
              .where("upto >= need and upto - count < need")
              .select(F.col("s").alias("cs"), F.col("z").alias("cz"), F.col("part").alias("at"), (F.col("need") - F.col("upto") + F.col("count")).alias("left")))
    rank = F.row_number().over(Window.partitionBy("s", "z").orderBy("row"))
    rows_in = (ties.join(within, F.col("s").eqNullSafe(F.col("cs")) & (F.col("z") == F.col("cz")) & (F.col("part") == F.col("at")))
               .withColumn("rank", rank).where("rank = left").select(F.col("s").alias("cs"), F.col("z").alias("cz"), F.col("row").alias("last_row")))
    return (last.join(rows_in, F.col("s").eqNullSafe(F.col("cs")) & (F.col("z") == F.col("cz")), "left")
            .select(F.col("s").alias("source"), F.col("z").alias("size"), "last", "last_row"))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: bool = False, **how) -> tuple[DataFrame, DataFrame]:
    """(rows, cells): rows hold (doc_id, source, size, h, row), and all of ``docs`` as ``kept`` if asked; cells the decision for each (source, size).

    A row takes ``copies`` whole copies and one more if it is not after (``last``, ``last_row``) in order of hash, then row.
    Rows are written once, so ``row`` names the same row in every later pass.
    """
    kept = [F.struct(*[docs[c] for c in docs.columns]).alias("kept")] if keep else []
    rows = materialise(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
                                   F.xxhash64(F.col(doc_id), F.col(text), F.lit(8)).alias("h"), F.monotonically_increasing_id().alias("row"), *kept), "mix-size")
    cells = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    allotted = materialise(allot(cells, tilts(cells, targets(sources, **how))), "mix-allotted")
    last = _last_taken(rows, allotted)
    l = last.select(F.col("source").alias("s"), F.col("size").alias("z"), "last", "last_row")
    decided = (allotted.join(l, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
               .select("source", "size", "source_size", "target", "rate", "copies", "extra", "last", "last_row"))
    return rows, materialise(decided, "mix-decided")


def _ordered(h: Column) -> Column:
    """The hash with its bits in unsigned order."""
    return h.bitwiseXOR(F.lit(-(1 << 63)))


def with_copies(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` with their cell's columns and the ``copies`` that each row takes.

    Up to ``HELD_CELLS`` cells go to every task, so that whole documents stay where they are; more are joined by a shuffle."""
    c = cells.withColumnsRenamed({"source": "s", "size": "z"})
    if cells.count() <= HELD_CELLS:
        c = F.broadcast(c)
    h = _ordered(F.col("h"))
    takes = (h < F.col("last")) | ((h == F.col("last")) & (F.col("last_row").isNull() | (F.col("row") <= F.col("last_row"))))
    return (rows.join(c, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
            .withColumn("copies", F.col("copies") + F.when(takes, 1).otherwise(0)))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies, taken) for every row of ``docs``.

    Null and empty texts have size 0 and take nothing; a null source is a source of its own, last in
    order; an empty table gives no rows.
    """
    return with_copies(*plan(docs)).select(
        "doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; only its own columns."""
    taken = with_copies(*plan(docs, keep=True)).where("copies > 0")
    return taken.select("kept", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("kept.*")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))

"""Distinct union of many parts, kept up to date row by row.

A row of the union carries its support: in how many parts it occurs.  When parts come, change or go, only their rows
are counted, added where the part is new and taken away where it was withdrawn; a row whose support falls to nought leaves.
Rows live in buckets by their hash, so a small change reads and writes the buckets its rows fall into and leaves the rest.
Counting is one aggregation with map-side combine, so a row that a third of all parts repeat costs one record a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns beside the rows' own.
SUPPORT, BUCKET = "_support", "_bucket"


def bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with the bucket of each; equal rows, null cells included, share one."""
    names = sorted(c for c in rows.columns if c not in (SUPPORT, BUCKET))
    cells = [x for c in names for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]   # a null moves no hash by itself
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*cells), F.lit(buckets)).cast("int"))


def count_rows(added: list[DataFrame], withdrawn: list[DataFrame]) -> DataFrame:
    """Rows with the change of their support; rows that come and go alike are left out.

    Each part's rows must be distinct and all parts of one schema.
    """
    signed = [p.withColumn(SUPPORT, F.lit(n).cast("long")) for parts, n in ((added, 1), (withdrawn, -1)) for p in parts]
    both = reduce(lambda a, b: a.unionByName(b), signed)
    return _summed(both).where(F.col(SUPPORT) != 0)


def _summed(rows: DataFrame) -> DataFrame:
    own = [c for c in rows.columns if c != SUPPORT]
    return rows.groupBy(*[F.col(f"`{c}`") for c in own]).agg(F.sum(SUPPORT).alias(SUPPORT))


def supported(support: DataFrame, change: DataFrame) -> DataFrame:
    """``support`` after ``change``; rows without support are gone.  A negative support means that a part was withdrawn that had not been
    counted: the row is kept with it, so that the caller's check sees it."""
    return _summed(support.unionByName(change)).where(F.col(SUPPORT) != 0)

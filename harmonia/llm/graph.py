"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a partial aggregation and an equi-join on the node, so a hub with a third of all links
is pre-aggregated before the shuffle and its join partition can be split by adaptive execution.  The
links live in a table in the shared folder between steps; the driver sees only a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _star(links: DataFrame) -> DataFrame:
    """For each u, its smallest neighbour m (u itself included), beside every link (u, v)."""
    least = links.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return links.join(least, "u")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: orderable ids) that is not itself a root.

    ``root`` is the smallest node reachable.  Self links and repeated links are ignored; an empty
    table gives an empty result.
    """
    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), name)

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = _star(large)
        e = materialise(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), name)
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))

"""Joins whose keys may be null or one value for a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64
_TRACKED = 10_000


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """The key values that hold more than ``share`` of the rows, by a sketch of fixed size from every task (one scan of the
    key column alone); at most 1 / share of them.  Counts are estimates: a value near the limit may be missing or in excess."""
    k = int(1 / share) + 1
    row = df.select(F.col(f"`{key}`").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {k}, {max(_TRACKED, k)})").alias("top")).first()
    return [r["item"] for r in row["top"] or [] if r["item"] is not None and r["count"] > share * row["n"]]


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left",
                hot_share: float | None = None, salts: int = SALTS) -> DataFrame:
    """``left.join(right, left_key == right_key, how)`` for ``how`` inner or left, with hot keys dealt to several tasks.

    A null key matches nothing, so its rows are dealt to ``salts`` tasks as they are, in the same scan.  With ``hot_share``
    key values above that share of the left rows (``heavy_keys``) are dealt likewise, and the right rows of those
    values, and no others, are repeated for every salt.  A row's salt comes from its values and its partition, never from its place in
    it, so a task that is run again deals it the same way, and equal rows do not all go together.  The result
    equals the plain join; key columns of both sides stay.  Without nulls and hot keys nothing but one constant is added.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"{how} joins would repeat unmatched rows of the right side")
    hot = heavy_keys(left, left_key, hot_share) if hot_share else []
    lk, rk = F.col(f"`{left_key}`"), F.col(f"`{right_key}`")
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{f.name}`") for f in left.schema if f.dataType.typeName() not in ("map", "variant")]),
                   F.lit(salts)).cast("int")
    spread = lk.isNull() | lk.isin(*hot) if hot else lk.isNull()
    a = left.withColumn("_salt_left", F.when(spread, dealt).otherwise(0))
    if hot:
        every = F.when(rk.isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        b = right.withColumn("_salt_right", F.explode(every))
    else:
        b = right.withColumn("_salt_right", F.lit(0))
    on = (a[f"`{left_key}`"] == b[f"`{right_key}`"]) & (a["_salt_left"] == b["_salt_right"])
    return a.join(b, on, how).drop("_salt_left", "_salt_right")

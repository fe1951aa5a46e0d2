"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that every executor can read, so a lost executor costs a re-read
    and not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (Spark resolves names without regard to case)."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def utf8(text: Column) -> Column:
    """The text's bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def whole_numbers(df: DataFrame, *names: str) -> list[np.ndarray]:
    """The named columns of ``df`` as 64-bit arrays on the driver, row by row alike.

    Tasks pack the values, so the driver holds 8 bytes a value and no row objects.  For tables with a stated bound only.
    """
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({n: [pdf[n].to_numpy(np.int64).tobytes()] for n in names})

    rows = df.select(*[F.col(n).cast("long").alias(n) for n in names]).mapInPandas(pack, ", ".join(f"{n} binary" for n in names)).collect()
    return [np.frombuffer(b"".join(bytes(r[n]) for r in rows), dtype=np.int64) for n in names]


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` texts go to a Python worker at a time; a session that asks for fewer keeps its setting.

    Texts are long: at Spark's default of 10,000 rows a batch and its copies take some hundred MB of
    every worker.  Results do not depend on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))

"""Checksums of files of any size, read block by block.

The text source splits a file at line ends into blocks that different tasks read.  A block is summed up by how many lines it
has and, for each of four 31-bit pieces of the lines' MD5, the sum of the pieces and the sum weighted by line number.  Two
neighbouring blocks combine by adding the sums and moving the second's line numbers on by the first's count, so a file's digest
is the same however it was split, depends on the order of its lines, and needs one row a block.  Text and binary files
alike are sequences of bytes between line feeds; the length, part of the digest, tells a last line feed from none.

This detects changes; it is no defence against someone who makes two files of one digest on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PRIME = 2_147_483_647
PIECES = range(4)
_ROW = (1 << 33) - 1   # monotonically_increasing_id: the row's number in its partition in the lower 33 bits


def _mod(c: Column) -> Column:
    return F.pmod(c, F.lit(PRIME))


def content_digests(spark: SparkSession, folder: str | list[str], glob: str = "*", known: DataFrame | None = None, above: int = -1) -> DataFrame:
    """(file, length, lines, checksum) of the files below ``folder`` whose names match ``glob``, in one scan.  Files of ``above``
    bytes or fewer are left out, unread.

    Files without a byte have no line and so no row, unless ``known`` (path, length) lists them: then its every path has a row.
    A line (bytes up to a line feed) must fit a row, under 2 GB.
    """
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))   # as the manifest spells it
    lines = (spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(folder)
             .where(F.col("_metadata.file_size") > above)
             .select(path.alias("file"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("row"), F.md5(F.col("value").cast("binary")).alias("md5")))
    piece = {k: F.conv(F.substring("md5", 8 * k + 1, 8), 16, 10).cast("long") for k in PIECES}
    hashed = lines.select("file", "length", "block", "row", *[_mod(piece[k]).alias(f"h{k}") for k in PIECES])
    # a block is read by one task in order, so its lines are numbered from the row of its first
    blocks = hashed.groupBy("file", "length", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.min("row").alias("first"),
        *[_mod(F.sum(f"h{k}")).alias(f"s{k}") for k in PIECES],
        *[_mod(F.sum(_mod(_mod(F.col("row")) * F.col(f"h{k}")))).alias(f"w{k}") for k in PIECES])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = _mod(F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first"))
    moved = blocks.withColumn("shift", shift)
    files = moved.groupBy("file", "length").agg(
        F.sum("lines").alias("lines"), *[_mod(F.sum(f"s{k}")).alias(f"s{k}") for k in PIECES],
        *[_mod(F.sum(_mod(F.col(f"w{k}") + _mod(F.col("shift") * F.col(f"s{k}"))))).alias(f"w{k}") for k in PIECES])
    if known is not None:
        listed = known.select(F.col("path").alias("file"), F.col("length").alias("listed"))
        files = listed.join(files.drop("length"), "file", "left").withColumnRenamed("listed", "length").na.fill(0)
    parts = [F.col(c).cast("string") for c in ("length", "lines", *[f"s{k}" for k in PIECES], *[f"w{k}" for k in PIECES])]
    return files.select("file", "length", "lines", F.sha2(F.concat_ws(":", *parts), 256).alias("checksum"))

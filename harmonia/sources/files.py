"""Raw-file discovery and reads.

The manifest comes from Spark's ``binaryFile`` source: listing is distributed and only the
columns asked for are read (content is read only when a checksum is requested).  Content
checksums (``checksum_mode='blocks'``, see ``sources.digests``) read files of any size by many tasks.  ``'content'`` is SHA-256 of the
whole content for files up to ``WHOLE`` bytes (one is one row of one task); a larger file, whose SHA-256 is one chain that
no two tasks can share, has the checksum that ``'blocks'`` gives it.  ``'metadata'`` fingerprints (path, length, modification time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .digests import content_digests

RAW_EXTENSIONS = ("csv", "parquet", "json")
#: The largest file that one task reads for its checksum.
WHOLE = 128 << 20


def manifest(spark: SparkSession, folder: str, extensions=RAW_EXTENSIONS, checksum_mode: str | None = None) -> DataFrame:
    """(path, filename, stem, ext, length, modified[, checksum]) for every raw file."""
    glob = "*.{" + ",".join(extensions) + "}"
    if checksum_mode not in (None, "blocks", "content", "metadata"):
        raise ValueError(f"unknown checksum mode {checksum_mode!r}")
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    fname = F.element_at(F.split("path", "/"), -1)
    out = df.select("path", fname.alias("filename"),
                    F.regexp_replace(fname, r"\.[^.]+$", "").alias("stem"),
                    F.lower(F.regexp_extract(fname, r"\.([^.]+)$", 1)).alias("ext"),
                    "length", F.col("modificationTime").alias("modified"),
                    *(["content"] if checksum_mode == "content" else []),
                    *([F.sha2(F.concat_ws("|", "path", "length", F.col("modificationTime").cast("string")), 256)
                       .alias("checksum")] if checksum_mode == "metadata" else []))
    if checksum_mode == "blocks":
        digests = content_digests(spark, folder, glob, known=out.select("path", "length"))
        return out.join(digests.select(F.col("file").alias("path"), "checksum"), "path")
    if checksum_mode == "content":
        whole = out.where(F.col("length") <= WHOLE).withColumn("checksum", F.sha2("content", 256)).drop("content")
        digests = content_digests(spark, folder, glob, above=WHOLE).select(F.col("file").alias("path"), "checksum")
        return whole.unionByName(out.where(F.col("length") > WHOLE).drop("content").join(digests, "path"))
    return out


def read_raw(spark: SparkSession, path: str, ext: str, schema=None, multiline: bool = True) -> DataFrame:
    """Read one raw export; CSV and JSON as all-string unless a schema is given.

    ``multiline`` keeps quoted line breaks inside one record (correct for any export) but makes a
    CSV file unsplittable: one task reads it.  Exports known to have no embedded line breaks can
    pass ``multiline=False`` and are then split across tasks."""
    if ext == "csv":
        r = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
        return (r.schema(schema) if schema is not None else r.option("inferSchema", False)).csv(path)
    if ext == "json":
        r = spark.read.option("multiLine", True)
        return (r.schema(schema) if schema is not None else r).json(path)
    if ext == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file type: {ext}")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(name, rowcount): records, not physical lines (embedded newlines count once)."""
    parts = [df.select(F.lit(name).alias("name")) for name, df in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("name").agg(F.count(F.lit(1)).alias("rowcount"))

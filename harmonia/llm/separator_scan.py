"""Token counts from flat, unindexed token files, by a vectorised scan for separators.

A token file holds nothing but little-endian unsigned 16-bit ids; every document ends with the
end-of-document id, and documents run on across blocks.  Each file is searched block by block: numpy finds
the separators of a block at once.  A block returns its separators' places and a summary (ids, last
separator); a prefix scan over the summaries tells each block where the document that it begins inside of
started, which stitches documents over any number of blocks.

Files are written by Spark's text sink, a document a line with the separator's own bytes for a line
end, and read as whole binary files, so they can lie in any store that Spark reaches.  A file holds at most
``FILE_IDS`` ids, whatever the input's splits, and is what is dealt to tasks: the writer opens a new one
when the next document does not fit, and a document longer than a file runs on over several (``at=`` in
their folder names the place of a file's first id, ``more=1`` that the document goes on and the last line end is
none of its ids).  The scan stitches those like blocks.  Documents may open with a header of ids that
carries their key in base 2**15, whose digits never equal the separator.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import bound_batches, materialise, table
from .tokens import EOD, encoder, vocabulary

#: Ids in a block.
BLOCK = 1 << 20
#: Ids in a file, separators included.
FILE_IDS = 16 * BLOCK
#: Ids of a header: 64 bits in base 2**15.
HEADER = 5


def header(key: int) -> np.ndarray:
    """The key's 64 bits as ``HEADER`` base-2**15 digits, lowest first."""
    bits = key & (2**64 - 1)
    return np.array([bits >> 15 * i & 0x7FFF for i in range(HEADER)], dtype="<u2")


def header_keys(digits: np.ndarray) -> np.ndarray:
    """Signed keys of rows of header digits."""
    d = digits.astype(np.uint64)
    return (d << (15 * np.arange(HEADER, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).view(np.int64)


def write_token_files(docs: DataFrame, path: str, vocab: tuple[str, str] | None = None, doc_id: str = "doc_id",
                      text: str = "text", file_ids: int = FILE_IDS) -> None:
    """Flat token files of ``docs`` below ``path``, of at most ``file_ids`` ids; null texts are empty documents.

    Headers carry doc_id, an integer; a null one is not told from the smallest 64-bit integer.  A header stays in one file.
    """
    vocab = vocab or vocabulary()
    bound_batches(docs.sparkSession)
    most = 2 * max(file_ids, HEADER + 1)

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(*vocab)
        columns = ["piece", "at", "more", "ids"]
        piece = filled = 0
        for pdf in batches:
            out = []
            for key, t in zip(pdf["key"], pdf["text"]):
                ids = header(int(key)).tobytes() + enc.encode(t or "")
                if filled and filled + len(ids) + 2 > most:
                    piece, filled = piece + 1, 0
                if len(ids) + 2 <= most:
                    out.append((piece, 0, 0, ids))
                    filled += len(ids) + 2
                    continue
                for at in range(0, len(ids), most - 2):
                    yield pd.DataFrame([(piece, at // 2, int(at + most - 2 < len(ids)), ids[at:at + most - 2])], columns=columns)
                piece += 1
            if out:
                yield pd.DataFrame(out, columns=columns)

    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).cast("string")
    # ISO-8859-1 maps the separator's two bytes to characters one to one; the ids are written as they are
    separator = EOD.to_bytes(2, "little").decode("latin-1")
    (docs.select(key.alias("key"), F.col(text).alias("text")).mapInPandas(tokens, "piece long, at long, more int, ids binary")
     .select("piece", "at", "more", F.col("ids").cast("string").alias("value"))
     .write.partitionBy("piece", "at", "more").option("lineSep", separator).option("encoding", "ISO-8859-1").text(path))


def scan_blocks(spark: SparkSession, path: str, separator: int = EOD, header_ids: int = HEADER, block: int = BLOCK) -> DataFrame:
    """A row for each block of the files below ``path``: file, first (id's place in the file), n, ends, heads.

    Files that one document runs over count as one.  ``ends`` are the separators' places in the file; ``heads`` the keys of the documents that
    start in the block, when files have headers.
    """
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                ids = np.frombuffer(content, dtype="<u2")
                run = re.search(r"/at=(\d+)/more=([01])(?=/[^/]*$)", name)
                offset = int(run[1]) if run else 0
                if run:
                    name = name[:run.start()] + name[run.end():]
                    ids = ids[:len(ids) - int(run[2])]
                opening = np.zeros(1 if len(ids) and not offset else 0, dtype=np.int64)   # a document starts the file
                for at in range(0, len(ids), block):
                    part = ids[at:at + block]
                    ends = at + np.flatnonzero(part == separator)
                    starts = np.concatenate([opening, ends + 1])
                    # a document that starts right after the block belongs to the next one
                    opening, starts = starts[starts >= at + len(part)], starts[starts < at + len(part)]
                    heads = header_keys(ids[starts[:, None] + np.arange(HEADER)]) if header_ids and len(starts) else np.zeros(0, np.int64)
                    yield pd.DataFrame({"file": [name], "first": [offset + at], "n": [len(part)], "ends": [offset + ends], "heads": [heads]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(scan, "file string, first long, n long, ends array<long>, heads array<long>")


def documents_of(blocks: DataFrame, header_ids: int = HEADER) -> DataFrame:
    """(file, ordinal, start, tokens, doc_id) of every document in scanned blocks.

    ``start`` is the place of the document's first id after its header, ``tokens`` counts its ids without header and
    separator.  Ids after a file's last separator are a document without an end and are counted too.
    """
    def before(value):
        return value.over(Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))

    # the scan over summaries: separators, document starts, and the last separator, before each block
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    carried = (blocks.withColumn("seen", F.coalesce(before(F.sum(F.size("ends"))), F.lit(0)))
               .withColumn("open", F.coalesce(before(F.max(last)) + 1, F.lit(0)))
               .withColumn("final", F.row_number().over(Window.partitionBy("file").orderBy(F.desc("first"))) == 1))
    size = F.col("first") + F.col("n")
    # the last document of a file may lack its separator: its end is the file's
    unended = F.col("final") & (F.coalesce(last + 1, F.col("open")) < size)
    ended = carried.withColumn("ends", F.when(unended, F.concat("ends", F.array(size))).otherwise(F.col("ends")))
    previous = F.concat(F.array(F.col("open")), F.transform(F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), lambda e: e + 1))
    rows = ended.where(F.size("ends") > 0).select(
        "file", "seen", F.posexplode(F.arrays_zip(F.col("ends").alias("end"), previous.alias("start"))).alias("place", "d"))
    documents = rows.select("file", (F.col("seen") + F.col("place")).alias("ordinal"),
                            (F.col("d.start") + header_ids).alias("start"), (F.col("d.end") - F.col("d.start") - header_ids).alias("tokens"))
    if not header_ids:
        return documents
    # a document's header stands in the block in which it starts, its end perhaps in a later one
    begun = (carried.withColumn("heads_before", F.coalesce(before(F.sum(F.size("heads"))), F.lit(0)))
             .select(F.col("file").alias("of_file"), "heads_before", F.posexplode("heads").alias("place", "doc_id"))
             .select("of_file", (F.col("heads_before") + F.col("place")).alias("of_ordinal"), "doc_id"))
    return (documents.join(begun, (F.col("file") == F.col("of_file")) & (F.col("ordinal") == F.col("of_ordinal")))
            .select("file", "ordinal", "start", "tokens", "doc_id"))


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocab: tuple[str, str] | None = None,
                 file_ids: int = FILE_IDS, block: int = BLOCK) -> DataFrame:
    """(doc_id, ordinal, start, tokens, file) of every row of ``docs``: its ids, counted in flat files.

    Ids of any type come back as they were.  Integers travel in the files' headers, with the smallest 64-bit integer for a null
    one (and so read as null); for other types the rows get numbers in a written table, by which the ids are joined back.
    Null texts are empty documents, repeated rows count each, an empty table gives no rows; other columns are left out whatever their names.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    integral = kind.typeName() in ("byte", "short", "integer", "long")
    if not integral:
        rows = materialise(rows.withColumn("key", F.monotonically_increasing_id()), "token-count-rows")
    path = scratch_path(spark, "token-files")
    write_token_files(rows, path, vocab, "doc_id" if integral else "key", "text", file_ids)
    counted = documents_of(scan_blocks(spark, path, block=block)).withColumnRenamed("doc_id", "key")
    if integral:
        own = F.nullif(F.col("key"), F.lit(-(1 << 63)).cast("long")).cast(kind)
        return counted.select(own.alias("doc_id"), "ordinal", "start", "tokens", "file")
    return counted.join(rows.select("key", "doc_id"), "key").select("doc_id", "ordinal", "start", "tokens", "file")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """Every document's ids, counted in flat files of the whole ``documents`` table."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ordinal", "start", "tokens")

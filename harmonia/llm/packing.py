"""Packing documents into training sequences by first-fit decreasing.

A document's ids are cut into full sequences and a rest.  The rests are packed by first-fit decreasing:
longest first, each into the first open sequence with room.  The sequences' free room stands in a
tournament tree (each inner node holds the larger of its children's room), so the first fit is found
in a walk from the root.  Packing runs independently in groups of documents drawn at random, so no
group grows with the corpus and no task waits for another.

The room that first-fit decreasing leaves is then closed by cutting: the shortest sequences of a group
are taken apart and poured into the room of the others, which may cut a piece in two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, table
from .tokens import added_tokens, encoder, vocabulary

SEQUENCE = 1024
GROUP_DOCS = 1024
END = 0

PIECES = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType())])


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each item (lengths from 1 to ``capacity``, longest first; ties by position)."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    size = 1
    while size < len(lengths):
        size *= 2
    room = [capacity] * (2 * size)   # room[1] is the root, room[size + b] bin b
    bins = [0] * len(lengths)
    for i in order:
        need, at = lengths[i], 1
        while at < size:
            at *= 2
            if room[at] < need:
                at += 1
        bins[i] = at - size
        room[at] -= need
        at //= 2
        while at:
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
            at //= 2
    return bins


def pack(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(item, start in the item, length, bin): first-fit decreasing, then the room closed by cuts."""
    members: dict[int, list[tuple[int, int, int]]] = {}
    for item, b in enumerate(first_fit_decreasing(lengths, capacity)):
        members.setdefault(b, []).append((item, 0, lengths[item]))
    room = {b: capacity - sum(x[2] for x in m) for b, m in members.items()}
    while room:
        emptiest = max(room, key=lambda b: (room[b], b))
        if capacity - room[emptiest] > sum(room.values()) - room[emptiest]:
            break
        del room[emptiest]
        open_bins = sorted((b for b in room if room[b]), key=lambda b: (room[b], b))
        for item, start, length in members.pop(emptiest):
            while length:
                b = open_bins[-1]
                take = min(length, room[b])
                members[b].append((item, start, take))
                room[b] -= take
                start, length = start + take, length - take
                if not room[b]:
                    open_bins.pop()
    return [(*piece, b) for b, m in members.items() for piece in m]


def pack_documents(docs: DataFrame, vocab: tuple[str, str] | None = None, doc_id: str = "doc_id", text: str = "text",
                   sequence: int = SEQUENCE, group_docs: int = GROUP_DOCS, seed: int = 1,
                   added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece (``PIECES``): where the piece of a document lies and its ids.

    A document is its byte-level BPE ids, then ``END``; strings ``added`` (the public tokenizer's own if None) inside its text are one id each.  ``ids`` holds them as little-endian unsigned
    32-bit integers; ``start`` counts the document's ids before the piece, ``offset`` the ids before it in its
    sequence.  Null and empty texts are the single id ``END``; repeated rows are packed each; an empty
    table gives no pieces.  Rows are dealt to about ``count / group_docs`` groups by a hash of their place in the
    input, so no key, source or group of copies can fill a group.
    """
    bound_batches(docs.sparkSession)
    vocab = vocab or vocabulary()
    added = added_tokens() if added is None else added
    groups = max(1, round(docs.count() / group_docs))

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(*vocab)
        end = np.array([END], dtype="<u2").tobytes()
        for texts in batches:
            yield pd.Series([enc.encode_added(t or "", added) + end for t in texts], dtype=object)

    def pack_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        documents = [np.frombuffer(b, dtype="<u2") for b in pdf["ids"]]
        whole = [len(d) // sequence for d in documents]
        rests = [i for i, d in enumerate(documents) if len(d) % sequence]
        packed = pack([len(documents[i]) % sequence for i in rests], sequence)
        placed = [(rests[item], whole[rests[item]] * sequence + start, length, b) for item, start, length, b in packed]
        bins = 1 + max((b for *_, b in placed), default=-1)
        for i, n in enumerate(whole):
            placed += [(i, k * sequence, sequence, bins + k) for k in range(n)]
            bins += n
        fill: dict[int, int] = {}
        rows = []
        for i, start, length, b in placed:
            at = fill.get(b, 0)
            fill[b] = at + length
            rows.append((i, start, length, len(documents[i]), (int(key[0]) << 32) + b, at,
                         documents[i][start:start + length].astype("<u4").tobytes()))
        out = pd.DataFrame(rows, columns=PIECES.names)
        out["doc_id"] = pdf["doc_id"].to_numpy()[out["doc_id"].to_numpy(dtype=np.int64)]
        return out

    place = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed))
    return (docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.pmod(place, F.lit(groups)).alias("pack_group"),
                        encode(F.col(text)).alias("ids"))
            .groupBy("pack_group").applyInPandas(pack_group, PIECES)   # ids pass as text: pandas has no long with nulls
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType)))


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""CSV records of many files at once, also where quoted values hold line breaks.

The text source splits files into blocks at line ends, so one export is read by many tasks.  Whether a line end closes
a record depends on the quotes before it.  Three steps settle that without reading a file in one task:

1. every block is summed up as a function: is a quoted value open at its end, if none (or one) was open at its start;
2. a prefix scan over these functions (windows over blocks, not rows) says where a value is open at a block's start;
3. every task cuts its blocks into records.  A record that runs over block ends comes in pieces, put together by a
   group whose size is that of the record.

All files go through the same jobs, whatever their number.  The scan's result is sent to the tasks as one number for each
block at which the state changes: at most 16 bytes for every ``spark.sql.files.maxPartitionBytes`` of input, and a path a file.
"""

from __future__ import annotations

import csv
import io
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

COMPLETE, END, START, MIDDLE = range(4)


def open_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted value is open at the end of ``line``, if one was (``inside``) at its beginning.

    A value is quoted if its first character is a quote; two quotes in it stand for one; what follows the closing quote
    up to the next separator is plain text, as is a quote within an unquoted value.
    """
    opening = sep + '"'
    at = 0
    if not inside:
        if line.startswith('"'):
            inside, at = True, 1
        else:
            at = line.find(opening) + len(opening)
            if at < len(opening):
                return False
    while True:
        at = line.find('"', at)
        while at >= 0 and line.startswith('"', at + 1):
            at = line.find('"', at + 2)
        if at < 0:
            return True
        at = line.find(opening, at + 1) + len(opening)
        if at < len(opening):
            return False


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, block_end, line): physical lines in order within their block."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))   # as the manifest spells it
    return (spark.read.option("lineSep", "\n").text(paths)
            .select(path.alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("block_end"),
                    F.col("value").alias("line")))


def block_functions(numbered: DataFrame, sep: str = ",") -> DataFrame:
    """(file, block, block_end, if_closed, if_open) for every block with a quote; the others change nothing."""
    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, state = None, (False, True)
        for pdf in batches:
            done = []
            for file, block, end, line in zip(pdf["file"], pdf["block"], pdf["block_end"], pdf["line"]):
                if (file, block, end) != here:
                    if here:
                        done.append((*here, *state))
                    here, state = (file, block, end), (False, True)
                first = open_after(line, state[0], sep)
                state = (first, first if state[0] == state[1] else open_after(line, state[1], sep))
            yield pd.DataFrame(done, columns=["file", "block", "block_end", "if_closed", "if_open"])
        if here:
            yield pd.DataFrame([(*here, *state)], columns=["file", "block", "block_end", "if_closed", "if_open"])
    return (numbered.where(F.col("line").contains('"'))
            .mapInPandas(sum_up, "file string, block long, block_end long, if_closed boolean, if_open boolean"))


def states(functions: DataFrame) -> DataFrame:
    """(file, block, block_end, is_open): whether a quoted value is open at each block's end, by a prefix scan.

    A function is the same for both states (it sets the state), or keeps it, or turns it over.  So the state is what
    was set last, turned over as often as blocks have done so since.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = functions.withColumn("turned", F.sum((F.col("if_closed") & ~F.col("if_open")).cast("int")).over(before) % 2 == 1)
    # XOR with the turns up to the setting block takes those out again
    sets = F.when(F.col("if_closed") == F.col("if_open"), F.col("if_closed") != F.col("turned"))
    last = F.coalesce(F.last(sets, ignorenulls=True).over(before), F.lit(False))
    return turns.select("file", "block", "block_end", (last != F.col("turned")).alias("is_open"))


def _changes(states_: DataFrame) -> dict[str, tuple[list[int], list[int], list[bool]]]:
    """By file, the blocks with another state at their end than before them: starts, ends, states."""
    earlier = F.coalesce(F.lag("is_open").over(Window.partitionBy("file").orderBy("block")), F.lit(False))
    rows = states_.withColumn("was", earlier).where(F.col("was") != F.col("is_open")).collect()   # see the module's bound
    out: dict[str, tuple[list[int], list[int], list[bool]]] = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        for one, value in zip(out.setdefault(r["file"], ([], [], [])), (r["block"], r["block_end"], r["is_open"])):
            one.append(value)
    return out


def pieces(spark: SparkSession, paths: list[str], sep: str = ",", quoted_breaks: bool = True) -> DataFrame:
    """(file, block, n, kind, record): complete records and pieces of records; n numbers those that begin in a block."""
    numbered = lines(spark, paths)
    changes = _changes(states(block_functions(numbered, sep))) if quoted_breaks else {}
    shared = spark.sparkContext.broadcast(changes)

    def open_at(file: str, block: int) -> bool:
        starts, ends, after = shared.value.get(file, ((), (), ()))
        i = bisect_right(starts, block - 1) - 1
        if i >= 0 and ends[i] > block:
            raise ValueError(f"{file}: blocks changed between the two scans; keep spark.sql.files.* as they are")
        return i >= 0 and after[i]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, inside, continued, n, buffer = None, False, False, 0, []

        def rest() -> list[tuple]:
            return [(*here, -1 if continued else n, MIDDLE if continued else START, "\n".join(buffer))] if buffer else []

        for pdf in batches:
            done = []
            for file, block, line in zip(pdf["file"], pdf["block"], pdf["line"]):
                if (file, block) != here:
                    done += rest()
                    here, n, buffer = (file, block), 0, []
                    inside = continued = open_at(file, block)
                was = inside
                if quoted_breaks and (was or '"' in line):
                    inside = open_after(line, was, sep)
                if not was and not inside:
                    done.append((file, block, n, COMPLETE, line))
                    n += 1
                    continue
                buffer.append(line)
                if not inside:
                    done.append((file, block, -1 if continued else n, END if continued else COMPLETE, "\n".join(buffer)))
                    n, continued, buffer = n + (not continued), False, []
            yield pd.DataFrame(done, columns=["file", "block", "n", "kind", "record"])
        if here:
            yield pd.DataFrame(rest(), columns=["file", "block", "n", "kind", "record"])
    return numbered.select("file", "block", "line").mapInPandas(cut, "file string, block long, n long, kind int, record string")


def join_pieces(cut: DataFrame) -> DataFrame:
    """(file, block, n, record) of the records that run over block ends."""
    upto = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.last(F.when(F.col("kind") == START, F.struct("block", "n")), ignorenulls=True).over(upto)
    parts = cut.where(F.col("kind") != COMPLETE).withColumn("begun", begun)
    joined = parts.groupBy("file", "begun").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"))
    return joined.select("file", "begun.block", "begun.n", F.array_join(F.col("parts.record"), "\n").alias("record"))


def records(spark: SparkSession, paths: list[str], sep: str = ",", quoted_breaks: bool = True) -> DataFrame:
    """(file, block, n, record): every record of every file, headers included, (block, n) rising in file order.

    Empty lines between records are no records; a record keeps its line breaks, without a carriage return at its end.  A quote that is
    never closed makes one record of the file's rest.  The records are written once to the shared folder, so that the pieces are put
    together without reading the files again.  Files without any record have no row.
    """
    path = scratch_path(spark, "records")
    pieces(spark, paths, sep, quoted_breaks).write.parquet(path)
    cut = spark.read.parquet(path)
    whole = cut.where(F.col("kind") == COMPLETE).select("file", "block", "n", "record").unionByName(join_pieces(cut))
    return whole.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.col("record") != "")


def headers(recs: DataFrame) -> DataFrame:
    """(file, header, records): the first record of every file and how many follow it, by one aggregate."""
    at = F.struct("block", "n")
    return recs.groupBy("file").agg(F.regexp_replace(F.min_by("record", at), "^﻿", "").alias("header"),
                                    F.min(at).alias("at"), (F.count(F.lit(1)) - 1).alias("records"))


def column_names(header: str, sep: str = ",") -> list[str]:
    """Names of a header record: an empty one becomes ``_c<position>``, one that occurs twice gets its position."""
    names = next(csv.reader(io.StringIO(header, newline=""), delimiter=sep), [])
    seen: dict[str, int] = {}
    for name in names:
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
    return [f"_c{i}" if not name else f"{name}{i}" if seen[name.lower()] > 1 else name for i, name in enumerate(names)]


def parsed(recs: DataFrame, names: list[str], sep: str = ",", keep: tuple[str, ...] = ()) -> DataFrame:
    """The values of records as text columns ``names``, after the columns ``keep``; absent values are null, surplus ones left out."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    row = F.from_csv("record", schema, {"escape": '"', "sep": sep, "multiLine": "true"})
    return recs.select(*keep, row.alias("_row")).select(*keep, *[F.col(f"_row.c{i}").alias(name) for i, name in enumerate(names)])


def by_layout(recs: DataFrame, sep: str = ",") -> dict[tuple[str, ...], DataFrame]:
    """The parsed rows (text columns) of the files that share a header, by its column names."""
    first = headers(recs)
    body = recs.join(first.select("file", "at", "header"), "file").where(F.struct("block", "n") > F.col("at"))
    by_names: dict[tuple[str, ...], list[str]] = {}
    for r in first.select("header").distinct().collect():   # one row for each layout of a file
        by_names.setdefault(tuple(column_names(r["header"], sep)), []).append(r["header"])
    return {names: parsed(body.where(F.col("header").isin(same)), list(names), sep) for names, same in sorted(by_names.items())}


def read_csv(spark: SparkSession, paths: list[str], sep: str = ",", quoted_breaks: bool = True) -> dict[tuple[str, ...], DataFrame]:
    """One frame of text columns for each header among the files, by its column names."""
    return by_layout(records(spark, paths, sep, quoted_breaks), sep)

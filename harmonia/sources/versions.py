"""A commit log of table parts.

Every stage writes its rows into new folders that nothing reads yet.  What counts is the log: one entry per
(stage, source) with the folder that holds its rows now, the key of what they were made from and their number.
A commit writes the whole list of entries as a new Parquet snapshot and then creates one small file, named by the next generation,
that points to it.  The file is created only if it is not there, so of two writers that started from one generation
one fails and may try again; a run that dies before that leaves folders that no entry names, and readers keep
the generation before.  Inputs are compared with the current entry of their source and with no earlier one, so an
input that goes back to an older state is processed again.

Entries are metadata: one per ingested file, cleaned file, derived table and bucket of a final table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "stage string, source string, tablename string, key string, rowcount long, path string, generation long, logged_at timestamp"


class CommitConflict(RuntimeError):
    """Another writer has committed since the entries were read."""


def _fs(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, so that any store Spark reads will do."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file on any store Spark writes to; an older one is replaced."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


@dataclass
class CommitLog:
    """The log below ``root``; ``name`` keeps several apart."""

    spark: SparkSession
    root: str
    name: str = "log"

    def _commits(self) -> list[str]:
        fs, p = _fs(self.spark, f"{self.root}/{self.name}/commits")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _snapshot(self, commit: str) -> str | None:
        """The snapshot a commit points to; None for a file whose writer died before its line was whole."""
        fs, p = _fs(self.spark, f"{self.root}/{self.name}/commits/{commit}")
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return text[:-1] if text.endswith("\n") else None

    def head(self) -> tuple[int, str | None]:
        """(generation, its snapshot): the newest whole commit; (0, None) before the first."""
        for commit in reversed(self._commits()):
            snapshot = self._snapshot(commit)
            if snapshot:
                return int(commit), snapshot
        return 0, None

    def entries(self, stage: str | None = None) -> DataFrame:
        """The entries of the newest generation, of one stage if it is named."""
        _, snapshot = self.head()
        df = self.spark.read.schema(ENTRY).parquet(f"{self.root}/{self.name}/{snapshot}") if snapshot else self.spark.createDataFrame([], ENTRY)
        return df.where(F.col("stage") == stage) if stage else df

    def commit(self, changed: DataFrame, gone: DataFrame | None = None, seen: int | None = None) -> int:
        """Put ``changed`` (stage, source, tablename, key, rowcount, path) in place of the entries of their (stage, source), drop those
        of ``gone`` (stage, source), and return the new generation.

        ``seen`` is the generation the caller's decisions rest on (the newest if omitted); raises CommitConflict if it is no
        longer the newest.  Two changed entries of one (stage, source) are a mistake and raise.
        """
        at, _ = self.head()
        if seen is not None and seen != at:
            raise CommitConflict(f"generation {seen} was read, {at} is the newest")
        taken = self._commits()
        new = max([at, *map(int, taken[-1:])]) + 1   # a number whose writer died stays unused
        keys = ["stage", "source"]
        replaced = changed.select(*keys) if gone is None else changed.select(*keys).unionByName(gone.select(*keys))
        rows = (self.entries().join(replaced.distinct(), keys, "left_anti")
                .unionByName(changed.select("stage", "source", "tablename", "key", F.col("rowcount").cast("long"), "path",
                                            F.lit(new).cast("long").alias("generation"), F.current_timestamp().alias("logged_at"))))
        if changed.groupBy(*keys).count().where("count > 1").head(1):
            raise ValueError("two changed entries of one source")
        snapshot = f"snapshots/{new:012d}-{uuid.uuid4().hex[:12]}"
        rows.select(*[c.split()[0] for c in ENTRY.split(", ")]).write.parquet(f"{self.root}/{self.name}/{snapshot}")
        fs, p = _fs(self.spark, f"{self.root}/{self.name}/commits/{new:012d}")
        try:
            stream = fs.create(p, False)
        except Exception as e:
            if fs.exists(p):
                raise CommitConflict(f"generation {new} was committed by another writer") from e
            raise
        try:
            stream.write(bytearray(f"{snapshot}\n".encode()))
        finally:
            stream.close()
        return new

    def forget(self, name_part: str, stages: tuple[str, ...] | None = None, schema_part: str | None = None) -> int:
        """Clear the keys of the entries whose table name contains ``name_part``: their rows stay until the next run makes them anew."""
        from .ledger import select_tables
        hit = select_tables(self.entries(), schema_part, name_part)
        if stages:
            hit = hit.where(F.col("stage").isin(*stages))
        return self.commit(hit.withColumn("key", F.lit(None).cast("string")))

    def unused(self, stage_folders: tuple[str, ...] = ("staged", "clean", "derived", "final")) -> list[str]:
        """Part folders (<stage>/<table>/<part>) below ``root`` that no entry names; they may go once no reader or writer is at work."""
        named = {r["p"] for r in self.entries().select(F.col("path").alias("p")).distinct().collect()}
        out = []
        for stage in stage_folders:
            fs, p = _fs(self.spark, f"{self.root}/{stage}")
            for table in fs.listStatus(p) if fs.exists(p) else []:
                for part in fs.listStatus(table.getPath()):
                    path = f"{stage}/{table.getPath().getName()}/{part.getPath().getName()}"
                    if not any(n == path or n.startswith(path + "/") for n in named):
                        out.append(path)
        return sorted(out)


def part_folder(stage: str, table: str) -> str:
    """A new folder for rows of ``table``, relative to the root."""
    return f"{stage}/{table}/{uuid.uuid4().hex}"

"""Append-only ledgers that make every stage idempotent: a file (or source table) is skipped
when its exact (name, checksum) is already logged.  Ledgers are small Parquet tables; the
checks are anti joins (AQE broadcasts the ledger side when it is measured small)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEDGER_COLUMNS = ["filename", "tablename", "rowcount", "checksum", "logged_at"]


def pending(manifest: DataFrame, ledger: DataFrame, keys=("filename", "checksum")) -> DataFrame:
    """Manifest entries whose exact key is not in the ledger."""
    return manifest.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def latest(ledger: DataFrame) -> DataFrame:
    """The newest entry of every file: a file restored to an older content counts as changed."""
    return ledger.groupBy("filename").agg(F.max_by("checksum", "logged_at").alias("checksum"))


def record(entries: DataFrame, now_col=None) -> DataFrame:
    """Ledger rows for processed entries (append these)."""
    return entries.withColumn("logged_at", now_col if now_col is not None else F.current_timestamp())


def purge(ledger: DataFrame, name_part: str, column: str = "tablename") -> DataFrame:
    """Ledger without the entries whose table name contains ``name_part`` (forces reprocessing)."""
    return ledger.filter(~F.col(column).contains(name_part))


def select_tables(tables: DataFrame, schema_part: str | None = None, name_part: str | None = None,
                  column: str = "tablename") -> DataFrame:
    out = tables
    if schema_part:
        out = out.filter(F.split_part(F.col(column), F.lit("."), F.lit(1)).contains(schema_part))
    if name_part:
        out = out.filter(F.col(column).contains(name_part))
    return out


def fingerprint(df: DataFrame, group_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Order-insensitive content fingerprint per group: row count and the sums of both halves of each
    row's MD5.  A row's text holds name, length and value of every cell, by column name, so neither
    separators inside values nor the order of columns matter and null differs from empty.  Commutative:
    it needs no sort and aggregates partially on the map side (a hot group costs one partial row per task)."""
    def cell(c):
        v = F.col(c).cast("string")
        return F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("null")), F.lit(";"))
    row = F.md5(F.concat(*[cell(c) for c in sorted(value_cols)]))
    halves = [F.sum(F.conv(F.substring(row, at, 16), 16, 10).cast("decimal(20,0)")).cast("string") for at in (1, 17)]
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("rowcount"), F.concat_ws("-", *halves).alias("checksum"))

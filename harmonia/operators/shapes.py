"""Shapes of values: how the spellings of a column are distributed, and what a parser makes of each.

The shape of a value is the value with every digit replaced by 9, every letter by a and every run of
blanks by one blank, so ``12 Mar 2021`` and ``04 Jul 1999`` share ``99 aaa 9999``.  Exports hold few shapes a column, whatever
their rows; a shape that a parser does not know is found by one aggregate and named with its count, not lost as nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions._util import as_col


def value_shape(c) -> Column:
    """The shape of a text: digits to 9, letters (of any script) to a, runs of blanks to one blank, none at the ends; null stays null."""
    x = F.regexp_replace(as_col(c), r"\p{Nd}", "9")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\p{L}", "a"), r"\s+", " "))


def date_shapes(df: DataFrame, columns: list[str], dayfirst: bool = False) -> DataFrame:
    """(column, shape, rows, parsed, unparsed, example): how many values of each shape of the text ``columns`` the tolerant
    date parser reads.  ``example`` is the smallest value it does not read, else the smallest.  Nulls and blank values count nowhere;
    an empty table gives no rows.  Columns are unpivoted in the row, and every group is aggregated before the shuffle, so a
    shape that all rows share costs one row a task."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    long = df.select(F.explode(cells).alias("_c")).select("_c.column", "_c.value").where(F.trim("value") != "")
    read = long.select("column", "value", value_shape("value").alias("shape"), D.parse_mixed(F.col("value"), dayfirst).isNotNull().alias("read"))
    counted = read.groupBy("column", "shape").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("read").alias("parsed"), F.count_if(~F.col("read")).alias("unparsed"),
        F.coalesce(F.min(F.when(~F.col("read"), F.col("value"))), F.min("value")).alias("example"))
    return counted


def unread_shapes(df: DataFrame, columns: list[str], dayfirst: bool = False) -> DataFrame:
    """The rows of ``date_shapes`` with values that would become null."""
    return date_shapes(df, columns, dayfirst).where("unparsed > 0")

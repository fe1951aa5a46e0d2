"""De-identification operators over whole DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import lookups as L
from ..functions.deid import pseudonym, redact_id


def drop_columns(df: DataFrame, columns) -> DataFrame:
    """Drop listed columns that exist; a null/empty list drops nothing."""
    return df.drop(*[c for c in (columns or []) if c in df.columns])


def drop_phi(df: DataFrame, table: str, phi: dict | None = None) -> DataFrame:
    return drop_columns(df, (phi or L.PHI_COLUMNS).get(table))


def redact_strings(df: DataFrame) -> DataFrame:
    """Redact whole-cell national ids in every string column, in a single projection."""
    return df.select(*[redact_id(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def pseudonymise(df: DataFrame, column: str, secret: dict, length: int | None = None,
                 source=None) -> DataFrame:
    src = source if source is not None else F.col(f"`{column}`")
    return df.withColumn(column, pseudonym(src, secret["salt"], secret["start_idx"],
                                           length if length is not None else secret["length"]))

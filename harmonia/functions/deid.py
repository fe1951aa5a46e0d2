"""De-identification expressions: whole-cell id redaction and salted pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lookups as L
from ._util import as_col

# Python's "$" also matches before one final newline; "\n?\z" states that explicitly.
ID_RLIKE = L.NATIONAL_ID_PATTERN[:-1] + r"\n?\z"


def redact_id(c) -> Column:
    """Replace a whole cell that is a national id by the redaction marker; keep anything else."""
    c = as_col(c)
    return F.when(c.rlike(ID_RLIKE), F.lit(L.REDACTED)).otherwise(c)


def pseudonym(c, salt: str, start_idx: int = 0, length: int = 40) -> Column:
    """Hex SHA-1 of value+salt, characters [start_idx, start_idx+length).  Null stays null."""
    return F.substring(F.sha1(F.concat(as_col(c), F.lit(salt))), start_idx + 1, length)


def file_stem(c) -> Column:
    """Last backslash-separated part of a path, cut before '.xml'."""
    return F.substring_index(F.substring_index(as_col(c), "\\", -1), ".xml", 1)

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    c = as_col(c)
    return F.when(c == "", F.lit(None)).otherwise(c)


def recode(c, mapping: dict) -> Column:
    """Replace listed values (None -> null); anything unmapped passes through unchanged."""
    c = as_col(c)
    expr = None
    for key, val in mapping.items():
        cond = c == F.lit(key)
        expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))
    return c if expr is None else expr.otherwise(c)


def contains_any(c, needles) -> Column:
    c = as_col(c)
    cond = None
    for n in needles:
        hit = c.contains(n)
        cond = hit if cond is None else (cond | hit)
    return cond if cond is not None else F.lit(False)


def strip_ws(c) -> Column:
    """Strip leading and trailing whitespace of any kind (like str.strip)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")

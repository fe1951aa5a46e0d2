"""Column-name and table-name expressions.  Names are data here: a DataFrame of header rows
(file, pos, name) is cleaned with these expressions, so thousands of raw files are handled
by one Spark job instead of a loop on the driver."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, strip_ws


def split_dataset(c) -> tuple[Column, Column]:
    """'schema.table' -> ('schema', 'table'): first and last dotted part."""
    c = as_col(c)
    return F.split_part(c, F.lit("."), F.lit(1)), F.split_part(c, F.lit("."), F.lit(-1))


def sanitize_table_name(c) -> Column:
    """lower, strip a '.csv' suffix, space and dash -> '_'."""
    return F.translate(F.regexp_replace(F.lower(as_col(c)), r"\.csv$", ""), " -", "__")


def _core(c, hash_to_no: bool) -> Column:
    x = F.lower(strip_ws(c))
    if hash_to_no:
        x = F.replace(x, F.lit("#"), F.lit("no"))
    x = F.regexp_replace(x, r"[ .]+", "_")
    x = F.regexp_replace(x, r"[^a-z0-9_]", "")
    return F.regexp_replace(x, r"_$", "")


def simple_name(c) -> Column:
    """strip, lower, runs of space/dot -> '_', drop other symbols, drop one trailing '_'."""
    return _core(as_col(c), hash_to_no=False)


def sql_name(c, shipped_right_rule: bool = False) -> Column:
    """The database pass applied to every name: as ``simple_name`` plus '#' -> 'no' and the
    reserved word ``right`` -> ``right_`` (the shipped rule maps any name containing it)."""
    x = _core(as_col(c), hash_to_no=True)
    cond = x.contains("right") if shipped_right_rule else (x == "right")
    return F.when(cond, F.lit("right_")).otherwise(x)


def name_tokens(c) -> Column:
    """camelCase and '_', '\\', '/', '.' split into cleaned tokens (array<string>)."""
    x = F.lower(F.regexp_replace(as_col(c), r"([a-z])([A-Z])", "$1_$2"))
    toks = F.filter(F.split(x, r"[_\\/.]"), lambda t: t != "")
    return F.transform(toks, lambda t: F.regexp_replace(
        F.regexp_replace(F.lower(strip_ws(t)), r"[ .]+", "_"), r"[^a-z0-9_]", ""))


def dedup_consecutive(arr_col: str) -> Column:
    """Drop a token equal to the one before it.  ``arr_col`` must name a materialised column."""
    arr = F.col(arr_col)
    return F.filter(arr, lambda t, i: (i == 0) | (F.element_at(arr, i) != t))


def abbreviate(arr, abbreviations: dict) -> Column:
    if not abbreviations:
        return as_col(arr)
    m = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv])
    return F.transform(as_col(arr), lambda t: F.coalesce(F.try_element_at(m, t), t))


def join_tokens(arr) -> Column:
    return F.array_join(F.filter(as_col(arr), lambda t: t != ""), "_")

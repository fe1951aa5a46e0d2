"""Echo report parsing as column expressions.

A report is lower-cased, '-' and '_' become spaces, and it is split into statements on
'. ', '¤' and '§'.  Each statement yields entries ``<anatomy>[_<valve type>]_<lesion>`` ->
severity, one per anatomy found, when a lesion and a severity are found too.  Later
statements overwrite earlier ones.  Everything runs inside Catalyst higher-order functions;
no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lookups as L
from ._util import as_col, contains_any

ENTRY_TYPE = "array<struct<key:string,value:string>>"
SPLIT_PATTERN = r"\. |¤|§"  # the equivalent regex (used by the SQL oracle)


def statements(report) -> Column:
    """Statements of a report.  '¤' and '§' are first rewritten to the '. ' separator (an inserted
    '. ' cannot form a new separator with its neighbours), so one literal split replaces a
    three-way regex alternation; plain replaces are cheaper than translate."""
    text = F.lower(F.coalesce(as_col(report), F.lit("none")))
    for ch, rep in (("-", " "), ("_", " "), ("¤", ". "), ("§", ". ")):
        text = F.replace(text, F.lit(ch), F.lit(rep))
    return F.split(text, r"\. ")


def _first_label(s: Column, labels) -> Column:
    expr = None
    for label, kws in labels:
        cond = contains_any(s, kws)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def classify_statements(report, shipped: bool = False) -> Column:
    """array<struct<vt, les, sev, an>>: each statement's valve type, lesion, severity (first
    match each, null if none) and anatomies (all matches), in statement order."""
    groups = {g: labels for g, _, labels in L.valve_groups(shipped)}

    def one(s):
        anatomies = F.array_compact(F.array(*[F.when(contains_any(s, kws), F.lit(a))
                                              for a, kws in groups["anatomy"]]))
        return F.struct(_first_label(s, groups["valve_type"]).alias("vt"), _first_label(s, groups["lesion"]).alias("les"),
                        _first_label(s, groups["severity"]).alias("sev"), anatomies.alias("an"))
    return F.transform(statements(report), one)


def entries_from_classes(classes_col: str) -> Column:
    """All entries in statement order: one per anatomy of a statement that has a lesion and a
    severity.  ``classes_col`` must name a materialised ``classify_statements`` column."""
    def per_statement(c):
        mid = F.coalesce(F.concat(F.lit("_"), c["vt"]), F.lit(""))
        entries = F.transform(c["an"], lambda a: F.struct(F.concat(a, mid, F.lit("_"), c["les"]).alias("key"),
                                                          c["sev"].alias("value")))
        return F.when(c["les"].isNotNull() & c["sev"].isNotNull(), entries).otherwise(F.array().cast(ENTRY_TYPE))
    return F.flatten(F.transform(F.col(classes_col), per_statement))


def last_wins(entries_col: str) -> Column:
    """Keep the last entry per key.  ``entries_col`` must name a materialised column."""
    arr = F.col(entries_col)
    return F.filter(arr, lambda e, i: ~F.exists(
        F.slice(arr, i + 2, F.greatest(F.size(arr) - i - 1, F.lit(1))),
        lambda x: x["key"] == e["key"]))


def entries_text(entries) -> Column:
    """Sorted 'key=value' pairs joined with ';' ('' when there is none)."""
    return F.array_join(F.transform(F.array_sort(as_col(entries)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")

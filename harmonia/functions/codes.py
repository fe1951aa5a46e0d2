"""Diagnosis-code expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lookups as L
from ._util import as_col

NULL_CODE = "-9999"


def strip_trailing_zero_decimal(c) -> Column:
    """Drop '.0' at the end of every comma-separated token ('12.0,34.0' -> '12,34')."""
    return F.regexp_replace(as_col(c), r"\.0(,|$)", "$1")


def numeric_code(c) -> Column:
    """Code text -> integer text.

    A number (also '1e5', '123.0') becomes its integer part, exactly (decimal, not float);
    null becomes '-9999'; a comma list loses '.0' at token ends; anything else is null
    (see ``operators.quality.code_violations``).
    """
    c = as_col(c)
    plain = r"^\s*\+?(-?)0*(\d+)(?:\.\d*)?\s*$"   # any number of digits, cut and never rounded
    digits = F.regexp_replace(c, plain, "$1$2")
    d = F.coalesce(c.try_cast("decimal(38,10)"), c.try_cast("decimal(38,0)"))
    int_text = F.when(F.abs(d) < 1, F.lit("0")).otherwise(
        F.split_part(d.cast("string"), F.lit("."), F.lit(1)))
    return (F.when(c.isNull(), F.lit(NULL_CODE))
            .when(c.rlike(plain), F.when(digits == "-0", "0").otherwise(digits))
            .when(d.isNotNull(), int_text)
            .when(c.contains(","), strip_trailing_zero_decimal(c)))


def combine_codes(db_source, primary, secondary) -> Column:
    """Primary and secondary codes joined with ',' (nulls skipped); edw codes lose '.0'."""
    db = as_col(db_source)
    p, s = as_col(primary).cast("string"), as_col(secondary).cast("string")
    edw = F.concat_ws(",", strip_trailing_zero_decimal(p), strip_trailing_zero_decimal(s))
    dts = F.concat_ws(",", p, s)
    return F.when(db == "edw", edw).when(db == "dts", dts).otherwise(F.lit(""))


def has_any_code(codes, code_list: list[str]) -> Column:
    """1 if any token of a comma list is in ``code_list``, else 0."""
    if not code_list:
        return F.lit(0)
    target = F.array(*[F.lit(x) for x in code_list])
    return F.coalesce(F.arrays_overlap(F.split(as_col(codes), ","), target).cast("int"), F.lit(0))


def is_death(outcome) -> Column:
    return F.coalesce(as_col(outcome).isin(*L.DEATH_OUTCOMES).cast("int"), F.lit(0))

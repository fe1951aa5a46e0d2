"""Free-text expressions: medication instructions, dose and duration splits, token lists,
medication class, ECG statements and filter summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lookups as L
from ._util import as_col, contains_any, strip_ws

CI = "(?iu)"  # case-insensitive, Unicode case folding (matches Python's re.IGNORECASE on str)

LAST_RUN_PATTERN = r"(\d+)(\D*)$"
FULL_NUMBER_PATTERN = r"([\d.,]*\d)(\D*)$"


def normalise_instruction(c) -> Column:
    """Strip surrounding whitespace and unwrap parentheses: '(mg)' -> 'mg'."""
    return F.regexp_replace(strip_ws(c), r"\((.*?)\)", "$1")


def parse_instruction(c) -> Column:
    """struct(instruction, dose, frequency, duration) from a free-text instruction.

    First case-insensitive match of each pattern; commas dropped from the dose; 'apply to
    affected area' without a dose becomes a topical dose; 'for ' dropped from the duration.
    Null in, null fields out.  On a DataFrame prefer ``with_parsed_instruction``, which
    computes the normalised text once.
    """
    return _instruction_fields(normalise_instruction(c))


def with_parsed_instruction(df, source, out: str):
    """Add struct column ``out`` = parse_instruction(source), normalising the text once."""
    tmp = f"__norm_{out}"
    df = df.withColumn(tmp, normalise_instruction(source))
    return df.withColumn(out, _instruction_fields(F.col(tmp))).drop(tmp)


def _instruction_fields(s: Column) -> Column:
    dose = F.nullif(F.replace(F.regexp_extract(s, CI + L.INSTRUCTION_DOSE, 2), F.lit(","),
                              F.lit("")), F.lit(""))
    dose = F.coalesce(dose, F.when(F.lower(s).contains(L.TOPICAL_PHRASE), F.lit(L.TOPICAL_DOSE)))
    freq = F.nullif(strip_ws(F.regexp_extract(s, CI + L.INSTRUCTION_FREQUENCY, 0)), F.lit(""))
    dur = F.nullif(strip_ws(F.replace(F.regexp_extract(s, CI + L.INSTRUCTION_DURATION, 0),
                                      F.lit("for "), F.lit(""))), F.lit(""))
    return F.struct(s.alias("instruction"), dose.alias("dose"), freq.alias("frequency"),
                    dur.alias("duration"))


def split_first_space(c) -> tuple[Column, Column]:
    """('5 days' -> '5', 'days'); no space -> (value, null)."""
    parts = F.split(as_col(c), " ", 2)
    return F.element_at(parts, 1), F.try_element_at(parts, F.lit(2))


def split_last_number(c, mode: str = "full") -> tuple[Column, Column]:
    """Split around the last number: (number, text after it).  No digit -> (null, null).

    mode 'full' keeps a whole decimal number ('2.5 mg' -> '2.5', ' mg'); mode 'last_run'
    keeps only the last digit run, as the original pipeline does ('2.5 mg' -> '5', ' mg').
    """
    c = as_col(c)
    pattern = FULL_NUMBER_PATTERN if mode == "full" else LAST_RUN_PATTERN
    has_digit = c.rlike(r"\d")
    return (F.when(has_digit, F.regexp_extract(c, pattern, 1)),
            F.when(has_digit, F.regexp_extract(c, pattern, 2)))


def unique_tokens(c, sep: str = "|") -> Column:
    """Distinct tokens of a delimited string, sorted, re-joined."""
    parts = F.split(as_col(c), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    return F.array_join(F.array_sort(F.array_distinct(parts)), sep)


def medication_class(c) -> Column:
    """Encounter / order type text -> medication class (first matching rule); else null."""
    c = as_col(c)
    expr = None
    for needles, label in L.MEDICATION_CLASS_RULES:
        cond = contains_any(c, needles)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


# --- ECG ------------------------------------------------------------------------------------

STATEMENT_LIST_SCHEMA = "array<struct<leftstatement:string,rightstatement:string>>"


def ecg_report(statement_list, right, left) -> Column:
    """'left; right' pairs from a list text plus the right and left statements, lower case,
    distinct, blanks dropped, sorted, joined with '; '.  An unparseable list adds nothing."""
    parsed = F.from_json(as_col(statement_list), STATEMENT_LIST_SCHEMA,
                         {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    valid = parsed.isNotNull() & ~F.exists(
        parsed, lambda x: x["leftstatement"].isNull() | x["rightstatement"].isNull())
    pairs = F.when(valid, F.transform(parsed, lambda x: F.concat(
        F.lower(x["leftstatement"]), F.lit("; "), F.lower(x["rightstatement"])))
    ).otherwise(F.array().cast("array<string>"))
    extra = F.array(F.lower(F.coalesce(as_col(right), F.lit(""))),
                    F.lower(F.coalesce(as_col(left), F.lit(""))))
    allst = F.filter(F.array_distinct(F.concat(pairs, extra)), lambda x: x != "")
    return F.array_join(F.array_sort(allst), "; ")


def bandwidth(hp, lp) -> Column:
    return F.concat(as_col(hp).cast("string"), F.lit("-"), as_col(lp).cast("string"), F.lit("Hz"))


def truthy(c) -> Column:
    return F.lower(F.trim(as_col(c).cast("string"))).isin("true", "1", "1.0", "yes", "y", "t")


def filter_summary(notch, artifact, hysteresis) -> Column:
    notch = as_col(notch)
    return F.concat(
        F.when(notch.isNotNull(), F.concat(notch.cast("string"), F.lit(" Hz notch"))).otherwise(F.lit("")),
        F.when(truthy(artifact), F.lit("Artifact filter")).otherwise(F.lit("")),
        F.when(truthy(hysteresis), F.lit("Hysteresis filter")).otherwise(F.lit("")),
    )

"""Data-quality rules.  Each returns the offending rows as a DataFrame; ``enforce`` raises when
a rule has any (strict mode), which is how the original pipeline's hard failures map here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType, DateType

from ..functions import dates as D
from ..functions.codes import combine_codes, numeric_code


def enforce(violations: DataFrame, rule: str) -> DataFrame:
    bad = violations.limit(5).collect()   # at most five example rows reach the driver
    if bad:
        raise ValueError(f"quality rule {rule} failed, e.g. {bad}")
    return violations


def code_violations(enc: DataFrame, key: str = "visit_id") -> DataFrame:
    """Q8 unparseable primary code; Q3 exponent or '.' left in a cleaned primary code;
    Q4 '.' left in combined codes."""
    raw = F.col("primary_diagnosis").cast("string")
    clean = numeric_code(raw)
    comb = combine_codes(F.col("db_source"), clean, F.col("secondary_diagnosis"))
    df = enc.select(F.col(key).alias("key"), raw.alias("raw"), clean.alias("clean"), comb.alias("combined"))
    q8 = df.filter(F.col("raw").isNotNull() & F.col("clean").isNull()).select(
        "key", F.lit("Q8_unparseable_code").alias("rule"), F.col("raw").alias("value"))
    q3 = df.filter(F.col("clean").contains("e") | F.col("clean").contains(".")).select(
        "key", F.lit("Q3_code_not_integer").alias("rule"), F.col("clean").alias("value"))
    q4 = df.filter(F.col("combined").contains(".")).select(
        "key", F.lit("Q4_combined_has_dot").alias("rule"), F.col("combined").alias("value"))
    return q8.unionByName(q3).unionByName(q4)


def date_violations(df: DataFrame, key: str, raw_col: str, parsed) -> DataFrame:
    """Q9: a non-empty value in a must-parse date column that does not parse."""
    return df.select(F.col(key).alias("key"), F.lit(raw_col).alias("column"), F.col(raw_col).alias("value"),
                     parsed.alias("_p")).filter(F.col("value").isNotNull() & F.col("_p").isNull()).drop("_p")


def row_parity(expected: DataFrame, actual: DataFrame, key: str = "name") -> DataFrame:
    """Q1: staged vs loaded row counts per table, with an ok flag."""
    e = expected.withColumnRenamed("rowcount", "staged_rows")
    a = actual.withColumnRenamed("rowcount", "loaded_rows")
    j = e.join(a, key, "full")
    return j.withColumn("ok", F.coalesce(F.col("staged_rows") == F.col("loaded_rows"), F.lit(False)))


def export_date(df: DataFrame, now: str) -> DataFrame:
    """A5: the latest date-like value not after ``now`` over all cells, as dd-MM-yyyy (``now``
    itself when there is none).  Strings count only with two '-' or two '/'.  One aggregate,
    no explode: a per-row greatest, then a global max with partial aggregation."""
    now_ts = F.lit(now).cast("timestamp_ntz")
    cands = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            dash = F.length(c) - F.length(F.replace(c, F.lit("-"), F.lit("")))
            slash = F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit("")))
            v = F.when((dash >= 2) | (slash >= 2), D.parse_mixed(c))
        elif isinstance(f.dataType, (TimestampNTZType, TimestampType, DateType)):
            v = c.cast("timestamp_ntz")
        else:
            continue
        cands.append(F.when(v <= now_ts, v))
    if not cands:
        return df.sparkSession.range(1).select(F.date_format(now_ts, "dd-MM-yyyy").alias("export_date"))
    row_max = F.greatest(*cands) if len(cands) > 1 else cands[0]
    return df.agg(F.date_format(F.coalesce(F.max(row_max), now_ts), "dd-MM-yyyy").alias("export_date"))

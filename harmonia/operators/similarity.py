"""Similarity join of names: every pair of a reference name and a test name at or above a threshold.

Candidates come from an inverted index of character n-grams.  A pair at the threshold shares a number of n-grams that follows
from the two lengths alone (``shared_grams``); so one of the reference's rarest grams, as many as may be missing plus one, must
occur in the test name (prefix filter).  Only pairs that meet there and share enough grams (count filter) are compared.
Both filters are safe for both measures, so no pair is lost, and each pair is compared once.

Bounds, for lengths n and m, threshold t and grams of q = 1 or 2 characters, with repeats counted:

- Levenshtein: at most d = (1 - t) max(n, m) edits, and an edit touches q grams, so max(n, m) - q + 1 - q d are shared.
- Ratcliff/Obershelp: at least M = t (n + m) / 2 characters match, in blocks that a character on one side at least sets apart,
  so in at most n + m - 2 M + 1 blocks; a block of s characters has s - q + 1 grams.

Pairs use grams of two characters where the bound asks for one of them at least, else single characters.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIMILARITY_METHODS = ("levenshtein", "ratcliff")
_ROUNDING = 1e-9


@F.pandas_udf(T.DoubleType())
def ratcliff_ratio(ref: pd.Series, test: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp similarity (the ratio of Python's SequenceMatcher); order-sensitive."""
    from difflib import SequenceMatcher
    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(ref, test)], dtype="float64")


def levenshtein_similarity(ref, test):
    longest = F.greatest(F.length(ref), F.length(test))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        1.0 - F.levenshtein(ref, test).cast("double") / longest.cast("double"))


def similarity(method: str, ref, test) -> Column:
    return levenshtein_similarity(ref, test) if method == "levenshtein" else ratcliff_ratio(ref, test)


def check_method(method: str) -> None:
    if method not in SIMILARITY_METHODS:
        raise ValueError(f"unknown similarity method {method!r}; choose from {SIMILARITY_METHODS}")


def check_threshold(threshold: float) -> None:
    """At 0 every pair qualifies, which is no similarity join."""
    if not 0 < threshold <= 1:
        raise ValueError(f"the threshold must be above 0 and at most 1, not {threshold}")


def length_band(method: str, threshold: float, n: Column) -> tuple[Column, Column]:
    """Test-name lengths that can reach ``threshold`` for a reference name of length n
    (one extra on each side guards float rounding; the similarity decides exactly)."""
    if method == "levenshtein":
        lo, hi = F.ceil(n * threshold), F.floor(n / threshold)
    else:
        lo, hi = F.ceil(n * threshold / (2 - threshold)), F.floor(n * (2 - threshold) / threshold)
    return F.greatest(lo - 1, F.lit(0)).cast("int"), (hi + 1).cast("int")


def shared_grams(method: str, threshold: float, q: int, n: Column, m: Column) -> Column:
    """The least number of q-grams that names of lengths n and m share if they reach ``threshold`` (may be 0 or less: no bound)."""
    if method == "levenshtein":
        longest = F.greatest(n, m)
        return (longest - (q - 1) - q * F.floor((1 - threshold) * longest + _ROUNDING)).cast("int")
    matched = F.ceil(threshold * (n + m) / 2 - _ROUNDING)
    return (matched - (q - 1) * (n + m - 2 * matched + 1)).cast("int")


def grams(name: str, q: int) -> Column:
    """The q-grams of column ``name`` as a set of (gram, how often it came before), so that repeats count."""
    plain = f"if(length({name}) < {q}, array(), transform(sequence(1, greatest(length({name}) - {q - 1}, 1)), i -> substring({name}, i, {q})))"
    # the array is built once, not for every gram
    return F.expr(f"transform(array({plain}), found -> transform(found, (g, i) -> "
                  "concat(g, char(1), cast(size(filter(slice(found, 1, i), h -> h = g)) AS string))))[0]")


def similar_names(names: DataFrame, columns: DataFrame, threshold: float, method: str = "levenshtein") -> DataFrame:
    """(column, name, sim): all pairs of distinct non-null ``columns.column`` and ``names.name`` whose similarity is at least
    ``threshold``.  Two empty names are equal; empty tables give no rows.  The index is keyed by gram and length, so
    no length of name is one key's work."""
    check_method(method)
    check_threshold(threshold)
    n, m = F.col("n"), F.col("m")
    two = shared_grams(method, threshold, 2, n, m) >= 1
    needed = F.when(two, shared_grams(method, threshold, 2, n, m)).otherwise(shared_grams(method, threshold, 1, n, m))
    tests = names.where(F.col("name").isNotNull()).select("name").distinct().withColumn("m", F.length("name"))
    refs = columns.where(F.col("column").isNotNull()).select("column").distinct().withColumn("n", F.length("column"))

    def with_grams(df: DataFrame, name: str) -> DataFrame:
        """A row for each gram; an empty name has one empty gram of its own, so that it meets its like."""
        of = [F.transform(grams(f"`{name}`", q), lambda g: F.struct(F.lit(q).alias("q"), g.alias("gram"))) for q in (1, 2)]
        none = F.array(F.struct(F.lit(1).alias("q"), F.lit("").alias("gram")))
        return df.select("*", F.explode(F.when(F.col(name) == "", none).otherwise(F.concat(*of))).alias("_g")).select(*df.columns, "_g.*")

    index = with_grams(tests, "name")
    frequency = index.groupBy("q", "gram").agg(F.count(F.lit(1)).alias("held_by"))
    ranked = (with_grams(refs, "column").join(frequency, ["q", "gram"], "left")
              .groupBy("column", "n", "q").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("held_by", F.lit(0)).alias("held_by"), "gram"))).alias("rarest")))
    lo, hi = length_band(method, threshold, n)
    probe = (ranked.withColumn("m", F.explode(F.sequence(lo, hi)))
             .where(F.col("q") == F.when(two, 2).otherwise(1)).withColumn("needed", F.greatest(needed, F.lit(1)))
             .where(F.size("rarest") >= F.col("needed"))
             .select("column", "q", "m", "needed", F.explode(F.expr("slice(rarest, 1, size(rarest) - needed + 1)")).alias("_r"))
             .select("column", "q", "m", "needed", F.col("_r.gram").alias("gram")))
    pairs = index.join(probe, ["q", "gram", "m"]).select("column", "name", "q", "needed").distinct()
    in_both = F.when(F.col("q") == 2, F.size(F.array_intersect(grams("`column`", 2), grams("name", 2)))).otherwise(
        F.size(F.array_intersect(grams("`column`", 1), grams("name", 1))))
    pairs = pairs.where((F.col("name") == "") | (in_both >= F.col("needed")))
    return pairs.select("column", "name", similarity(method, F.col("column"), F.col("name")).alias("sim")).where(F.col("sim") >= F.lit(threshold))

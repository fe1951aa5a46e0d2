"""The similarity join of names against brute force, for both measures."""

import random
from difflib import SequenceMatcher

import pytest

from harmonia.operators.similarity import grams, similar_names


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(names, columns, threshold, method):
    def sim(c, n):
        if method == "ratcliff":
            return SequenceMatcher(None, c, n).ratio()
        return 1.0 if not max(len(c), len(n)) else 1.0 - edits(c, n) / max(len(c), len(n))
    return {(c, n) for c in columns for n in names if sim(c, n) >= threshold}


def some_names(seed):
    r = random.Random(seed)
    columns = ["", "a", "ab", "aaaa", "aabaab", "visit_id", "visit id", "Procedure Date", "ä" * 3, "x" * 210]
    columns += ["".join(r.choice("abcd_") for _ in range(r.randint(1, 14))) for _ in range(25)]
    names = set(columns)
    for c in columns * 4:
        n = list(c)
        for _ in range(r.randint(1, 3)):
            at = r.randint(0, len(n))
            n[at:at + r.randint(0, 1)] = r.choice(["", "a", "z", "_ "])
        names.add("".join(n))
    return sorted(names), sorted(set(columns))


@pytest.mark.parametrize("method", ["levenshtein", "ratcliff"])
def test_no_pair_is_lost(spark, method):
    names, columns = some_names(7)
    hdr = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "name string")
    can = spark.createDataFrame([(c,) for c in columns] + [(None,)], "column string")
    for threshold in (0.3, 0.8, 1.0):
        got = [(r["column"], r["name"]) for r in similar_names(hdr, can, threshold, method).collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute(names, columns, threshold, method), threshold


def test_grams_count_repeats_and_bad_arguments_raise(spark):
    df = spark.createDataFrame([("aaab",), ("a",), ("",)], "s string")
    assert [len(set(r[0])) for r in df.select(grams("s", 2)).collect()] == [3, 0, 0]
    assert [len(set(r[0])) for r in df.select(grams("s", 1)).collect()] == [4, 1, 0]
    one = spark.createDataFrame([("a",)], "name string")
    for threshold, method in ((0, "ratcliff"), (1.5, "ratcliff"), (0.9, "jaro")):
        with pytest.raises(ValueError):
            similar_names(one, one.withColumnRenamed("name", "column"), threshold, method)

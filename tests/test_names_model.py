"""Header names: expected names written by hand for headers of either branch, and what must hold for any header."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from harmonia.operators.schema import clean_header_rows
from harmonia.plans.cleaners import CARDIAC_SURGERY_ABBREVIATIONS as ABBR

LONG = "Renal disease at the time of surgery (choice=Functioning transplant)"
CAMEL = "camel_case_" + hashlib.md5(b"camel_case").hexdigest()[:4]

# raw name -> (clean name, kept); names of a header are cleaned together
SHORT_HEADER = [("Study  Num.", "study_num", True), ("ID#", "id", True), ("right", "right_", True), ("Right", "right_", False),
                (" ", "col_4", True), ("camelCase", "camelcase", True), ("a/b", "ab", True), ("Mitral-valve", "mitralvalve", True),
                ("bright", "bright", True), ("study num", "study_num", False)]
LONG_HEADER = [(LONG, "renal_disease_functioning_transplant", True), ("camelCase", "camel_case", True), ("camel/case", CAMEL, True),
               ("camel.Case", CAMEL + "_2", True), ("Date/Date/of", "date_of", True), ("x\\y", "x_y", True), ("PreOp", "pre_op", True),
               ("right", "right_", True)]


def cleaned(spark, headers):
    rows = [(f"f{i}", pos, n) for i, names in enumerate(headers) for pos, n in enumerate(names)]
    out = {}
    for r in clean_header_rows(spark.createDataFrame(rows, "file string, pos int, name string"), ABBR).collect():
        out.setdefault(int(r["file"][1:]), {})[r["pos"]] = (r["clean_name"], r["keep"])
    return [[out[i][pos] for pos in range(len(names))] for i, names in enumerate(headers)]


def test_headers_by_hand(spark):
    got = cleaned(spark, [[n for n, *_ in SHORT_HEADER], [n for n, *_ in LONG_HEADER]])
    assert got[0] == [(name, keep) for _, name, keep in SHORT_HEADER]
    assert got[1] == [(name, keep) for _, name, keep in LONG_HEADER]


NAME = st.text(alphabet="abAB _.#/\\-9é", min_size=0, max_size=70)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(NAME, min_size=1, max_size=8), min_size=30, max_size=30))
def test_any_header(spark, headers):
    for names, got in zip(headers, cleaned(spark, headers)):
        assert all(name and set(name) <= set("abcdefghijklmnopqrstuvwxyz0123456789_") for name, _ in got), names
        kept = [name for name, keep in got if keep]
        assert sorted(kept) == sorted({name for name, _ in got}), names          # every name once
        firsts = {name: at for at, (name, _) in reversed(list(enumerate(got)))}
        assert all(keep == (firsts[name] == at) for at, (name, keep) in enumerate(got)), names

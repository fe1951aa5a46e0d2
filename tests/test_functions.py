"""Column functions on hand-written edge values (FIXTURES.md section 3), compared with a small
pure-Python model of the original behaviour where one exists."""

import hashlib
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from harmonia import lookups as L
from harmonia.functions import codes as C
from harmonia.functions import dates as D
from harmonia.functions import deid
from harmonia.functions import text as X


def one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_redact_whole_cell_ids(spark):
    vals = ["S1234567D", "ab1234567", "S123456D", "xS1234567D", "id S1234567D", "S1234567D\n", None]
    got = one(spark, vals, deid.redact_id)
    assert got == ["[REDACTED]", "[REDACTED]", "S123456D", "[REDACTED]", "id S1234567D", "[REDACTED]", None]
    assert one(spark, got, deid.redact_id) == got  # idempotent


def test_pseudonym_equals_hashlib(spark):
    salt, start, n = "pepper", 3, 12
    vals = ["abc", "S1234567D", "", None]
    got = one(spark, vals, lambda c: deid.pseudonym(c, salt, start, n))
    exp = [hashlib.sha1((v + salt).encode()).hexdigest()[start:start + n] if v is not None else None for v in vals]
    assert got == exp


def python_instruction(s):
    """Model of the original parser (same patterns, Python re)."""
    s = s.strip()
    s = re.sub(r"\((.*?)\)", r"\1", s)
    d = re.search(L.INSTRUCTION_DOSE, s, re.IGNORECASE)
    f = re.search(L.INSTRUCTION_FREQUENCY, s, re.IGNORECASE)
    u = re.search(L.INSTRUCTION_DURATION, s, re.IGNORECASE)
    dose = d.group(2).replace(",", "") if d else None
    if not dose and L.TOPICAL_PHRASE in s.lower():
        dose = L.TOPICAL_DOSE
    return (s, dose, f.group(0).strip() if f else None, u.group(0).replace("for ", "").strip() if u else None)


INSTRUCTIONS = ["Take 2 tablet(s) 3 times a day for 5 days", "10 units at bedtime", "1,000 mg OM",
                "2 lozenges every 4 hours", "Apply to affected area", "", "3 litres once daily",
                "Inject 5 mL every other day for up to 2 weeks", "1 applications BD", "give 20 µg prn",
                "Give 5 MG (morning) ON", "once for 1 dose", "Chew 1 tablet twice a day For 3 days"]


def test_instruction_parser_matches_python_model(spark):
    df = spark.createDataFrame([(v,) for v in INSTRUCTIONS + [None]], "x string")
    rows = df.select(X.parse_instruction(F.col("x")).alias("p")).collect()
    for v, r in zip(INSTRUCTIONS, rows):
        assert tuple(r["p"]) == python_instruction(v), v
    assert tuple(rows[-1]["p"]) == (None, None, None, None)


def test_instruction_known_quirks(spark):
    rows = one(spark, ["10 units", "2 lozenges", "3 litres", "1 applications BD"],
               lambda c: X.parse_instruction(c))
    assert [r["dose"] for r in rows] == ["10 unit", "2 l", "3 l", "1 applications"]
    assert rows[3]["frequency"] == "on"


def test_split_last_number_modes(spark):
    df = spark.createDataFrame([("2.5 mg",), ("500mg",), ("abc",), (None,), ("5",)], "x string")
    full = df.select(*X.split_last_number(F.col("x"), "full")).collect()
    last = df.select(*X.split_last_number(F.col("x"), "last_run")).collect()
    assert [tuple(r) for r in full] == [("2.5", " mg"), ("500", "mg"), (None, None), (None, None), ("5", "")]
    assert [tuple(r) for r in last] == [("5", " mg"), ("500", "mg"), (None, None), (None, None), ("5", "")]


def test_split_first_space(spark):
    df = spark.createDataFrame([("5 days",), ("1 menstrual cycle",), ("d2-d6",), (None,)], "x string")
    got = [tuple(r) for r in df.select(*X.split_first_space(F.col("x"))).collect()]
    assert got == [("5", "days"), ("1", "menstrual cycle"), ("d2-d6", None), (None, None)]


def test_medication_class_and_tokens(spark):
    got = one(spark, ["IP", "Discharge", "AE", "DS", "OP clinic", "ward", None], X.medication_class)
    assert got == ["Inpatient", "Discharge", "Emergency", "Day Surgery", "Outpatient", None, None]
    assert one(spark, ["b|a|b", "x||y"], X.unique_tokens) == ["a|b", "|x|y"]


def test_numeric_code(spark):
    vals = ["123.0", "1e5", None, "12.0,34.0", "10.05,2", "12345678901234567", "abc", " 7 ", "-5.5", "0.4"]
    got = one(spark, vals, C.numeric_code)
    assert got == ["123", "100000", "-9999", "12,34", "10.05,2", "12345678901234567", None, "7", "-5", "0"]


def test_combine_and_flags(spark):
    df = spark.createDataFrame([("edw", "12.0", "33.0,41.0"), ("dts", None, "5"), ("dts", None, None),
                                ("other", "1", "2")], "db string, p string, s string")
    got = [r[0] for r in df.select(C.combine_codes(F.col("db"), F.col("p"), F.col("s"))).collect()]
    assert got == ["12,33,41", "5", "", ""]
    df2 = spark.createDataFrame([("1,20",), ("",), ("99",)], "c string")
    assert [r[0] for r in df2.select(C.has_any_code(F.col("c"), ["20", "21"])).collect()] == [1, 0, 0]


def test_mixed_dates(spark):
    vals = ["04/03/2021 9:05", "13/02/2021", "2021-03-04 10:00:00", "20210304", "junk", None, "00/00/00",
            "2021-03-04T10:00"]
    mf = one(spark, vals, lambda c: D.parse_mixed(c))
    df_ = one(spark, vals, lambda c: D.parse_mixed(c, dayfirst=True))
    assert mf[0] == datetime(2021, 4, 3, 9, 5) and df_[0] == datetime(2021, 3, 4, 9, 5)
    assert mf[1] == df_[1] == datetime(2021, 2, 13)
    assert mf[2] == datetime(2021, 3, 4, 10) and mf[3] == datetime(2021, 3, 4)
    assert mf[4] is None and mf[5] is None and mf[6] is None
    assert mf[7] == datetime(2021, 3, 4, 10)


@pytest.mark.parametrize("text, month_first, day_first", [
    ("4/3/2021", datetime(2021, 4, 3), datetime(2021, 3, 4)),
    ("31/12/2020 23:59", datetime(2020, 12, 31, 23, 59), datetime(2020, 12, 31, 23, 59)),
    ("12-31-2020", datetime(2020, 12, 31), datetime(2020, 12, 31)),
    ("2021-03-04 10:11:12.123", datetime(2021, 3, 4, 10, 11, 12, 123000), ...),
    ("2021-03-04T10:11:12.123456789", datetime(2021, 3, 4, 10, 11, 12, 123456), ...),
    ("2021-03-04T10:11:12Z", datetime(2021, 3, 4, 10, 11, 12), ...),
    ("2021-03-04 10:11:12+08:00", datetime(2021, 3, 4, 10, 11, 12), ...),
    ("12-Mar-2021", datetime(2021, 3, 12), ...),
    ("12 mar 2021 7:05", datetime(2021, 3, 12, 7, 5), ...),
    ("March 12, 2021", datetime(2021, 3, 12), ...),
    ("01/02/21", datetime(2021, 1, 2), datetime(2021, 2, 1)),
    ("01/02/70", datetime(1970, 1, 2), datetime(1970, 2, 1)),
    ("3/4/2021 5:06 PM", datetime(2021, 3, 4, 17, 6), datetime(2021, 4, 3, 17, 6)),
    ("3/4/2021 12:00 am", datetime(2021, 3, 4), datetime(2021, 4, 3)),
    ("2021/03/04", datetime(2021, 3, 4), ...),
    ("20210304101112", datetime(2021, 3, 4, 10, 11, 12), ...),
    ("2021-03-04T10:11:12+08", datetime(2021, 3, 4, 10, 11, 12), ...),
    ("4 March 2021 10:11:12 GMT", datetime(2021, 3, 4, 10, 11, 12), ...),
    ("12 Mar 2021 5pm", datetime(2021, 3, 12, 17), ...),
    ("12 Mar 2021 5:30 p.m.", datetime(2021, 3, 12, 17, 30), ...),
    ("Thu, 4 Mar 2021 10:11", datetime(2021, 3, 4, 10, 11), ...),
    ("Thursday 4th March 2021", datetime(2021, 3, 4), ...),
    ("2021-Mar-04", datetime(2021, 3, 4), ...),
    ("Mar 4th, 2021, 9:05 AM", datetime(2021, 3, 4, 9, 5), ...),
    ("\t04/03/2021\t09:05", datetime(2021, 4, 3, 9, 5), datetime(2021, 3, 4, 9, 5)),
    ("12 Mar 2021 5", None, None), ("\x01|1|2|2021", None, None), ("Thu", None, None),
    ("04/03/2021 7:3:00", datetime(2021, 4, 3, 7, 3), datetime(2021, 3, 4, 7, 3)),
    (" 04/03/2021  09:05 ", datetime(2021, 4, 3, 9, 5), datetime(2021, 3, 4, 9, 5)),
    ("2020-02-30", None, None), ("1/2/2020 24:00", None, None), ("13/13/2020", None, None), ("x", None, None),
    ("", None, None), ("12 Foo 2021", None, None), ("3/4/2021 13:00 PM", None, None), ("2021-03-04 10:61", None, None),
    ("1|2|2021", None, None), ("00/00/00", None, None),
])
def test_mixed_spellings(spark, text, month_first, day_first):
    day_first = month_first if day_first is ... else day_first
    assert one(spark, [text], D.parse_mixed) == [month_first]
    assert one(spark, [text], lambda c: D.parse_mixed(c, dayfirst=True)) == [day_first]


@pytest.mark.parametrize("text, code", [
    ("12.99999999999", "12"), ("0.99999999999", "0"), ("-0.5", "0"), ("-12.9", "-12"), ("007", "7"), ("000", "0"), ("+5", "5"),
    ("1e5", "100000"), ("1e30", "1" + "0" * 30), ("1" * 45, "1" * 45), (" 12 ", "12"), (None, "-9999"), ("I21.0,5.0", "I21,5"), ("I21", None)])
def test_numeric_code_is_exact(spark, text, code):
    assert one(spark, [text], C.numeric_code) == [code]


def test_day_diff_floors_and_padding(spark):
    df = spark.createDataFrame([(datetime(2021, 1, 2, 0), datetime(2021, 1, 1, 1)),
                                (datetime(2021, 1, 1), datetime(2021, 1, 3, 5))], "s timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(D.floor_day_diff(F.col("e"), F.col("s"))).collect()] == [-1, 2]
    assert one(spark, ["9:05", "09:05:10", None], D.pad_seconds) == ["9:05:00", "09:05:10", None]


def test_ecg_report(spark):
    df = spark.createDataFrame([
        ("[{'leftstatement': 'Sinus rhythm', 'rightstatement': 'Normal'}]", "Normal ECG", ""),
        ("not a list", "B", "a"), (None, None, None)], "l string, r string, lf string")
    got = [r[0] for r in df.select(X.ecg_report(F.col("l"), F.col("r"), F.col("lf"))).collect()]
    assert got == ["normal ecg; sinus rhythm; normal", "a; b", ""]


def test_coerce_ts_keeps_typed_timestamps(spark):
    df = spark.createDataFrame([(datetime(2021, 1, 2, 3, 4, 5, 123456), "2021-01-02")], "t timestamp_ntz, s string")
    r = df.select(D.coerce_ts(df, "t").alias("t"), D.coerce_ts(df, "s").alias("s")).collect()[0]
    assert r["t"] == datetime(2021, 1, 2, 3, 4, 5, 123456) and r["s"] == datetime(2021, 1, 2)

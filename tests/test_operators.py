"""Operators on small literal inputs with hand-derived expected rows."""

from datetime import datetime

from pyspark.sql import functions as F

from harmonia import lookups as L
from harmonia.operators import derived, quality, rows, schema
from harmonia.plans import cleaners
from harmonia.sources import ledger


def test_lesion_pivot(spark):
    df = spark.createDataFrame([
        (1, datetime(2020, 1, 1), 10, "pLAD", 70.0), (1, datetime(2020, 1, 1), 10, "dLM-PLAD", 90.0),
        (1, datetime(2020, 1, 1), 10, "pLAD ", 50.0), (2, datetime(2020, 2, 1), 11, "XYZ", 99.0),
        (3, datetime(2020, 3, 1), 12, None, 10.0), (3, datetime(2020, 3, 1), 12, "RI Cx", 30.0)],
        "subject_id long, procedure_date timestamp_ntz, study_id long, lesion string, stenosis double")
    out = {r["study_id"]: r.asDict() for r in derived.lesion_pivot(df).collect()}
    assert set(out) == {10, 12}  # study 11 has no mapped lesion
    assert out[10]["LM"] == 90.0 and out[10]["Proximal LAD"] == 90.0 and out[10]["Mid LAD"] == 0.0
    assert out[12]["Ramus Intermedius"] == 30.0
    assert len(out[10]) == 3 + len(L.LESION_SEGMENTS)


def test_valve_entries(spark):
    reports = ["Severe aortic stenosis. Mild mitral regurgitation",
               "Mild to moderate aortic and mitral regurg", "Aortic stenosis",
               "Mechanical mitral valve§severe stenosis", "Mechanical mitral valve, severe stenosis",
               "Mild aortic stenosis. Severe aortic stenosis", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(reports)], "study_id int, finaldxcollated string")
    got = {r["study_id"]: r["valve_findings"] for r in
           derived.valve_map_text(df, keep=("study_id",)).collect()}
    assert got[0] == "aortic_stenosis=severe;mitral_regurgitation=mild"
    assert got[1] == "aortic_regurgitation=moderate;mitral_regurgitation=moderate"
    assert got[2] == ""  # no severity -> nothing
    assert got[3] == ""  # valve and severity in different statements
    assert got[4] == "mitral_mechanical_stenosis=severe"
    assert got[5] == "aortic_stenosis=severe"  # later statement wins
    assert got[6] == ""
    wide = derived.valve_wide(df, keep=("study_id",)).filter("study_id = 4").collect()[0]
    assert wide["mitral_mechanical_stenosis"] == "severe" and wide["aortic_stenosis"] is None


def test_encounter_diagnosis(spark):
    df = spark.createDataFrame([
        ("edw_1", "s1", None, "A", "B", "edw", "5.0", "45.0,9", "Deceased"),
        ("hosp_2", "s2", None, "A", "B", "dts", "1", None, "Home"),
        ("x_3", "s3", None, "A", "B", "legacy", "1", "2", None)],
        "visit_id string, subject_id string, visit_date timestamp_ntz, location string, sub_location string, "
        "db_source string, primary_diagnosis string, secondary_diagnosis string, visit_outcome string")
    out = {r["visit_id"]: r.asDict() for r in derived.encounter_diagnosis(df).collect()}
    assert out["edw_1"]["combined_diagnosis"] == "5,45,9"
    assert out["edw_1"]["hypertension"] == 1 and out["edw_1"]["heart_failure"] == 1 and out["edw_1"]["death"] == 1
    assert out["hosp_2"]["hypertension"] == 1 and out["hosp_2"]["afib"] == 0 and out["hosp_2"]["death"] == 0
    assert out["x_3"]["combined_diagnosis"] == "" and out["x_3"]["hypertension"] == 0


def test_encounter_diagnosis_join_path_matches(spark):
    df = spark.createDataFrame([
        ("edw_1", "s1", None, "A", "B", "edw", "5.0", "45.0,9", "Deceased"),
        ("hosp_2", "s2", None, "A", "B", "dts", "1", "20", "Home")],
        "visit_id string, subject_id string, visit_date timestamp_ntz, location string, sub_location string, "
        "db_source string, primary_diagnosis string, secondary_diagnosis string, visit_outcome string")
    lk = spark.createDataFrame(L.diagnosis_lookup_rows(), "db_source string, dx string, code string")
    a = sorted(tuple(r) for r in derived.encounter_diagnosis(df).collect())
    b = sorted(tuple(r) for r in derived.encounter_diagnosis_by_join(df, lk).collect())
    assert a == b


def test_merge_versions_types_and_distinct(spark):
    v1 = spark.createDataFrame([(1, "a", 2)], "k int, name string, n int")
    v2 = spark.createDataFrame([(1, "a", 2.0, "x"), (2, "b", 3.5, None)], "k bigint, name string, n double, extra string")
    v3 = spark.createDataFrame([(1, "2")], "k int, n string")
    out = schema.merge_versions([v1, v2, v3])
    assert out.columns == ["k", "name", "n", "extra"]
    assert dict(out.dtypes) == {"k": "bigint", "name": "string", "n": "string", "extra": "string"}
    assert out.count() == 4  # n becomes text: v1's 2 -> '2' and v2's 2.0 -> '2.0' stay distinct
    again = schema.merge_versions([v3, v2, v1])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, again.select(*out.columns).collect()), key=str)


def test_resolve_type_lattice():
    from pyspark.sql import types as T
    assert schema.resolve_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert schema.resolve_type([T.IntegerType(), T.DecimalType(10, 2)]) == T.DoubleType()
    assert schema.resolve_type([T.DateType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert schema.resolve_type([T.BooleanType(), T.IntegerType()]) == T.StringType()
    assert schema.resolve_type([T.DayTimeIntervalType()]) == T.DayTimeIntervalType()


def test_clean_header_rows(spark):
    names = ["Procedure_Date", "Study  Num.", "IDRef#", "Right Ventricle", "right", "Study Num", "###"]
    df = spark.createDataFrame([("f", i, n) for i, n in enumerate(names)], "file string, pos int, name string")
    got = {r["pos"]: (r["clean_name"], r["keep"]) for r in schema.clean_header_rows(df).collect()}
    assert got[0] == ("procedure_date", True)
    assert got[1] == ("study_num", True) and got[5] == ("study_num", False)
    assert got[2] == ("idref", True)
    assert got[3] == ("right_ventricle", True)
    assert got[4] == ("right_", True)
    assert got[6] == ("col_6", True)


def test_shorten_long_names(spark):
    long = "Renal disease at the time of surgery (choice=Functioning transplant)"
    names = [long, "otherColumn", long + " "]
    df = spark.createDataFrame([("f", i, n) for i, n in enumerate(names)], "file string, pos int, name string")
    from harmonia.plans.cleaners import CARDIAC_SURGERY_ABBREVIATIONS
    got = {r["pos"]: r for r in schema.clean_header_rows(df, CARDIAC_SURGERY_ABBREVIATIONS).collect()}
    assert got[0]["clean_name"] == "renal_disease_functioning_transplant"
    assert got[1]["clean_name"] == "other_column"
    assert got[2]["clean_name"].startswith("renal_disease_functioning_transplant_") and got[2]["keep"]
    assert not any(r["too_long"] for r in got.values())


def test_infer_tables_ties_and_unknown(spark):
    canon = spark.createDataFrame([("t1", 0, 0, "alpha"), ("t1", 0, 1, "beta"), ("t2", 1, 0, "alpha"),
                                   ("t2", 1, 1, "beta")], "table string, table_pos int, pos int, column string")
    hdr = spark.createDataFrame([("f1", 0, "alpha"), ("f1", 1, "betas"), ("f2", 0, "zzz")],
                                "file string, pos int, name string")
    order = canon.select("table", "table_pos").distinct()
    got = {r["file"]: (r["table"], r["score"]) for r in schema.infer_tables(hdr, canon, order, 0.8).collect()}
    assert got["f1"] == ("t1", 1.0)  # tie goes to the earlier schema
    assert got["f2"] == ("unknown", 0.0)


def test_ratcliff_udf_matches_difflib(spark):
    from difflib import SequenceMatcher
    pairs = [("tide", "diet"), ("abc", "abd"), ("", ""), ("o_orderkey", "O_ORDERKEY")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(schema.ratcliff_ratio("a", "b")).collect()]
    assert got == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_pad_to_schema(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, totals double")
    out = schema.pad_to_schema(df, ["a", "total", "c"], {"totals": "total"})
    assert out.columns == ["a", "total", "c"] and out.collect()[0]["c"] is None


def test_rows_and_quality(spark):
    df = spark.createDataFrame([(1, ""), (1, ""), (None, None), (2, '""""')], "a int, b string")
    assert rows.dedup(df).count() == 3
    assert rows.drop_all_null(df).count() == 3
    assert [r["b"] for r in rows.sentinel_to_null(df).collect()] == [None, None, None, None]
    enc = spark.createDataFrame([("v1", "abc", "edw", None), ("v2", "10.05,2", "dts", None), ("v3", "7", "dts", "1.5")],
                                "visit_id string, primary_diagnosis string, db_source string, secondary_diagnosis string")
    v = {(r["key"], r["rule"]) for r in quality.code_violations(enc).collect()}
    assert v == {("v1", "Q8_unparseable_code"), ("v2", "Q3_code_not_integer"), ("v2", "Q4_combined_has_dot"),
                 ("v3", "Q4_combined_has_dot")}


def test_fingerprint_keeps_cells_apart(spark):
    def of(rows, cols=("k", "v"), schema="k string, v string"):
        return ledger.fingerprint(spark.createDataFrame(rows, schema), [], list(cols)).first()["checksum"]
    base = of([("a|b", "c")])
    assert base != of([("a", "b|c")])
    assert base == of([("a|b", "c")], ("v", "k")) == of([("c", "a|b")], schema="v string, k string")
    assert of([(None, "c")]) != of([("", "c")])


def test_diagnosis_join_keeps_flags_of_repeated_and_null_visits(spark):
    enc = spark.createDataFrame(
        [("v", "99", "edw"), ("v", "1", "edw"), (None, "1", "edw"), (None, "5", None)], "visit_id string, primary_diagnosis string, db_source string").selectExpr(
        "*", "'s' AS subject_id", "'' AS secondary_diagnosis", "'d' AS visit_date", "'l' AS location", "'u' AS sub_location", "'x' AS visit_outcome")
    lookup = spark.createDataFrame([("edw", "ht", "1")], "db_source string, dx string, code string")
    got = derived.encounter_diagnosis_by_join(enc, lookup).select("visit_id", "combined_diagnosis", "ht").collect()
    assert sorted((str(r[0]), r[1].strip(","), r[2]) for r in got) == [("None", "", 0), ("None", "1", 1), ("v", "1", 1), ("v", "99", 0)]


def test_cis_cleaner_takes_typed_dates(spark):
    df = spark.sql("SELECT 'p' AS IDRef, 'S1' AS `Study Num`, TIMESTAMP_NTZ'2021-03-04 10:11:12' AS `Procedure Date`")
    got = cleaners.clean(df, cleaners.CLEANERS["cis.cag"], cleaners.Context()).first()
    assert got["procedure_date"] is not None and str(got["procedure_date"]).startswith("2021-03-04 10:11:12")


def test_fingerprint_order_insensitive(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    f1 = ledger.fingerprint(df, [], ["k", "v"]).collect()[0]
    f2 = ledger.fingerprint(df.orderBy(F.desc("k")).repartition(3), [], ["k", "v"]).collect()[0]
    assert tuple(f1) == tuple(f2)
    man = spark.createDataFrame([("a.csv", "1"), ("b.csv", "2")], "filename string, checksum string")
    led = spark.createDataFrame([("a.csv", "1"), ("b.csv", "0")], "filename string, checksum string")
    assert [r["filename"] for r in ledger.pending(man, led).collect()] == ["b.csv"]


def test_select_tables_and_purge(spark):
    led = spark.createDataFrame([("a", "cis.cag"), ("b", "ehr.patient"), ("c", "ehr.encounter")],
                                "filename string, tablename string")
    assert sorted(r["filename"] for r in ledger.select_tables(led, schema_part="ehr").collect()) == ["b", "c"]
    assert [r["filename"] for r in ledger.select_tables(led, "ehr", "pat").collect()] == ["b"]
    assert sorted(r["filename"] for r in ledger.purge(led, "cis").collect()) == ["b", "c"]


def test_cleaner_format_hook_and_names(spark):
    from harmonia.plans.cleaners import CleanerSpec, clean
    df = spark.createDataFrame([("2021-03-04", "x", "x"), ("2021-03-04", "x", "x"), ("bad", None, "y")],
                               "`Visit Date` string, `Right` string, `right ` string")
    spec = CleanerSpec("t.t", None, dt_formats={"Visit Date": "yyyy-MM-dd"})
    out = clean(df, spec)
    assert out.columns == ["visit_date", "right_"]            # later duplicate name dropped
    got = sorted((r["visit_date"] is None) for r in out.collect())
    assert out.count() == 2 and got == [False, True]          # dedup first; bad date -> null


def test_run_script_folder(spark, tmp_path):
    from harmonia.sources.catalog import run_script_folder
    (tmp_path / "b.sql").write_text("SELECT count(*) AS n FROM t")
    (tmp_path / "a.sql").write_text("CREATE OR REPLACE TEMP VIEW u AS SELECT k * 2 AS k FROM t; SELECT sum(k) AS s FROM u")
    t = spark.createDataFrame([(1,), (2,)], "k int")
    out = run_script_folder(spark, str(tmp_path), {"t": t})
    assert list(out) == ["a.sql", "b.sql"]
    assert out["a.sql"].collect()[0]["s"] == 6 and out["b.sql"].collect()[0]["n"] == 2


def test_strict_must_parse(spark):
    import pytest
    from harmonia.operators.quality import enforce
    from harmonia.plans.stages import must_parse_violations
    cis = spark.createDataFrame([("s1", "04/03/2021"), ("s2", "00/00/00"), ("s3", "31/31/2020")],
                                "`Study Num` string, `Procedure Date` string")
    v = must_parse_violations("cis.cag", cis)
    assert [r["key"] for r in v.collect()] == ["s3"]
    with pytest.raises(ValueError):
        enforce(v, "Q9")


def test_scale_conf():
    from harmonia.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10 * 2**20, 8)["spark.sql.shuffle.partitions"] == "24"


def test_unknown_similarity_method(spark):
    import pytest
    canon = spark.createDataFrame([("t", 0, 0, "a")], "table string, table_pos int, pos int, column string")
    hdr = spark.createDataFrame([("f", 0, "a")], "file string, pos int, name string")
    with pytest.raises(ValueError):
        schema.match_scores(hdr, canon, 0.9, "soundex")


def test_valve_shipped_vocabulary(spark):
    df = spark.createDataFrame([(1, "TAVI aortic valve, trivial regurgitation"), (2, "Moderate pulmonic regurgitation")],
                               "study_id int, finaldxcollated string")
    fixed = {r["study_id"]: r["valve_findings"] for r in derived.valve_map_text(df, keep=("study_id",)).collect()}
    shipped = {r["study_id"]: r["valve_findings"] for r in
               derived.valve_map_text(df, keep=("study_id",), shipped_vocabulary=True).collect()}
    assert fixed == {1: "aortic_tavr_regurgitation=trivial", 2: "pulmonary_regurgitation=moderate"}
    assert shipped == {1: "aortic_regurgitation=trivial", 2: ""}


def test_clean_rejects_names_that_stay_too_long(spark):
    import pytest
    from harmonia.plans.cleaners import CleanerSpec, clean
    long = "a" * 70
    df = spark.createDataFrame([("x",)], f"`{long}` string")
    with pytest.raises(ValueError):
        clean(df, CleanerSpec("t.t"))


def test_date_shapes_name_every_spelling_that_would_be_lost(spark):
    from harmonia.operators.shapes import date_shapes, unread_shapes
    df = spark.createDataFrame([("04/03/2021", "2021-W09-4"), ("13/12/2020", " 2021-W10-1 "), (None, ""), ("99/99/2021", "Mär 4")], "a string, `b c` string")
    got = {(r["column"], r["shape"]): (r["rows"], r["parsed"], r["unparsed"], r["example"]) for r in date_shapes(df, ["a", "b c"]).collect()}
    assert got == {("a", "99/99/9999"): (3, 2, 1, "99/99/2021"), ("b c", "9999-a99-9"): (2, 0, 2, " 2021-W10-1 "),
                   ("b c", "aaa 9"): (1, 0, 1, "Mär 4")}
    assert unread_shapes(df.select("a"), ["a"]).count() == 1
    assert date_shapes(df.limit(0), ["a"]).count() == 0
    parsed = date_shapes(df, ["a"], dayfirst=True).first()
    assert parsed["rows"] == parsed["parsed"] + parsed["unparsed"]

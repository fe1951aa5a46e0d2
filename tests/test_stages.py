"""End to end: raw exports -> canonical schema -> preprocess -> clean -> transform -> merge,
twice, to show that re-runs skip unchanged inputs and never duplicate rows."""

import os

import pytest
from pyspark.sql import functions as F

from harmonia import queries as Q
from harmonia.plans import stages as S
from harmonia.session import scratch_path

SF = "/root/testdata/sf0.001"
SECRET = {"salt": "tests only", "start_idx": 5, "length": 20}


def _write_csv(df, path):
    df.toPandas().to_csv(path, index=False)   # small fixture: one file per export


def test_stages_end_to_end(spark):
    raw = scratch_path(spark, "raw").replace("file:", "")
    root = scratch_path(spark, "lake")
    os.makedirs(raw)
    lesion = Q.cis_raw(spark, SF).withColumn("lesion", Q.pick(F.col("Contrast Volume").cast("bigint"), Q.lesion_codes())) \
        .withColumn("stenosis", (F.col("Contrast Volume") % 100).cast("int"))
    echo = Q.cis_raw(spark, SF).withColumn("finaldxcollated", Q.pick(F.col("Contrast Volume").cast("bigint"), Q.VALVE_STATEMENTS))
    exports = {
        "ehr_combined_encounter.csv": Q.encounter_input(spark, SF),
        "dts_medication.csv": Q.raw_dts_medication(spark, SF),
        "ehr_edw_medication.csv": Q.raw_edw_medication(spark, SF),
        "COROS_Lesion.csv": lesion,
        "ECHO_NUH.csv": echo,
        "ohca_nuh_deid_fixed.csv": Q.raw_ohca(spark, SF),
    }
    for name, df in exports.items():
        _write_csv(df, os.path.join(raw, name))

    known = S.build_canonical_schema(spark, raw)
    assert set(known) == {"ehr.encounter", "ehr.dts_medication", "ehr.edw_medication", "cis.caglesion", "cis.echo", "ccd.ohca"}

    first = S.preprocess(spark, raw, root, known)
    assert {w["tablename"] for w in first} == set(known)
    assert S.preprocess(spark, raw, root, known) == []          # unchanged files are skipped
    staged_echo = S.read_staged(spark, root, "cis.echo")
    assert "Case Closed Date" not in staged_echo.columns      # identifying column dropped

    with pytest.raises(ValueError, match="secret"):
        S.clean_stage(spark, root, {})
    cleaned = S.clean_stage(spark, root, SECRET)
    assert set(cleaned) == set(known)
    assert S.clean_stage(spark, root, SECRET) == []                   # nothing changed since
    meds = S.read_clean(spark, root, "ehr.medication")
    assert meds.columns[:3] == ["subject_id", "medication_start_dt", "medication_end_dt"]

    made = S.transform_stage(spark, root)
    assert set(made) == {"cis.caglesion_pivoted", "cis.echo_valvelesion", "ehr.encounter_diagnosis"}
    assert "ehr.medication" in S.merge_stage(spark, root)
    n1 = S.read_final(spark, root, "ehr.medication").count()
    assert S.transform_stage(spark, root) == [] and S.merge_stage(spark, root) == []   # nothing changed since
    assert S.read_final(spark, root, "ehr.medication").count() == n1 == meds.distinct().count()
    piv = S.read_final(spark, root, "cis.caglesion_pivoted")
    assert "Proximal LAD" in piv.columns and piv.count() > 0


def test_files_of_one_stem_stay_apart_and_restored_content_is_ingested(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    raw.mkdir()
    known = {"ehr.t": ["alpha", "beta"]}
    first, second = "alpha,beta\n1,2\n3,4\n", "alpha,beta\n5,6\n"
    (raw / "ehr_t.csv").write_text(first)
    (raw / "ehr_t.json").write_text('{"alpha": "7", "beta": "8"}')

    def staged():
        return sorted(r["alpha"] for r in S.read_staged(spark, root, "ehr.t").collect())

    assert len(S.preprocess(spark, str(raw), root, known)) == 2
    assert staged() == ["1", "3", "7"]
    (raw / "ehr_t.csv").write_text(second)
    S.preprocess(spark, str(raw), root, known)
    assert staged() == ["5", "7"]
    (raw / "ehr_t.csv").write_text(first)   # back to an older content
    assert len(S.preprocess(spark, str(raw), root, known)) == 1
    assert staged() == ["1", "3", "7"]
    assert S.preprocess(spark, str(raw), root, known) == []


def test_late_encounter_reaches_sources_that_were_cleaned_before(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    raw.mkdir()
    known = {"ehr.encounter": ["visit_id", "mrn_sha1", "encounter_type", "primary_diagnosis"],
             "ehr.edw_laboratory": ["ENC_KEY", "REQ_LOCATION", "COLLECTION_DATE_SID", "RESULT_TEST_DATE", "SHORTTEXT", "TEST_RESULTS", "UNITS"]}
    head, row = ",".join(known["ehr.edw_laboratory"]), "{},ward,20210304,2021-03-05,sodium,140,mmol/L"
    (raw / "lab.csv").write_text("\n".join([head, row.format(1), row.format(2)]) + "\n")
    encounter = "visit_id,mrn_sha1,encounter_type,primary_diagnosis\nedw_1,p1,inpatient,410\n"
    (raw / "enc.csv").write_text(encounter)
    S.preprocess(spark, str(raw), root, known)
    S.clean_stage(spark, root, SECRET)

    def subjects():
        return sorted(str(r["subject_id"]) for r in S.read_clean(spark, root, "ehr.lab").collect())

    assert subjects() == ["None", "p1"]
    (raw / "enc.csv").write_text(encounter + "edw_2,p2,inpatient,411\n")
    S.preprocess(spark, str(raw), root, known)
    assert S.clean_stage(spark, root, SECRET) == ["ehr.edw_laboratory", "ehr.encounter"]
    assert subjects() == ["p1", "p2"]
    assert S.clean_stage(spark, root, SECRET) == []
    assert set(S.clean_stage(spark, root, SECRET | {"salt": "another"})) == set(known)


def test_must_parse_times_of_ecg_and_outpatient_orders(spark):
    day, time = S.IECG_TIME
    iecg = spark.createDataFrame([("a", "2021-03-04", "10:11:12"), ("b", "04/03/2021", "10:11:12")], f"filename string, `{day}` string, `{time}` string")
    assert [r["key"] for r in S.must_parse_violations("ecg.iecg", iecg).collect()] == ["b"]
    day, time = S.MUSE_TIME
    muse = spark.createDataFrame([("a", "03-04-2021", "10:11:12"), ("b", "2021-03-04", "10:11:12")], f"Filename string, `{day}` string, `{time}` string")
    assert [r["key"] for r in S.must_parse_violations("ecg.muse", muse).collect()] == ["b"]
    orders = spark.createDataFrame([("1", "2021-03-04"), ("2", "soon"), ("3", None)], "ENC_KEY string, CREATION_DATE_KEY string")
    assert [r["key"] for r in S.must_parse_violations("ehr.edw_outpatient_medication", orders).collect()] == ["2"]


def _lake(spark, tmp_path, name="raw"):
    raw, root = tmp_path / name, str(tmp_path / "root")
    raw.mkdir()
    return raw, root


PATIENTS = {"ehr.patient": ["mrn_sha1", "gender", "race"], "ehr.problem_list": ["mrn_sha1", "problem", "noted"]}
SURGERY = "mrn_sha1,gender,race\n"


def _run(spark, raw, root, secret=SECRET):
    S.preprocess(spark, str(raw), root, PATIENTS)
    return S.clean_stage(spark, root, secret), S.merge_stage(spark, root)


def _subjects(spark, root, table):
    if table not in S.final_tables(spark, root):
        return []
    return sorted(r[0] for r in S.read_final(spark, root, table).select("gender" if table == "ehr.patient" else "problem").collect())


def test_secret_back_to_an_earlier_one_cleans_again(spark, tmp_path):
    raw, root = _lake(spark, tmp_path)
    (raw / "p.csv").write_text(SURGERY + "m1,F,x\nm2,M,y\n")
    assert _run(spark, raw, root) == (["ehr.patient"], ["ehr.patient"])
    first = sorted(map(tuple, S.read_final(spark, root, "ehr.patient").collect()))
    other = SECRET | {"salt": "another"}
    assert _run(spark, raw, root, other) == (["ehr.patient"], ["ehr.patient"])
    assert _run(spark, raw, root, SECRET) == (["ehr.patient"], ["ehr.patient"])
    assert sorted(map(tuple, S.read_final(spark, root, "ehr.patient").collect())) == first
    assert _run(spark, raw, root) == ([], [])


def test_file_that_changes_table_shrinks_or_goes_withdraws_its_rows(spark, tmp_path):
    raw, root = _lake(spark, tmp_path)
    (raw / "a.csv").write_text(SURGERY + "m1,F,x\nm2,M,y\n")
    (raw / "b.csv").write_text(SURGERY + "m2,M,y\nm3,U,z\n")
    _run(spark, raw, root)
    assert _subjects(spark, root, "ehr.patient") == ["Female", "Male", "Unknown"]
    assert {r["gender"]: r["_support"] for r in S.read_final(spark, root, "ehr.patient", with_support=True).collect()} == {"Female": 1, "Male": 2, "Unknown": 1}
    (raw / "a.csv").write_text("mrn_sha1,problem,noted\nm9,gout,2021-03-04\n")           # another table now
    _run(spark, raw, root)
    assert _subjects(spark, root, "ehr.patient") == ["Male", "Unknown"] and _subjects(spark, root, "ehr.diagnosis") == ["gout"]
    (raw / "b.csv").write_text(SURGERY + "m3,U,z\n")                                     # shrinks
    _run(spark, raw, root)
    assert _subjects(spark, root, "ehr.patient") == ["Unknown"]
    (raw / "a.csv").unlink()                                                             # goes
    _run(spark, raw, root)
    assert "ehr.diagnosis" not in S.final_tables(spark, root) and _subjects(spark, root, "ehr.patient") == ["Unknown"]
    (raw / "b.csv").write_text("nothing,like,it\n1,2,3\n")                               # no table any more
    _run(spark, raw, root)
    assert S.final_tables(spark, root) == []
    (raw / "b.csv").unlink()
    (raw / "c.csv").write_text(SURGERY + "m1,F,x\n")
    _run(spark, raw, root)
    assert _subjects(spark, root, "ehr.patient") == ["Female"]
    (raw / "c.csv").unlink()
    with pytest.raises(ValueError, match="no file"):
        S.preprocess(spark, str(raw), root, PATIENTS)
    assert _subjects(spark, root, "ehr.patient") == ["Female"]


def test_purge_and_chosen_tables(spark, tmp_path):
    raw, root = _lake(spark, tmp_path)
    (raw / "a.csv").write_text(SURGERY + "m1,F,x\n")
    (raw / "b.csv").write_text("mrn_sha1,problem,noted\nm9,gout,2021-03-04\n")
    S.preprocess(spark, str(raw), root, PATIENTS)
    assert S.clean_stage(spark, root, SECRET, name_part="patient") == ["ehr.patient"]
    assert S.clean_stage(spark, root, SECRET, schema_part="cis") == []
    assert S.clean_stage(spark, root, SECRET) == ["ehr.problem_list"]
    assert S.merge_stage(spark, root, name_part="diagnosis") == ["ehr.diagnosis"]
    assert S.merge_stage(spark, root) == ["ehr.patient"]
    S.purge(spark, root, "patient", stages=(S.CLEANED,))
    assert S.clean_stage(spark, root, SECRET) == ["ehr.patient"] and S.merge_stage(spark, root) == ["ehr.patient"]
    S.purge(spark, root, "problem")
    assert _subjects(spark, root, "ehr.diagnosis") == ["gout"]                          # rows stay until the next run
    assert [w["filename"] for w in S.preprocess(spark, str(raw), root, PATIENTS)] == ["b.csv"]
    assert S.clean_stage(spark, root, SECRET) == ["ehr.problem_list"] and S.merge_stage(spark, root) == ["ehr.diagnosis"]
    assert _subjects(spark, root, "ehr.diagnosis") == ["gout"]


def test_incremental_merge_equals_a_rebuild_on_random_edits(spark, tmp_path):
    import random

    from harmonia.sources.versions import CommitLog
    rng, root = random.Random(3), str(tmp_path / "root")
    commits, present, rebuilt = CommitLog(spark, root), {}, []
    for step in range(7):
        for source in rng.sample("abcd", 2):
            if source in present and rng.random() < 0.3:
                del present[source]
                commits.commit(spark.createDataFrame([], S.CHANGED), spark.createDataFrame([(S.CLEANED, source)], "stage string, source string"))
            else:
                rows = {(rng.randint(0, 25), rng.choice([None, "x", "y"])) for _ in range(rng.randint(0, 15))}
                present[source] = rows
                S.put_part(spark, root, S.CLEANED, "m.t", source, spark.createDataFrame(list(rows), "k long, v string"), str(step))
        parts = [r["path"] for r in commits.entries(S.CLEANED).collect()]
        entries, gone, anew = S.merge_table(spark, root, commits, "m.t", parts, buckets=4)
        rebuilt.append(anew)
        if entries or gone:
            commits.commit(S._rows(spark, entries), S._gone(spark, gone))
        want = {}
        for rows in present.values():
            for r in rows:
                want[r] = want.get(r, 0) + 1
        held = {} if "m.t" not in S.final_tables(spark, root) else \
            {(r.k, r.v): r._support for r in S.read_final(spark, root, "m.t", with_support=True).collect()}
        assert held == want
    assert not all(rebuilt[1:])
    S.put_part(spark, root, S.CLEANED, "m.t", "e", spark.createDataFrame([("1", 2.5)], "k string, w double"), "typed")   # other types: made anew
    assert S.merge_stage(spark, root) == ["m.t"]
    final = S.read_final(spark, root, "m.t")
    assert final.schema["k"].dataType.simpleString() == "string" and "w" in final.columns and final.count() == len(want) + 1


def test_two_writers_and_a_writer_that_died(spark, tmp_path):
    from harmonia.sources.versions import CommitConflict, CommitLog
    commits = CommitLog(spark, str(tmp_path / "root"))
    one = S._rows(spark, [("staged", "a", "t", "k", 1, "p")])
    assert commits.head() == (0, None) and commits.commit(one, seen=0) == 1
    with pytest.raises(CommitConflict):
        commits.commit(one, seen=0)                                       # decided on what is no longer the newest
    (tmp_path / "root" / "log" / "commits" / f"{2:012d}").write_text("snap")   # died before its line was whole
    assert commits.head()[0] == 1 and commits.entries().count() == 1
    assert commits.commit(S._rows(spark, [("staged", "b", "t", "k", 1, "q")]), seen=1) == 3
    assert sorted(r["source"] for r in commits.entries().collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="two changed"):
        commits.commit(S._rows(spark, [("staged", "c", "t", "k", 1, "q"), ("staged", "c", "t", "l", 1, "r")]))

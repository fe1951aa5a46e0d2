"""Rows whose texts are packed for a shuffle: nothing lost, the plan the same at every size."""

import os
import re

from pyspark.sql import functions as F

from harmonia import queries as Q
from harmonia.operators.rows import dedup, dedup_packed, pack_text

SF = os.environ.get("SF_SMOKE", "/root/testdata/sf0.001")
ODD = [None, "", "a", " a ", "\x1f", "\x1b", "\x1b2", "\x1b0", "\x1b1", "\x1b3", "\x1b\x1f0", "a\x1fb\x1bc", "0", "2", "\n\r\t", "\x00", "né 𝄞", "1f", "\x1f\x1f"]


def _odd(spark):
    t = spark.createDataFrame([(i, v) for i, v in enumerate(ODD)], "i int, v string")
    raw = spark.createDataFrame([(90, bytearray(b"\xff\x1f\x1b")), (91, bytearray(b"\xc3"))], "i int, b binary")
    t = t.unionByName(raw.select("i", F.col("b").cast("string").alias("v")))
    return t.crossJoin(t.select(F.col("i").alias("k"), F.col("v").alias("`w .x")))


def _bytes(df):
    names = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return sorted(map(repr, df.select(*[F.hex(F.col(n)).alias(str(i)) for i, n in enumerate(names)]).collect()))


def test_packing_gives_every_text_back(spark):
    df = _odd(spark)
    packed, unpack = pack_text(df)
    assert packed.columns == ["i", "k", "__packed"]
    got = unpack(packed.withColumn("later", F.lit("x")).repartition(3))
    assert got.columns == [*df.columns, "later"] and got.drop("later").dtypes == df.dtypes
    assert _bytes(got.drop("later")) == _bytes(df)
    assert packed.select("__packed").distinct().count() == df.drop("i", "k").distinct().count() == 21 * 21


def test_packed_dedup_equals_dedup(spark):
    df = _odd(spark).drop("i", "k")
    df = df.unionByName(df).repartition(5)
    assert _bytes(dedup_packed(df)) == _bytes(dedup(df))
    one = df.select("v")
    assert pack_text(one)[0] is one


def test_medication_rows_cross_the_network_packed_and_encounters_are_not_broadcast(spark, capsys):
    df = Q.q_med_union(spark, SF)
    df.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 3
    keys = [k for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if "subject_id" in k or "__packed" in k]
    assert len(keys) == 4 and all("__packed" in k and k.count("#") <= 5 for k in keys), keys


def test_joined_medication_keeps_columns_the_step_reads_whatever_their_case(spark):
    from harmonia.plans.cleaners import CLEANERS, Context, clean
    enc = spark.createDataFrame([("edw_1", "p1", "IP"), ("hosp_1", "p1", "IP")], "visit_id string, mrn_sha1 string, encounter_type string")
    line = ("2021-03-04", None, "PO", None)
    raw = spark.createDataFrame(
        [("1", *line, "take 2 tabs", "5 mg", "x\x1fy", "z"), ("1", *line, "take 2 tabs", "5 mg", "x\x1fy", "other"), ("2", *line, "take", None, "", "z")],
        "ENC_KEY string, STARTTIME string, ENDTIME string, ROUTECODE string, FREQUENCY1CODE string, MEDICATION string, Dosageregimen string, "
        "ORDERTEXT string, unread string")
    rows = clean(raw, CLEANERS["ehr.edw_medication"], Context(encounters=enc))
    got = [r.asDict() for r in rows.withColumn("n", F.length("medication_name")).collect()]
    assert len(got) == 1 and got[0]["subject_id"] == "p1" and got[0]["medication_name"] == "x\x1fy" and got[0]["n"] == 3
    assert got[0]["instruction"] == "take 2 tabs"

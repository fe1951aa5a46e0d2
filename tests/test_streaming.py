"""The availableNow ingest: a re-run with the same checkpoint ingests nothing new, and a new file
is ingested once, with identifying columns dropped and ids redacted."""

from pyspark.sql import functions as F

from harmonia.session import scratch_path
from harmonia.streaming.ingest import ingest_folder


def test_ingest_is_incremental_and_idempotent(spark):
    raw, out, ck = (scratch_path(spark, n) for n in ("s-raw", "s-out", "s-ck"))
    df = spark.createDataFrame([(i, f"S{i:07d}A", "note") for i in range(50)], "k int, nric string, Comments string")
    df.filter("k < 30").coalesce(1).write.parquet(raw)
    ingest_folder(spark, raw, df.schema, "cis.cag", out, ck)
    first = spark.read.parquet(out)
    assert first.count() == 30 and "Comments" not in first.columns
    assert first.filter(F.col("nric") != "[REDACTED]").count() == 0
    ingest_folder(spark, raw, df.schema, "cis.cag", out, ck)          # nothing new
    assert spark.read.parquet(out).count() == 30
    df.filter("k >= 30").coalesce(1).write.mode("append").parquet(raw)
    ingest_folder(spark, raw, df.schema, "cis.cag", out, ck)          # only the new file
    assert spark.read.parquet(out).select("k").distinct().count() == 50
    assert spark.read.parquet(out).count() == 50


def test_streams_feed_the_commit_log_and_lose_nothing(spark):
    import pytest

    from harmonia.plans import stages as S
    from harmonia.sources.versions import CommitLog
    from harmonia.streaming.ingest import ingest_stream
    root = scratch_path(spark, "s-root")
    known = {"cis.cag": ["Study Num", "nric", "Comments", "absent"], "ehr.patient": ["mrn", "dob"]}
    df = spark.createDataFrame([(f"{i}", f"S{i:07d}A", "note") for i in range(5)], "`Study Numb` string, nric string, Comments string")
    a, b = df.limit(2), df.subtract(df.limit(2))
    a.coalesce(1).write.parquet(f"{root}/raw-a")
    b.coalesce(1).write.parquet(f"{root}/raw-b")
    for name in ("a", "b", "b"):   # two checkpoints into one table; the second stream runs again
        ingest_stream(spark, f"{root}/raw-{name}", df.schema, root, known, f"{root}/check-{name}", threshold=0.7)
    rows = S.read_staged(spark, root, "cis.cag")
    assert rows.count() == 5 and "Comments" not in rows.columns and {"Study Num", "absent"} <= set(rows.columns)
    assert rows.where(F.col("nric") != "[REDACTED]").count() == 0
    entries = CommitLog(spark, root).entries(S.STAGED).collect()
    assert len(entries) == 2 and sum(e["rowcount"] for e in entries) == 5
    # a batch that is replayed after its commit writes nothing
    e = entries[0]
    assert S.add_part(spark, root, S.STAGED, "cis.cag", e["source"], rows, e["key"]) is None
    with pytest.raises(ValueError):
        ingest_stream(spark, f"{root}/raw-a", spark.createDataFrame([("x",)], "other string").schema, root, known, f"{root}/check-c")

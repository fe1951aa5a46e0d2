"""Spread joins, digests of files by blocks, and the script runner."""

import random

import pytest
from pyspark.sql import functions as F

from harmonia.operators.joins import heavy_keys, spread_join
from harmonia.sources.catalog import run_script, run_script_folder, statements
from harmonia.sources.digests import content_digests
from harmonia.sources.files import manifest


def test_hot_and_null_keys_are_spread_and_the_rows_are_those_of_the_plain_join(spark):
    left = spark.range(6000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 90).alias("v"))
    right = spark.range(40).select(F.col("id").alias("r"), F.lit("x").alias("w")).union(spark.createDataFrame([(7, "again"), (None, "n")], "r long, w string"))
    assert heavy_keys(left, "k", 0.1) == [7]
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for how in ("left", "inner"):
            plain = left.join(right, left["k"] == right["r"], how)
            got = spread_join(left, right, "k", "r", how, hot_share=0.05)
            assert got.columns == plain.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))

        def largest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / sum(sizes)
        assert largest(left.join(right, left["k"] == right["r"], "left")) > 0.3
        assert largest(spread_join(left, right, "k", "r", "left", hot_share=0.05)) < 0.2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError):
        spread_join(left, right, "k", "r", "full")
    assert spread_join(left.limit(0), right, "k", "r", "left", hot_share=0.05).count() == 0


def test_digests_do_not_depend_on_blocks_and_tell_order_and_ends(spark, tmp_path):
    r = random.Random(3)
    lines = ["".join(r.choice("ab\r\"é,") for _ in range(r.randint(0, 12))) for _ in range(400)]
    files = {"a b+c.csv": "\n".join(lines) + "\n", "same.csv": "\n".join(lines) + "\n", "open.csv": "\n".join(lines),
             "turned.csv": "\n".join([lines[1], lines[0], *lines[2:]]) + "\n", "empty.csv": "", "crlf.csv": "\r\n".join(lines) + "\r\n"}
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "bin.parquet").write_bytes(bytes(r.randrange(256) for _ in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in (64, 1000, 1 << 27):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            found.append({m["filename"]: m["checksum"] for m in manifest(spark, str(tmp_path), checksum_mode="blocks").collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1] == found[2] and set(found[0]) == {*files, "bin.parquet"} - {"empty.csv"} and None not in found[0].values()
    got = found[0]
    assert got["a b+c.csv"] == got["same.csv"] and len(set(got.values())) == 5
    assert lines[0] != lines[1]   # and a manifest lists no file without a byte
    counts = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["length"]) for r in content_digests(spark, str(tmp_path), "*.csv").collect()}
    assert counts["same.csv"] == (400, len(files["same.csv"].encode())) and "empty.csv" not in counts
    with pytest.raises(ValueError):
        manifest(spark, str(tmp_path), checksum_mode="guess")


def test_statements_know_quotes_and_comments():
    text = """-- first; not yet
SELECT 'a;b', "c;d", 'it''s; \\'e;' FROM `odd;name` /* no; */ ; ;
-- nothing; here
/* nor;
here */;
SELECT 2 - 1 / 1"""
    got = statements(text)
    assert len(got) == 2 and got[0].endswith("/* no; */") and got[1].endswith("SELECT 2 - 1 / 1")
    assert statements("") == [] and statements(" ; -- x") == []


def test_scripts_run_from_a_folder_and_leave_the_users_views(spark, tmp_path):
    (tmp_path / "2.sql").write_text("SELECT n || ';' AS n FROM kept")
    (tmp_path / "1.sql").write_text("-- ;\nCREATE OR REPLACE TEMP VIEW kept AS\nSELECT 'x;y' AS n\nFROM t;")
    spark.createDataFrame([("mine",)], "a string").createOrReplaceTempView("t")
    out = run_script_folder(spark, tmp_path.as_uri(), {"t": spark.createDataFrame([(1,)], "k int")})
    assert list(out) == ["1.sql", "2.sql"] and out["2.sql"].collect()[0]["n"] == "x;y;"
    assert spark.table("t").first()["a"] == "mine"
    assert run_script(spark, "-- nothing", {}) is None
    for view in ("t", "kept"):
        spark.catalog.dropTempView(view)

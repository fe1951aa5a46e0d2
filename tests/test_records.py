"""CSV records cut by blocks equal the records of a reader that takes each file whole."""

import csv
import io
import os
import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from harmonia.session import scratch_path
from harmonia.sources import records as R


def _folder(spark, files: dict[str, str]) -> list[str]:
    folder = scratch_path(spark, "csv-in").replace("file:", "")
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return [os.path.join(folder, name) for name in files]


def _export(rng: random.Random, rows: int, header=("id", "note", "more")) -> str:
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    w.writerow(header)
    bits = ["a", "\n", '"', ",", "", "x y", "é", '\n"\n', "\n\n"]
    for i in range(rows):
        w.writerow([i, *["".join(rng.choices(bits, k=rng.randrange(5))) for _ in header[1:]]])
    return out.getvalue()


KEY = "spark.sql.files.maxPartitionBytes"


@contextmanager
def blocks(spark, size):
    old = spark.conf.get(KEY)
    spark.conf.set(KEY, str(size))
    yield
    spark.conf.set(KEY, old)


def _read(spark, paths, size):
    with blocks(spark, size):   # the records are cut and written here
        recs = R.records(spark, paths)
    return R.by_layout(recs)


@pytest.mark.parametrize("size", [1, 16, 1 << 20])
def test_equal_to_a_whole_file_reader_for_any_block_size(spark, size):
    rng = random.Random(size)
    texts = {f"e {i}.csv": _export(rng, {1: 2, 16: 12}.get(size, 60)) for i in range(1 if size == 1 else 2)}
    got = _read(spark, _folder(spark, texts), size)
    assert list(got) == [("id", "note", "more")]
    rows = Counter(tuple(v or "" for v in r) for r in got["id", "note", "more"].collect())
    want = Counter(tuple(r) for t in texts.values() for r in list(csv.reader(io.StringIO(t, newline="")))[1:])
    assert rows == want


def test_equal_to_the_stock_reader_on_odd_rows(spark):
    text = 'k,v,w\n1,5" nail,x\n2,"a ""b""\nc",\n\n3,only\n4,"",y,surplus\n5,"shut"tail,z\n6, "not quoted",q\n'
    path = _folder(spark, {"odd.csv": text})[0]
    want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).collect()
    for size in (8, 1 << 20):
        got = _read(spark, [path], size)["k", "v", "w"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want), key=str)


def test_states_by_prefix_scan(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for file in "abc":
        state = False
        for block in range(30):
            f = rng.choice([(False, False), (True, True), (False, True), (True, False)])
            state = f[state]
            rows.append((file, block, block + 1, *f))
            want[file, block] = state
    df = spark.createDataFrame(rows, "file string, block long, block_end long, if_closed boolean, if_open boolean")
    assert {(r["file"], r["block"]): r["is_open"] for r in R.states(df).collect()} == want


def test_headers_of_many_files_in_one_aggregate(spark):
    texts = {"a.csv": "﻿x,y\n1,2\n3,4\n", "b.csv": '\n"p\nq",\n', "c.csv": "", "d.csv": "x,X\n"}
    recs = R.records(spark, _folder(spark, texts))
    got = {r["file"].rsplit("/", 1)[1]: (R.column_names(r["header"]), r["records"]) for r in R.headers(recs).collect()}
    assert got == {"a.csv": (["x", "y"], 2), "b.csv": (["p\nq", "_c1"], 0), "d.csv": (["x0", "X1"], 0)}


def test_lines_without_quoted_breaks_are_taken_as_they_are(spark):
    got = R.read_csv(spark, _folder(spark, {"a.csv": 'x\n"1\n2\n'}), quoted_breaks=False)["x",]
    assert got.agg(F.count("*")).first()[0] == 2


def test_changed_blocks_raise_rather_than_mix_records(spark):
    paths = _folder(spark, {"a.csv": "k,v\n" + "".join(f'{i},"a\nb"\n' for i in range(8))})
    with blocks(spark, 16):
        cut = R.pieces(spark, paths)
    with blocks(spark, 11), pytest.raises(Exception, match="blocks changed"):
        cut.collect()


def test_number_of_jobs_does_not_grow_with_the_number_of_files(spark):
    from harmonia.plans import stages as S
    known, jobs = {"t.one": ["id", "note"], "t.two": ["key", "when", "where"]}, []
    for n in (2, 6):
        texts = {f"a{i}.csv": f'id,note\n{i},"x\ny"\n{i},z\n' for i in range(n)} | {f"b{i}.csv": "key,when,where\n" for i in range(n)}
        raw, root = os.path.dirname(_folder(spark, texts)[0]), scratch_path(spark, "jobs-lake")
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        got = S.preprocess(spark, raw, root, known)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files-{n}")))
        assert {w["filename"]: (w["tablename"], w["rowcount"]) for w in got} == {name: ("t.one", 2) if name[0] == "a" else ("t.two", 0) for name in texts}
        assert sorted(map(tuple, S.read_staged(spark, root, "t.one").collect())) == sorted((str(i), v) for i in range(n) for v in ("x\ny", "z"))
        assert S.preprocess(spark, raw, root, known) == []
    assert jobs[0] == jobs[1], jobs

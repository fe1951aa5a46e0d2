"""Schema operators: what one task holds does not grow with the input."""

import pytest

from harmonia.operators import schema


def test_canonical_schema_reduces_headers_before_the_join(spark):
    rows = [("b", 2, 0, "x"), ("a", 1, 1, "x"), ("a", 1, 0, "y"), ("a", 3, 0, "z"), ("b", 1, 5, "z"), ("c", 0, 0, "x"), ("b", None, 7, "w"), ("b", 4, 1, "w")]
    hdr = spark.createDataFrame(rows, "stem string, file_rank int, pos int, name string")
    al = spark.createDataFrame([("a", "t"), ("b", "t"), ("a", "u")], "stem string, table string")
    out = schema.canonical_schema(hdr, al, key="stem")
    assert sorted(map(tuple, out.collect())) == [("t", 0, "w"), ("t", 1, "y"), ("t", 2, "x"), ("t", 3, "z"), ("u", 0, "y"), ("u", 1, "x"), ("u", 2, "z")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate") and "min(file_rank" in plan[plan.index("Join"):], plan


@pytest.mark.parametrize("method", ["levenshtein", "ratcliff"])
def test_tasks_of_table_inference_grow_with_the_matched_rows(spark, monkeypatch, method):
    monkeypatch.setattr(schema, "ROWS_PER_TASK", 10, raising=False)
    hdr = spark.createDataFrame([(f"f{i}", i, j, c) for i in range(40) for j, c in enumerate(["alpha", "beta"] if i % 2 else ["gamma", "Beta_"])],
                                "file string, file_rank int, pos int, name string")
    canon = spark.createDataFrame([("s.one", 0, 0, "alpha"), ("s.one", 0, 1, "beta"), ("s.two", 1, 0, "alpha")], "table string, table_pos int, pos int, column string")
    scores = schema.match_scores(hdr, canon, 0.9, method)
    got = {(r["file"], r["table"]): r["score"] for r in scores.collect()}
    assert got == {(f"f{i}", t): 1.0 for i in range(1, 40, 2) for t in ("s.one", "s.two")}
    assert scores.rdd.getNumPartitions() >= 10   # 40 rows for f1, f3, ... (alpha twice), 40 without a match, ten a task
    best = schema.infer_tables(hdr, canon, canon.select("table", "table_pos").distinct(), 0.9, method)
    assert sorted(map(tuple, best.collect())) == sorted((f"f{i}", "s.one" if i % 2 else "unknown", float(i % 2)) for i in range(40))

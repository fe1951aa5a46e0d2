"""Mixing: documents are not shuffled for the sake of a small table of decisions."""

from harmonia.llm import mixing


def test_whole_documents_stay_where_they_are(spark, monkeypatch):
    rows = [(f"d{i}", "w " * (i % 37), [None, "a", "b", "c"][i % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    old, found = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # any table of cells is larger than this
        for held in (mixing.HELD_CELLS if hasattr(mixing, "HELD_CELLS") else None, 3):
            monkeypatch.setattr(mixing, "HELD_CELLS", held, raising=False)
            df = mixing.mixed_documents(docs)
            plan = df._jdf.queryExecution().executedPlan().toString()
            found.append((sorted(map(repr, df.collect())), "BroadcastHashJoin" in plan, "SortMergeJoin" in plan))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [x[1:] for x in found] == [(True, False), (False, True)]
    assert found[0][0] == found[1][0] and len(found[0][0]) > 400

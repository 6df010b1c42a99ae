"""F5, F6, F7 of the third round: nodes of elements, on trees made here."""

import json

from pyspark.sql import functions as F

from corpusloom.operators import trees


def test_f5_a_task_holds_elements_not_documents(spark, monkeypatch):
    """Rows that go to the walk are elements, and odd nodes keep their place."""
    kids = [{"type": "word", "content": "a"}, {"type": "word", "content": 7}, {"content": "x"}, {"type": 5}, None, "s"]
    page = {"elements": [{"type": "line", "content": kids}, {"no": 1}, {"type": "table", "content": kids}]}
    docs = spark.createDataFrame([(1, json.dumps({"pages": [page, {"elements": None}, page]}))], "doc_id long, json string")
    found = trees.flatten_tree(docs.select("doc_id", F.parse_json("json").alias("doc")))
    assert "MapInArrow" in found._jdf.queryExecution().toString() and "elem_pos" in found._jdf.queryExecution().toString()
    got = sorted((tuple(r.path), r.type, r.text) for r in found.collect())
    one = [((0,), "line", None), ((0, 0), "word", "a "), ((0, 1), "word", None), ((0, 3), "5", None), ((2,), "table", None)]
    assert got == [((p, *path), kind, text) for p in (0, 2) for path, kind, text in one]

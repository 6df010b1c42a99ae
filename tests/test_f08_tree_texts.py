"""F8, F12 of the third round: texts of elements are read in one pass over their JSON, on trees made here."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import trees


def element(kind, *texts):
    return {"type": kind, "content": [{"type": "word", "content": t} for t in texts]}


def parsed(spark, *docs):
    frame = spark.createDataFrame([(i, d if d is None else json.dumps(d)) for i, d in docs], "doc_id long, json string")
    return frame.coalesce(1).select("doc_id", F.parse_json("json").alias("doc"))


PAGES = [
    {"pageNumber": 1, "elements": [element("paragraph", "lost"), element("heading", "h1"), {"no": "type"}, element("table", "x")]},
    {"pageNumber": 2, "elements": [element("list", "l"), element("heading"), element("word", "w")]},
]


@pytest.mark.parametrize("per_batch", [1, 2, 512])
def test_f8_f12_rows_keep_their_own_elements(spark, rows, monkeypatch, per_batch):
    """Documents that share a key, or have none, are texts of their own; batches may end anywhere."""
    monkeypatch.setattr(trees, "PER_BATCH", per_batch)
    docs = parsed(spark, (1, {"pages": PAGES}), (1, {"pages": PAGES}), (None, {"pages": PAGES[::-1]}), (2, {"pages": []}), (3, {}), (4, None))
    one = [(1, 1, "h1 ", "h1 \n\nl \n\n"), (1, 2, "", "\n\nw \n\n")]
    last = [(None, 1, "", "\n\nw \n\nlost \n\n"), (None, 2, "h1 ", "h1 \n\n")]
    assert rows(trees.tree_sections(docs)) == sorted([*one, *one, *last], key=repr)
    assert rows(trees.tree_page_text(docs, 2)) == sorted([(1, "\n\nw \n\n")] * 2 + [(None, "\n\nw \n\n")], key=repr)
    whole = [(1, "lost \n\nh1 \n\n\n\nw \n\n")] * 2 + [(None, "\n\nw \n\nlost \n\nh1 \n\n"), (2, ""), (3, None), (4, None)]
    assert rows(trees.tree_page_text(docs)) == sorted(whole, key=repr)
    assert trees.tree_elements(docs).where("doc_id is null").orderBy("elem_no").collect()[-1] == (None, 1, 5, "table", "")


def test_f8_f12_no_fold_is_left(spark):
    docs = parsed(spark, (1, {"pages": PAGES}))
    for found in (trees.tree_sections(docs), trees.tree_page_text(docs, 1), trees.tree_elements(docs)):
        plan = found._jdf.queryExecution().toString()
        assert "MapInArrow" in plan and "aggregate(" not in plan

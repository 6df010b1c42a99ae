"""Whole jobs from files to results."""

import json

from corpusloom.operators import rank
from corpusloom.plans import pipelines
from corpusloom.sinks import writers
from test_text_trees import TREE, line, tree


def test_text_phrases(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Graph ranks of graph words.\nMore in-\nteresting graph words.\n\nlost tail")
    (tmp_path / "b.txt").write_text("the and of\n\n")
    found = {r["doc_id"]: r["phrases"] for r in pipelines.text_phrases(spark, str(tmp_path)).collect()}
    assert set(found) == {"a"} and "lost tail" in found["a"]
    again = pipelines.text_phrases(spark, str(tmp_path), rebuild=True).first()["phrases"]
    assert "lost tail" not in again and "interesting graph words" in again


def test_section_phrases(spark, tmp_path):
    other = tree([{"type": "heading", "content": [line("The", "and")]}, {"type": "paragraph", "content": [line("of")]}])
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.json").write_text(json.dumps(TREE, indent=1))
    (tmp_path / "in/two.json").write_text(json.dumps(other))
    nested = pipelines.section_phrases(spark, str(tmp_path / "in"), k=2)
    writers.write_phrases(nested, str(tmp_path / "out"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    sections = {d["doc_id"]: d["sections"] for d in lines}
    assert [s["section_title"] for s in sections["one"]] == ["1 Intro ", "2 Next "]
    assert all(0 < len(s["text_rank"]) <= 2 for s in sections["one"])
    assert sections["two"] == [{"section_title": "The and ", "text_rank": {}}]


def test_neighbourhood_documents(spark, tmp_path):
    (tmp_path / "g.nt").write_text(
        '<http://t/a-1> <http://t/p> "x" .\n<http://t/b> <http://t/p> <http://t/a-1> .\n'
        "<http://t/b> <http://t/p> <http://t/c> .\n"
    )
    got = pipelines.neighbourhood_documents(spark, str(tmp_path / "g.nt"), "a-1", {"t": "http://t/"})
    assert sorted(r["value"] for r in got.collect()) == [
        '{"@id":"t:a-1","t:p":["x"]}', '{"@id":"t:b","t:p":["t:a-1"]}'
    ]


def test_ranks_of_a_document_sum_to_about_one(spark):
    """Phrases of one word each carry the rank of that word."""
    text = ". ".join(["alpha", "beta", "gamma", "delta", "epsilon"] * 3)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    total = rank.textrank(docs, k=None).agg({"rank_score": "sum"}).first()[0]
    assert abs(total - 1) < 1e-9

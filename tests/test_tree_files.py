"""Tree and rule files that are cut off raise instead of vanishing."""

import json

import pytest

from corpusloom.operators import trees
from corpusloom.sources import readers


def test_cut_tree_and_rule_files_raise(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"pages":[{"pageNumber":1,"elements":[{"type":')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_parsed_docs(spark, str(tmp_path)).collect()
    (tmp_path / "rules.json").write_text('{"cleaner":[["regex-matcher",{"queries":[{"label":')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_rules(spark, str(tmp_path / "rules.json")).collect()


def test_trees_by_page(spark, tmp_path):
    word = lambda t: {"type": "word", "content": t}
    page = lambda n: {"pageNumber": n, "elements": [{"type": "heading", "content": [word(f"h{n}")]}]}
    (tmp_path / "a.json").write_text(json.dumps({"pages": [page(1), page(2)]}, indent=1))
    docs = readers.read_parsed_docs(spark, str(tmp_path))
    assert [(r["doc_id"], r["title"]) for r in trees.tree_sections(docs).collect()] == [("a", "h1 "), ("a", "h2 ")]
    assert trees.tree_page_text(docs, 2).first()["text"] == "h2 \n\n"
    assert trees.tree_elements(docs).count() == 2 and trees.flatten_tree(docs).count() == 4

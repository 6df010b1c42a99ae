"""Small hand-made inputs for every rule of lines, paragraphs and parse trees."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import trees as V
from corpusloom.operators import texts, trees

TEXT = "  In-\nter-\nest \xa0\n\na - b\n\n\ntail\xa0"


def docs(spark, *texts_):
    return spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")


#: Text, its paragraphs, and the tail that only ``keep_tail`` adds.
PARAGRAPHS = [
    (TEXT, ["Interest\n", "a b\n", "\n"], ["tail\n"]),
    ("", ["\n"], []),
    ("\n", ["\n", "\n"], []),
    ("one line", [], ["one line\n"]),
    ("x\n\n", ["x\n", "\n"], []),
    ("\n\n\n", ["\n", "\n", "\n", "\n"], []),
    ("a\n \nb\n\t\nc", ["a\n", "b\n"], ["c\n"]),
    ("- \n\n-\n\n", ["-\n", "-\n", "\n"], []),
    ("é - \x1f\n\nz", ["é -\n"], ["z\n"]),
]
CASES = [case[0] for case in PARAGRAPHS]


@pytest.mark.parametrize("keep_tail", [False, True])
def test_paragraphs(spark, keep_tail):
    frame = docs(spark, *CASES)
    want = {(i, n): p for i, (_, full, tail) in enumerate(PARAGRAPHS) for n, p in enumerate(full + tail * keep_tail)}
    got = texts.paragraphs(frame, keep_tail=keep_tail).collect()
    assert {(r.doc_id, r.par_no): r.text for r in got} == want


def test_paragraphs_of_lines_agree(spark, rows):
    frame = docs(spark, *CASES)
    assert rows(texts.assemble_paragraphs(texts.split_lines(frame))) == rows(texts.paragraphs(frame))


def test_document_text(spark):
    got = {r.doc_id: (r.text, r.reason) for r in texts.document_texts(docs(spark, TEXT, "x", None)).collect()}
    assert got == {0: ("\n".join(PARAGRAPHS[0][1]), None), 1: ("", "no paragraph"), 2: (None, "no text")}


def test_strip_takes_all_white_space(spark):
    sample = T.WHITE_SPACE + "a b" + T.WHITE_SPACE
    assert docs(spark, sample).select(T.strip(F.col("text"))).first()[0] == sample.strip()


def word(content):
    return {"type": "word", "content": content}


def line(*words):
    return {"type": "line", "content": [word(w) if isinstance(w, str) else w for w in words]}


def spelled(text):
    return word([{"type": "character", "content": c} for c in text])


def tree(*pages):
    return {"pages": [{"pageNumber": i + 1, "elements": list(p)} for i, p in enumerate(pages)]}


TREE = tree(
    [
        {"type": "paragraph", "content": [line("before", "all")]},
        {"type": "heading", "content": [line("1", "Intro")]},
        {"type": "paragraph", "content": [line("some", spelled("abc"), "text")]},
        {"content": "no type"},
        "not a node",
        {"type": "list", "content": [{"type": "paragraph", "content": [line("item")]}]},
        {"type": "table", "content": [line("hidden")]},
    ],
    [
        {"type": "paragraph", "content": [line("goes"), line("on")]},
        {"type": "heading", "content": [line("2"), line("Next")]},
        {"type": "word", "content": "alone"},
    ],
)


def parsed(spark, *trees_):
    data = [(i, json.dumps(t)) for i, t in enumerate(trees_)]
    return spark.createDataFrame(data, "doc_id long, json string").select(
        "doc_id", F.parse_json("json").alias("doc")
    )


SECTIONS = [
    (0, 1, "1 Intro ", "1 Intro \n\nsome abctext \n\nitem \n\ngoes on \n\n"),
    (0, 2, "2 Next ", "2 Next \n\nalone \n\n"),
]


def test_sections(spark, rows):
    assert rows(trees.tree_sections(parsed(spark, TREE))) == SECTIONS


def test_sections_of_elements_agree(spark, rows):
    elements = trees.tree_elements(parsed(spark, TREE))
    assert rows(trees.sections(elements)) == SECTIONS
    numbered = trees.drop_preamble(trees.assign_sections(trees.text_elements(elements)))
    paired = trees.sections_with_titles(trees.section_text(numbered), trees.section_titles(numbered))
    assert rows(paired) == SECTIONS


def test_page_text_leaves_lists_out(spark, rows):
    frame = parsed(spark, TREE)
    assert rows(trees.tree_page_text(frame, 1)) == [
        (0, "before all \n\n1 Intro \n\nsome abctext \n\n")
    ]
    assert rows(trees.tree_page_text(frame, 3)) == []
    assert trees.tree_page_text(frame).first()["text"].endswith("2 Next \n\nalone \n\n")


def test_spelled_words_may_get_a_blank(spark):
    element = F.parse_json(F.lit(json.dumps(TREE["pages"][0]["elements"][2])))
    text = V.element_text(element, space_after_spelled_words=True)
    assert spark.range(1).select(text).first()[0] == "some abc text "


def test_flatten_tree(spark, rows):
    nodes = trees.flatten_tree(parsed(spark, TREE))
    got = [(r.path, r.type, r.text) for r in nodes.orderBy("path").collect()]
    assert got[0] == ([0, 0], "paragraph", None)
    assert ([0, 2, 0, 1], "word", None) in got
    assert ([0, 2, 0, 1, 2], "character", "c") in got
    assert ([1, 2], "word", "alone ") in got
    assert not any(path == [0, 3] or path == [0, 4] for path, _, _ in got)
    texts_ = {(r.page_pos, r.elem_pos): r.text for r in trees.node_text(nodes).collect()}
    assert texts_[0, 2] == "some abctext " and texts_[1, 0] == "goes on "


def test_depth_follows_the_data(spark):
    """A tree of depth 42 beside a flat one; the plan has one level of expressions."""
    node = word("deep [")
    for _ in range(41):
        node = {"type": "list", "content": [node]}
    below = {"type": "paragraph", "content": [node, word("flat")]}
    frame = parsed(spark, tree([below]), tree([line("x")]))
    nodes = trees.flatten_tree(frame)
    per_doc = {r[0]: r[1:] for r in nodes.groupBy("doc_id").agg(F.count("*"), F.max(F.size("path"))).collect()}
    assert sorted(per_doc.values()) == [(2, 3), (44, 44)]
    assert nodes.where(F.size("path") == 44).first()["text"] == "deep [ "
    texts_ = trees.tree_page_text(parsed(spark, tree([{"type": "paragraph", "content": [word("a"), line("b"), word("c")]}])))
    assert texts_.first()["text"] == "a b c \n\n"
    assert len(nodes._jdf.queryExecution().toString()) < 40_000


def test_empty_trees(spark):
    frame = parsed(spark, {"pages": []}, {}, tree([]))
    assert trees.tree_sections(frame).count() == 0
    assert trees.flatten_tree(frame).count() == 0

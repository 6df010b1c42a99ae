"""Readers and writers by round trip in a scratch folder."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import scalars as S
from corpusloom.operators import corpus, graph, rules, web
from corpusloom.plans import pipelines
from corpusloom.sinks import batches, writers
from corpusloom.sources import readers

CORPUS = {
    "@context": {},
    "@graph": [
        {"@id": "http://v.test/V#publication-aa", "@type": "ResearchPublication",
         "openAccess": {"@value": "http://a.test/1"}},
        {"@id": "http://v.test/V#publication-bb", "@type": "ResearchPublication",
         "openAccess": [{"@value": "http://a.test/2"}, {"@value": "http://a.test/3"}]},
        {"@id": "http://v.test/V#dataset-cc", "@type": "Dataset",
         "foaf:page": {"@value": "http://d.test/c"}},
        {"@id": "http://v.test/V#dataset-dd", "@type": "Dataset",
         "foaf:page": {"@value": "http://example.com/d"}},
        {"@id": "http://v.test/V#dataset-ee", "@type": "Dataset"},
    ],
}


@pytest.fixture
def corpus_file(tmp_path):
    path = tmp_path / "corpus.jsonld"
    path.write_text(json.dumps(CORPUS, indent=1))
    return str(path)


def test_cut_corpus_file_raises(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"@graph":[{"@id":"a"},{"@id":')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_corpus(spark, str(tmp_path)).collect()


def test_one_id_for_a_file_with_blank_and_accent(spark, tmp_path):
    (tmp_path / "my été.txt").write_text("x")
    (tmp_path / "my été.json").write_text('{"pages":[]}')
    assert readers.read_texts(spark, str(tmp_path)).first()["doc_id"] == "my été"
    assert readers.read_parsed_docs(spark, str(tmp_path)).first()["doc_id"] == "my été"
    path = readers.scan_files(spark, str(tmp_path), "txt").first()["path"]
    assert path.endswith("/my été.txt")


def test_read_corpus(spark, rows, corpus_file):
    entities = readers.read_corpus(spark, corpus_file)
    assert corpus.corpus_size(entities).first()["n"] == 5
    assert rows(corpus.duplicate_publications(entities)) == [
        ("bb", ["http://a.test/2", "http://a.test/3"])
    ]
    urls = corpus.access_url(corpus.of_type(entities, corpus.PUBLICATION)).select("url")
    assert rows(urls) == [("http://a.test/1",), ("http://a.test/2",)]
    pages = corpus.with_entity_id(corpus.page_url(entities)).select("entity_id", "url")
    assert rows(pages) == [("cc", "http://d.test/c")]


def test_fetch_plan_and_todo(spark, rows, corpus_file, tmp_path):
    (tmp_path / "pub/pdf").mkdir(parents=True)
    (tmp_path / "dat").mkdir()
    (tmp_path / "pub/pdf/aa.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "pub/pdf/bb.html").write_bytes(b"no PDF, so it does not count")
    (tmp_path / "dat/dd.html").write_bytes(b"")
    plan = pipelines.fetch_plan(spark, corpus_file, str(tmp_path))
    wanted = [("pdf", "bb", "http://a.test/2", "pub/pdf/"), ("unknown", "cc", "http://d.test/c", "dat/")]
    assert rows(plan.drop("part")) == wanted
    assert pipelines.fetch_plan(spark, corpus_file, str(tmp_path), force=True).count() == 3
    todo = str(tmp_path / "todo")
    assert writers.write_todo(plan, todo)
    assert rows(readers.read_todo(spark, todo)) == wanted
    assert not writers.write_todo(plan, str(tmp_path / "other"), todo="todo.tsv")
    report = pipelines.fetch_report(spark, corpus_file, str(tmp_path))
    assert rows(report) == [("Dataset", 3, 1, 2), ("ResearchPublication", 2, 1, 1)]


def test_scan_and_list_keys(spark, rows, tmp_path):
    folder = tmp_path / "store/corpus_docs/pub/pdf"
    folder.mkdir(parents=True)
    (folder / "x.pdf").write_bytes(b"%PDF-1.7")
    (folder / "y.pdf").write_bytes(b"")
    (folder / "z.txt").write_bytes(b"text")
    assert readers.scan_files(spark, str(tmp_path / "store"), "pdf").count() == 1
    files = readers.scan_files(spark, str(tmp_path / "store"), "pdf", with_empty=True)
    assert rows(files.select(S.file_stem(F.col("path")), "length")) == [("x", 8), ("y", 0)]
    assert rows(corpus.id_set(corpus.non_empty(files))) == [("x",)]
    keys = readers.list_keys(spark, str(tmp_path / "store"), "corpus_docs/pub", "pdf", with_empty=True)
    assert rows(keys.select("path")) == [
        ("corpus_docs/pub/pdf/x.pdf",), ("corpus_docs/pub/pdf/y.pdf",)
    ]
    assert rows(corpus.stored_ids(keys, "pdf")) == [("x",), ("y",)]
    assert readers.list_keys(spark, str(tmp_path / "store"), "corpus_docs/dat").isEmpty()
    flags = web.pdf_flags(readers.scan_files(spark, str(folder), "pdf", content=True))
    assert [r["is_pdf"] for r in flags.collect()] == [True]


def test_heads_of_files_of_any_size(spark, rows, tmp_path):
    """A file of 5 GB, which no row could hold, and files with less than a head."""
    for name, body in (("a b é.pdf", b"%PDF-1.4"), ("p%20q.pdf", b"%PD"), ("large.pdf", b"%PDF-")):
        (tmp_path / name).write_bytes(body)
    with open(tmp_path / "large.pdf", "r+b") as f:
        f.truncate(5 << 30)
    heads = readers.file_heads(readers.scan_files(spark, str(tmp_path), "pdf", with_empty=True), 5)
    got = rows(web.pdf_flags(heads.withColumnRenamed("head", "content")))
    assert [(p.rsplit("/", 1)[1], f) for p, f in got] == [("a b é.pdf", True), ("large.pdf", True), ("p%20q.pdf", False)]
    missing = spark.createDataFrame([(None,)], "path string")
    assert rows(readers.file_heads(missing, 5)) == [(None, None)]
    with pytest.raises(Exception, match="No such file"):
        readers.file_heads(spark.createDataFrame([(f"file:{tmp_path}/none",)], "path string"), 5).collect()


def test_scan_does_not_read_content(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"x")
    plan = readers.scan_files(spark, str(tmp_path), "pdf")._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1]


def test_texts(spark, rows, tmp_path):
    docs = spark.createDataFrame([("a", "one\ntwo"), ("b", ""), ("c", None)], "doc_id string, text string")
    assert writers.write_texts(docs, str(tmp_path / "out")) == 1
    assert rows(batches.read_batches(spark, str(tmp_path / "out")).select("doc_id", "text", "kind")) == [("a", "one\ntwo", "txt")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/p.q.txt").write_text("é\n\nx\n", encoding="utf8")
    assert rows(readers.read_texts(spark, str(tmp_path / "in"))) == [("p.q", "é\n\nx\n")]


def test_triples(spark, rows, tmp_path):
    triples = spark.createDataFrame(
        [("http://a/1", "http://p", 'say "hi" \\n\nend'), ("http://a/1", "http://p", 'say "hi" \\n\nend'),
         ("http://a/2", "http://p", "http://a/1")],
        "s string, p string, o string",
    )
    writers.write_ntriples(triples, str(tmp_path / "nt"))
    again = readers.read_triples(spark, str(tmp_path / "nt"))
    assert rows(again) == rows(triples.distinct())


def test_triple_syntax(spark, rows, tmp_path):
    (tmp_path / "g.nt").write_text(
        '# a comment\n\n<http://a> <http://p> "x"@en .\n'
        '_:b1 <http://p> "1"^^<http://int> . # note\n<http://a> <http://p> _:b1 .\n'
    )
    assert rows(readers.read_triples(spark, str(tmp_path / "g.nt"))) == [
        ("_:b1", "http://p", "1"), ("http://a", "http://p", "_:b1"), ("http://a", "http://p", "x")
    ]
    (tmp_path / "bad.nt").write_text("<http://a> <http://p>\n")
    with pytest.raises(Exception, match="not a triple"):
        readers.read_triples(spark, str(tmp_path / "bad.nt")).collect()


def test_triple_escapes_and_bad_lines(spark, rows, tmp_path):
    bad = ["<http://a> <http://p>", 'x <http://p> "o" .', '<http://a> <http://p> "a"b" .', '<http://a> <http://p> "\\x" .',
           '<http://a> <http://p> "o"', '<http://a> p "o" .']
    good = [r'<http://\u00e9> <http://p> "\u00e9\U0001F600\\u00e9\t\"\n\'" .', '<http://a><http://p>_:b.c.', r'<http://a\b> "p" "" .',
            f'<http://a> <http://p> "{"x" * 500_000}{chr(92) * 100_000}"@en-GB.#']
    want = [("http://é", "http://p", 'é😀\\u00e9\t"\n\''), ("http://a", "http://p", "_:b.c"), ("http://a\\b", "p", ""),
            ("http://a", "http://p", "x" * 500_000 + chr(92) * 50_000)]
    (tmp_path / "g.nt").write_text("\n".join([good[0], *bad, *good[1:], "", " # note"]) + "\n", encoding="utf8")
    path = str(tmp_path / "g.nt")
    assert rows(readers.read_triples(spark, path, graph.DROPMALFORMED)) == sorted(want, key=repr)
    kept = readers.read_triples(spark, path, graph.PERMISSIVE)
    assert rows(kept.where("reason is null").select("s", "p", "o")) == sorted(want, key=repr)
    reasons = {r["bad_line"]: r["reason"] for r in kept.where("s is null").collect()}
    assert reasons == dict(zip(bad, ["no object", "no subject", "no end", "no object", "no end", "no predicate"]))
    with pytest.raises(Exception, match="not a triple, no object"):
        readers.read_triples(spark, path).select("p").collect()
    with pytest.raises(ValueError):
        readers.read_triples(spark, path, "odd")
    broken = spark.createDataFrame([('<a:b> <a:p> "x\ny" .',), (None,)], "value string")
    assert rows(graph.parse_ntriples(broken, mode=graph.PERMISSIVE).select("reason")) == [("no object",)]


def test_jsonld(spark, tmp_path):
    (tmp_path / "vocab.json").write_text(
        '{"@language": "en", "t": "http://t/", "tx": "http://t/x/"}'
    )
    context = readers.read_context(spark, str(tmp_path / "vocab.json"))
    data = [("http://t/s", "http://t/p", f"http://t/x/{i}") for i in range(10)]
    data += [("http://t/u", "http://t/p", 'a "b"')]
    triples = spark.createDataFrame(data, "s string, p string, o string")
    writers.write_jsonld(triples, context, str(tmp_path / "ld"))
    nodes = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "ld")).collect()]
    assert {"@id": "t:u", "t:p": ['a "b"']} in nodes
    assert {"@id": "t:s", "t:p": [f"tx:{i}" for i in range(10)]} in nodes
    split = [json.loads(r["value"]) for r in graph.jsonld_nodes(triples, context, per_object=3).collect()]
    assert len(split) > 2
    assert sorted(o for n in split if n["@id"] == "t:s" for o in n["t:p"]) == [f"tx:{i}" for i in range(10)]


def test_rules(spark, rows, tmp_path):
    matcher = lambda rule, **flags: ["regex-matcher", flags | {"queries": [dict(zip(("label", "regex"), rule))]}]
    config = {
        "version": 1,
        "cleaner": [
            "first-step", ["other", {"x": 1}],
            matcher(rules.DEFAULT_RULES[0], isCaseSensitive=True, isGlobal=True),
            matcher(rules.DEFAULT_RULES[1], isCaseSensitive=False, isGlobal=False),
        ],
    }
    (tmp_path / "config.json").write_text(json.dumps(config, indent=1))
    found = readers.read_rules(spark, str(tmp_path / "config.json"))
    docs = spark.createDataFrame(
        [(1, "AB-123-CD, 3 ANS, 4ans, XY-999-ZZ, ab-123-cd"), (2, None), (3, "nothing")], "doc_id long, text string"
    )
    want = [(1, "Age", 0, "3 ANS"), (1, "Car", 0, "AB-123-CD"), (1, "Car", 1, "XY-999-ZZ")]
    assert rows(rules.label_matches(docs, found)) == want
    pairs = [rules.DEFAULT_RULES[0], (*rules.DEFAULT_RULES[1], False, False)]
    assert rows(rules.label_matches(docs, pairs)) == want
    assert rows(rules.label_matches(docs, rules.DEFAULT_RULES[1:2])) == [(1, "Age", 0, "4ans")]
    many = spark.range(3000).selectExpr("concat('r', id) as label", "concat('x', id, ' ') as regex", "true as case_sensitive", "null as all_matches")
    text = spark.createDataFrame([(7, "x5 x2999 x5 x3000 ")], "doc_id long, text string")
    got = rules.label_matches(text, many.withColumn("all_matches", F.col("all_matches").cast("boolean")))
    assert rows(got) == [(7, "r2999", 0, "x2999 "), (7, "r5", 0, "x5 "), (7, "r5", 1, "x5 ")]


def test_tables(spark, rows, tmp_path):
    (tmp_path / "t.csv").write_text("Unnamed: 0;a;b\n0;x;\n1;;2.5\n")
    table = rules.clean_table(readers.read_tables(spark, str(tmp_path / "t.csv")))
    assert table.columns == ["a", "b"]
    assert rows(table) == [(" ", "2.5"), ("x", " ")]


def test_manifest(spark, tmp_path):
    local = spark.createDataFrame([("r/a.pdf",), ("r/b.pdf",), ("r/a.txt",)], "path string")
    keys = spark.createDataFrame([("corpus_docs/pub/pdf/b.pdf",), ("corpus_docs/pub/pdf/c.pdf",)], "path string")
    row = corpus.manifest(local, keys, "2020-03-01", "v1")
    writers.write_manifest(row, str(tmp_path / "m"))
    text = [r["value"] for r in spark.read.text(str(tmp_path / "m")).collect()]
    assert text == [
        "date: 2020-03-01", "release: v1", "uploaded_pdf: 3", "uploaded_json: 0", "uploaded_txt: 1"
    ]


def test_sync_missing(spark, rows, tmp_path):
    target = str(tmp_path / "target")
    files = spark.createDataFrame(
        [("a", "pdf", "x"), ("b", "pdf", "y"), ("a", "txt", "z")], "entity_id string, kind string, body string"
    )
    done = spark.createDataFrame([("a", "pdf"), ("a", "pdf")], "entity_id string, kind string")
    assert writers.sync_missing(files, done, target, "1") == (1, 2)
    stored = batches.read_batches(spark, target).select("entity_id", "kind")
    assert writers.sync_missing(files, stored.unionByName(done), target, "2") == (3, 0)
    # a run that is tried again gives its counts and adds nothing
    assert writers.sync_missing(files, done, target, "1") == (1, 2)
    assert rows(batches.read_batches(spark, target).select("entity_id", "kind", "body")) == [("a", "txt", "z"), ("b", "pdf", "y")]
    none = str(tmp_path / "none")
    assert writers.sync_missing(files, done.limit(0), none, "1") == (0, 3)
    assert writers.sync_missing(files.limit(0), done, none, "2") == (1, 0)
    with pytest.raises(ValueError):
        writers.sync_missing(files, done, none, "../x")


def test_a_lost_write_is_not_read_and_is_replaced(spark, rows, tmp_path):
    """A try that ended before its record left other rows, of another kind too."""
    folder = str(tmp_path / "out")
    docs = lambda *ids: spark.createDataFrame([(i, i) for i in ids], "doc_id string, text string")
    writers.write_texts(docs("a", "b"), folder, batch="1")
    lost = docs("c", "d").withColumn("kind", F.lit("json"))
    lost.write.partitionBy("kind").parquet(f"{folder}/batch=b-txt-2")
    read = lambda: rows(batches.read_batches(spark, folder).select("doc_id", "kind"))
    assert read() == [("a", "txt"), ("b", "txt")]
    for _ in range(2):
        assert writers.write_texts(docs("c"), folder, batch="2") == 1
        assert read() == [("a", "txt"), ("b", "txt"), ("c", "txt")]
    writers.write_texts(docs("a"), folder, kind="json", batch="2")
    assert read() == [("a", "json"), ("a", "txt"), ("b", "txt"), ("c", "txt")]


def test_first_keys(spark, rows):
    keys = spark.createDataFrame([(f"corpus_docs/{i:02}",) for i in range(30)] + [("a",)], "path string")
    assert [r["path"] for r in corpus.first_keys(keys).collect()] == [f"corpus_docs/{i:02}" for i in range(10)]

"""Running totals with hot keys, graphs, versions and fetch logs."""

import random

from pyspark.sql import functions as F

from corpusloom.functions import scalars as S
from corpusloom.operators import documents, graph, versions, web
from corpusloom.operators.running import Ranges, next_order, running_total


def test_running_total_of_a_hot_key(spark, rows):
    """A third of all rows under one key, random orders of 63 bits, null keys and a null order."""
    rnd = random.Random(1)
    orders = sorted({rnd.randrange(-(2**63), 2**63) for _ in range(2999)})
    data = [(0 if i % 3 == 0 else [None, *range(1, 9)][i % 9], at, rnd.randint(0, 5)) for i, at in enumerate([None, *orders])]
    frame = spark.createDataFrame(data, "k long, at long, v long")
    for keys in (["k"], []):
        sums, want = {}, []
        for k, at, v in data:
            key = k if keys else 0
            sums[key] = sums.get(key, 0) + v
            want.append((k, at, v, sums[key]))
        for shares in (1, 7, 40):
            got = running_total(frame, keys, "at", "v", "s", shares=shares)
            assert got.columns == ["k", "at", "v", "s"]
            assert rows(got) == sorted(want, key=repr)


def test_a_hot_key_is_cut_into_ranges(spark):
    """No range holds more than a few shares of the rows, and small keys are not cut."""
    rnd = random.Random(2)
    data = [(0 if i % 2 else i % 500, rnd.randrange(2**63) >> rnd.randrange(60), 1) for i in range(40_000)]
    frame = spark.createDataFrame(data, "k long, at long, v long")
    ranges = Ranges(frame, ["k"], "at", 20)
    sizes = {(r[0], r[1]): r[2] for r in ranges.rows.groupBy("k", "_range").count().collect()}
    assert max(sizes.values()) <= 3 * 40_000 / 20
    assert sum(k == 0 for k, _ in sizes) >= 8 and all(n == 0 for k, n in sizes if k)
    plan = running_total(frame, [], "at", "v", "s")._jdf.queryExecution().toString()
    assert "windowspecdefinition(_all" in plan and "_range" in plan


def test_running_total_of_nothing(spark):
    frame = spark.createDataFrame([], "k long, at long, v long")
    assert running_total(frame, ["k"], "at", "v", "s").count() == 0
    assert next_order(frame, [], "at", "n").count() == 0


def test_next_order_of_a_hot_key(spark, rows):
    data = [(0 if i % 3 == 0 else i % 5, i * i) for i in range(2000)]
    frame = spark.createDataFrame(data, "k long, at long")
    last, want = {}, []
    for k, at in reversed(data):
        want.append((k, at, last.get(k)))
        last[k] = at
    for shares in (1, 9, 30):
        got = next_order(frame, ["k"], "at", "nxt", shares=shares).select("k", "at", "nxt")
        assert rows(got) == sorted(want, key=repr)


TRIPLES = [
    (0, "http://a", "http://p1", "http://b"),
    (1, "http://a", "http://p1", "http://b"),
    (2, "http://b", "http://p2", "http://a"),
    (3, "http://c", "http://p1", 'lit "q"'),
    (4, "http://c", "http://p3", "http://c"),
]


def triples(spark):
    return spark.createDataFrame(TRIPLES, "seq long, s string, p string, o string")


def test_node_edge_tables(spark, rows):
    nodes, edges = graph.node_edge_tables(triples(spark))
    assert rows(nodes) == [(0, "http://a"), (1, "http://b"), (2, "http://c"), (3, 'lit "q"')]
    assert rows(edges) == [(0, 1, "http://p2"), (2, 2, "http://p3"), (2, 3, "http://p1")]


def test_neighbourhood_is_a_set(spark, rows):
    assert rows(graph.neighbourhood(triples(spark), "/a")) == [
        ("http://a", "http://p1", "http://b"), ("http://b", "http://p2", "http://a")
    ]


def test_lines_escape_quotes(spark, rows):
    lines = [r[0] for r in rows(graph.ntriples_lines(triples(spark).where("seq = 3")))]
    assert lines == ['<http://c> <http://p1> "lit \\"q\\"" .']


def test_longest_prefix_wins(spark):
    context = {"@language": "en", "a": "http://x/", "b": "http://x/y#", "c": "h", "B": "http://x/y#", "d": "http://x/y#zz/"}
    iris = ["http://x/y#z", "http://x/q", "http://w/", "urn:1", None, "", "h", "http://x/y#", "http://x/y#zz/end", "http://x/y#zz"]
    want = ["B:z", "a:q", "c:ttp://w/", "urn:1", None, "", "c:", "B:", "d:end", "B:zz"]
    frame = spark.createDataFrame(list(enumerate(iris)), "n int, iri string")
    for given in (context, graph.context_table(spark, context)):
        got = graph.compact_iris(frame, ["iri"], given).orderBy("n").collect()
        assert [r["iri"] for r in got] == want


def test_a_vocabulary_of_any_size(spark):
    """Twenty thousand namespaces, nested and of all lengths, against trying each."""
    rnd = random.Random(4)
    spaces = {"http://v/" + "".join(rnd.choice("ab/") for _ in range(rnd.randint(1, 24))) for _ in range(20_000)}
    context = {f"p{i}": ns for i, ns in enumerate(sorted(spaces))}
    names = {ns: p for p, ns in context.items()}
    iris = ["http://v/" + "".join(rnd.choice("ab/") for _ in range(rnd.randint(0, 40))) for _ in range(300)]

    def plain(iri):
        longest = max((n for n in range(len(iri) + 1) if iri[:n] in names), default=None)
        return iri if longest is None else f"{names[iri[:longest]]}:{iri[longest:]}"

    got = graph.compact_iris(spark.createDataFrame([(i,) for i in iris], "iri string"), ["iri"], context).collect()
    assert sorted(r[0] for r in got) == sorted(map(plain, iris))


def test_version_diff(spark, rows):
    log = spark.createDataFrame(
        [(1, 1, "a\nb\nc"), (1, 2, "a\nb\nc"), (1, 5, "c\na\nb\nb"), (2, 1, "only")],
        "doc_id long, ver long, text string",
    )
    assert rows(versions.consecutive_versions(log)) == [(1, 1, 2), (1, 2, 5)]
    assert rows(versions.version_diff(log)) == [
        (1, 1, 2, "a", 1, 0, 0), (1, 1, 2, "b", 1, 0, 0), (1, 1, 2, "c", 1, 0, 0),
        (1, 2, 5, "a", 1, 0, 0), (1, 2, 5, "b", 1, 0, 1), (1, 2, 5, "c", 1, 0, 0),
    ]
    assert versions.versions_of(log, 9).isEmpty()
    assert rows(versions.version_history(log).select("doc_id", "ver", "pos")) == [
        (1, 1, 1), (1, 2, 2), (1, 5, 3), (2, 1, 1)
    ]


def test_attempt_outcomes(spark, rows):
    log = spark.createDataFrame(
        [(1, 1, False, "x"), (1, 2, False, "y"), (1, 3, True, None),
         (2, 1, False, "x"), (2, 2, False, "y"), (2, 3, False, None), (3, 1, False, "z")],
        "task long, seq long, ok boolean, status string",
    )
    assert rows(web.attempt_outcomes(log)) == [
        (1, "ok", 3, None), (2, "gave_up", 3, None), (3, "retry", 1, "z")
    ]


def test_web(spark, rows):
    pages = spark.createDataFrame(
        [(1, "http://h.test/d/p.html?q#f",
          '<a href="x.pdf">x</a><A class="k" href=\'/y\'>y</A><a href="#top">t</a>'
          '<a href="//o.test/z">z</a><a href="mailto:m">m</a><embed type="p" src="/x.pdf">'),
         (2, "http://h.test", "<p>none</p>")],
        "page_id long, url string, html string",
    )
    assert [r["link"] for r in web.extract_links(pages).orderBy("link_no").collect()] == [
        "http://h.test/d/x.pdf", "http://h.test/y", "http://o.test/z"
    ]
    assert rows(web.first_link(pages)) == [(1, "http://h.test/d/x.pdf"), (2, None)]
    assert rows(web.embedded_documents(pages)) == [
        (1, "http://h.test/x.pdf", None), (2, None, "no embedded PDF")
    ]
    parts = rows(web.url_parts(pages).select("scheme", "host", "fragment"))
    assert parts == [("http", "h.test", ""), ("http", "h.test", "f")]


def test_routes_and_types(spark):
    urls = ["https://www.sciencedirect.com/a", "http://x.onlinelibrary.wiley.com/b", "http://www.sciencedirect.com.x/"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r["route"] for r in web.fetch_routes(frame).collect()] == ["links", "embed", "direct"]
    kinds = spark.createDataFrame(
        [("pdf", "text/html"), ("unknown", "text/html; x"), ("unknown", "image/png")],
        "type string, content_type string",
    )
    assert [r["resource_type"] for r in web.resource_types(kinds).collect()] == ["pdf", "html", "pdf"]
    wrong = spark.createDataFrame([("odd", "x")], kinds.schema)
    try:
        web.resource_types(wrong).collect()
        raise AssertionError("accepted")
    except Exception as error:
        assert "invalid resource type" in str(error)


def test_paths(spark):
    frame = spark.createDataFrame(
        [("corpus_docs/pub/pdf/ab.c.pdf",), ("x",), ("d/.hidden",)], "path string"
    )
    assert [r[0] for r in frame.select(S.file_stem(F.col("path"))).collect()] == ["ab.c", "x", ".hidden"]
    assert frame.select(S.key_id(F.col("path"), "pdf")).first()[0] == "ab.c"


def test_map_documents_sets_up_once_per_partition(spark):
    docs = spark.range(8).selectExpr("id doc_id", "cast(id as string) text").repartition(2)

    def fn(batch, state):
        state.append(1)
        return batch.assign(n=len(state))[["doc_id", "n"]]

    got = documents.map_documents(docs, fn, "doc_id long, n long", set_up=list)
    assert {r["n"] for r in got.collect()} == {1}

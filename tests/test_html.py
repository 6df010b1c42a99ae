"""Links of hard pages, and references against Python's own resolution."""

import html as pyhtml
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import html as H
from corpusloom.operators import web

PAGE = "http://h.test/d/e/p.html?q#f"


def links(spark, html, url=PAGE):
    return [r["link"] for r in web.extract_links(spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")).orderBy("link_no").collect()]


@pytest.mark.parametrize("html, found", [
    ("<a href=x>", ["http://h.test/d/e/x"]),
    ("<a href=x/>", ["http://h.test/d/e/x/"]),
    ("<a href = 'x' >", ["http://h.test/d/e/x"]),
    ("<A\nCLASS=k\nHREF=\"x\"\n>", ["http://h.test/d/e/x"]),
    ("<a class='k'href='x'>", ["http://h.test/d/e/x"]),
    ('<a href="/s?a=1&amp;b=2&#38;c=&#x33;&eacute;&unknown;&amp;lt;">', ["http://h.test/s?a=1&b=2&c=3é&unknown;&lt;"]),
    ("<a href='/&#128512;&#xD800;&#0;&#999999999;'>", ["http://h.test/😀���"]),
    ('<a href="../../../y/./z/..">', ["http://h.test/y/"]),
    ('<a href="?k">', ["http://h.test/d/e/p.html?k"]),
    ('<a href=" x ">', ["http://h.test/d/e/x"]),
    ('<a title="a > b" href="x">', ["http://h.test/d/e/x"]),
    ("<a title=' href=no ' data-href=no href=x href=no>", ["http://h.test/d/e/x"]),
    ('<!-- <a href="no"> --><a href="x"><!-- <a href=no>', ["http://h.test/d/e/x"]),
    ('<script>"<a href=no>"</script ><style>a{}<a href=no></style><a href=x>', ["http://h.test/d/e/x"]),
    ('<abbr href="no"><a><a href><a href=""><a href="#t"><a href="JavaScript:x"><a href="mailto:m">', []),
    ('<base href="/b/c/"><a href="x"><a href="//o.test/z"><a href="https://p.test/a/../b">',
     ["http://h.test/b/c/x", "http://o.test/z", "https://p.test/b"]),
    ('<base target="_top"><base href="http://o.test"><base href="/no"><a href="x">', ["http://o.test/x"]),
    ('<a href="x', []),
    ("", []),
    (None, []),
])
def test_links(spark, html, found):
    assert links(spark, html) == found


def test_long_pages(spark):
    """A tag of 200,000 attributes, a value and a comment of a million characters."""
    attributes = "".join(f" k{i}='v > {i}'" for i in range(200_000))
    page = f"<a{attributes} href=x><a href='{'y' * 1_000_000}'><!--{'<a href=no>' * 100_000}--><a href=z>"
    assert links(spark, page) == ["http://h.test/d/e/x", "http://h.test/d/e/" + "y" * 1_000_000, "http://h.test/d/e/z"]


def test_embedded(spark, rows):
    pages = spark.createDataFrame(
        [(1, PAGE, "<embed type=p src=../x.pdf?a&amp;b>"), (2, PAGE, "<base href=/k/><embed><embed src='y.pdf'>"), (3, None, "<embed src=x>"), (4, PAGE, None)],
        "page_id long, url string, html string",
    )
    assert rows(web.embedded_documents(pages)) == [
        (1, "http://h.test/d/x.pdf?a&b", None), (2, "http://h.test/k/y.pdf", None),
        (3, None, "no embedded PDF"), (4, None, "no embedded PDF"),
    ]


def test_references_as_python_resolves_them(spark):
    """Where a reference names a host, Python keeps its dots; there it resolves the path against the host alone."""
    rnd = random.Random(3)
    segment = lambda: rnd.choice(["a", "b.c", "..", ".", "...", ".d", "é"])
    bases = ["http://h.test", "http://h.test/", "https://h.test:8/a/b/c?q=1#f", "http://h.test/a/b/"]
    cases = []
    for _ in range(400):
        base, host = rnd.choice(bases), rnd.choice(["", "", "//o.test", "http://o.test", "https://o.test"])
        path = rnd.choice(["/"] if host else ["", "/"]) + "/".join(segment() for _ in range(rnd.randint(1, 6)))
        path += rnd.choice(["", "/"]) + rnd.choice(["", "?x=/../y", "#z/../w"])
        cases.append((base, host + path, urljoin(urljoin(base, host), path)))
    frame = spark.createDataFrame(cases, "base string, ref string, want string")
    for r in frame.withColumn("got", H.resolve(F.col("ref"), F.col("base"))).collect():
        assert r["got"] == r["want"], (r["base"], r["ref"])


def test_character_references_as_python_decodes_them(spark):
    texts = ["a&amp;b", "&lt;&gt;&quot;&apos;&nbsp;", "&&amp;;&", "&#65;&#x41;&#X3b1;", "x & y; z", "&Omega;&omega;", "plain", "&amp;#38;"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("got", H.decoded(F.col("t")))
    assert [r["got"] for r in frame.collect()] == [pyhtml.unescape(t) for t in texts]

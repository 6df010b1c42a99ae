"""The supplied tables, seen as the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.arrays import let
from corpusloom.session import dealt, evened

VOCAB = "http://vocab.test/Vocabulary#"
CONTEXT = {
    "@language": "en",
    "t": "http://t.test/",
    "cust": "http://t.test/customer/",
    "nat": "http://t.test/nation/",
}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def text_of(column: str) -> Column:
    return F.col(column).cast("string")


def entities(spark, sf_dir) -> DataFrame:
    pubs = table(spark, sf_dir, "pages").select(
        F.concat(F.lit(VOCAB + "publication-"), text_of("page_id")).alias("id"),
        F.lit("ResearchPublication").alias("type"),
        F.array("url").alias("access_urls"),
        F.lit(False).alias("access_is_list"),
        F.lit(None).cast("string").alias("page_url"),
    )
    key = F.col("p_partkey")
    sets = table(spark, sf_dir, "part").select(
        F.concat(F.lit(VOCAB + "dataset-"), text_of("p_partkey")).alias("id"),
        F.lit("Dataset").alias("type"),
        F.lit(None).cast("array<string>").alias("access_urls"),
        F.lit(False).alias("access_is_list"),
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 5 == 0, F.concat(F.lit("http://example.com/"), text_of("p_partkey")))
        .otherwise(F.concat(F.lit("http://data.test/"), text_of("p_partkey")))
        .alias("page_url"),
    )
    return pubs.unionByName(sets)


def records(spark, sf_dir) -> DataFrame:
    """The same corpus as JSON-LD records; every fourth publication holds a list."""
    pubs = table(spark, sf_dir, "pages").select(
        F.concat(F.lit(VOCAB + "publication-"), text_of("page_id")).alias("id"),
        F.to_json(F.struct(F.col("url").alias("@value"))).alias("url"),
        (F.col("page_id") % 4 == 0).alias("listed"),
    )
    pub_json = pubs.select(
        F.concat(
            F.lit('{"@id":"'), "id", F.lit('","@type":"ResearchPublication","openAccess":'),
            F.when(F.col("listed"), F.concat(F.lit("["), "url", F.lit(","), "url", F.lit("]")))
            .otherwise(F.col("url")),
            F.lit("}"),
        ).alias("json")
    )
    sets = entities(spark, sf_dir).where("type = 'Dataset'")
    set_json = sets.select(
        F.concat(
            F.lit('{"@id":"'), "id", F.lit('","@type":"Dataset"'),
            F.when(F.col("page_url").isNull(), F.lit("")).otherwise(
                F.concat(F.lit(',"foaf:page":{"@value":"'), "page_url", F.lit('"}'))
            ),
            F.lit("}"),
        ).alias("json")
    )
    return pub_json.unionByName(set_json).select(F.parse_json("json").alias("record"))


def files(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    part = table(spark, sf_dir, "part")

    def path(folder: str, key: str, ext) -> Column:
        ext = F.lit(ext) if isinstance(ext, str) else ext
        return F.concat(F.lit(f"corpus_docs/{folder}/"), text_of(key), ext).alias("path")

    pdfs = pages.where("page_id % 3 <> 0").select(
        path("pub/pdf", "page_id", ".pdf"),
        F.when(F.col("page_id") % 11 == 0, 0).otherwise(F.length("html")).cast("long").alias("length"),
    )
    texts = pages.where("page_id % 4 = 0").select(
        path("pub/txt", "page_id", ".txt"),
        F.when(F.col("page_id") % 10 == 0, 0).otherwise(100).cast("long").alias("length"),
    )
    sets = part.where("p_partkey % 3 = 0").select(
        path("dat", "p_partkey", F.when(F.col("p_partkey") % 2 == 0, ".html").otherwise(".pdf")),
        F.lit(10).cast("long").alias("length"),
    )
    return pdfs.unionByName(texts).unionByName(sets)


def files_in(spark, sf_dir, folder: str) -> DataFrame:
    return files(spark, sf_dir).where(F.col("path").startswith(f"corpus_docs/{folder}/"))


def local_files(spark, sf_dir) -> DataFrame:
    """Files on the publishing side: a PDF and a text for every page."""
    return table(spark, sf_dir, "pages").select(
        F.explode(
            F.array(
                F.concat(F.lit("resources/pub/pdf/"), text_of("page_id"), F.lit(".pdf")),
                F.concat(F.lit("resources/pub/txt/"), text_of("page_id"), F.lit(".txt")),
            )
        ).alias("path")
    )


def triples(spark, sf_dir) -> DataFrame:
    """Triples with ``seq``, their order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("http://t.test/order/"), text_of("o_orderkey")).alias("s"),
        F.lit("http://t.test/placedBy").alias("p"),
        F.concat(F.lit("http://t.test/customer/"), text_of("o_custkey")).alias("o"),
    )
    customers = table(spark, sf_dir, "customer").select(
        (F.lit(10**9) + F.col("c_custkey")).alias("seq"),
        F.concat(F.lit("http://t.test/customer/"), text_of("c_custkey")).alias("s"),
        F.lit("http://t.test/inNation").alias("p"),
        F.concat(F.lit("http://t.test/nation/"), text_of("c_nationkey")).alias("o"),
    )
    nations = table(spark, sf_dir, "nation").select(
        (F.lit(2 * 10**9) + F.col("n_nationkey").cast("long")).alias("seq"),
        F.concat(F.lit("http://t.test/nation/"), text_of("n_nationkey")).alias("s"),
        F.lit("http://t.test/name").alias("p"),
        F.col("n_name").alias("o"),
    )
    return orders.unionByName(customers).unionByName(nations)


def versions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("ver"), "text"
    )


def moved_words(spark, sf_dir) -> DataFrame:
    """Two versions of every text, a numbered word a line: the second drops every fifth line, adds one after every
    seventh that stays, and has the first line at its end."""
    words = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ", -1)
    first = F.transform(words, lambda w, i: F.concat((i + 1).cast("string"), F.lit(":"), w))

    def later(line, i):
        added = F.array(line, F.concat(F.lit("new "), (i + 1).cast("string")))
        stays = (i > 0) & ((i + 1) % 5 != 0)
        return F.when(~stays, F.array().cast("array<string>")).when((i + 1) % 7 == 0, added).otherwise(F.array(line))

    texts = evened(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", first.alias("lines"))
    # Rows before texts: who asks for the versions alone makes no text.
    both = texts.select("doc_id", "lines", F.explode(F.array(F.lit(1), F.lit(2))).alias("ver"))
    second = F.concat(F.flatten(F.transform("lines", later)), F.slice("lines", 1, 1))
    text = F.when(F.col("ver") == 1, F.array_join("lines", "\n")).otherwise(F.array_join(second, "\n"))
    return both.select("doc_id", "ver", text.alias("text"))


def attempts(spark, sf_dir) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("task"),
        F.col("event_id").alias("seq"),
        (~failed).alias("ok"),
        F.when(failed, F.concat(F.lit("failed "), text_of("event_id"))).alias("status"),
    )


def predictions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.col("l_partkey").alias("dataset_id"),
        F.col("l_extendedprice").alias("score"),
        (F.col("l_quantity") > 25).alias("correct"),
    )


def truth(spark, sf_dir) -> DataFrame:
    return predictions(spark, sf_dir).where("correct").select("doc_id", "dataset_id")


def rule_texts(spark, sf_dir) -> DataFrame:
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.concat(
            n.cast("string"), F.lit(" ans, "), (n * 7).cast("string"), F.lit("% AB-"),
            (n + 100).cast("string"), F.lit("-CD"),
        ).alias("text"),
    )


def _para_line(text: Column, at: Column) -> Column:
    """Blank out some lines, end others with a hyphen."""
    return (
        F.when(at % 5 == 4, F.lit(""))
        .when(at % 5 == 1, F.concat(text, F.lit("-")))
        .otherwise(text)
    )


def para_lines(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.select(
        "doc_id", "line_no", _para_line(F.col("line"), F.col("line_no")).alias("text")
    )


def para_docs(spark, sf_dir) -> DataFrame:
    """The same lines, left together as one text per document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.array_join(F.transform(F.split("text", "\n"), _para_line), "\n").alias("text"),
    )


def _element_type(m: Column, pos: Column) -> Column:
    return (
        F.when(m.startswith("<h1>") | (pos % 4 == 3), "heading")
        .when(pos % 9 == 8, "list")
        .otherwise("paragraph")
    )


def _items() -> Column:
    return F.regexp_extract_all(
        "html", F.lit(r"(?s)<(h1|p)>.*?</(?:h1|p)>"), F.lit(0)
    )


def elements(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.posexplode(_items()).alias("elem_no", "m")
    )
    return rows.select(
        "doc_id",
        F.floor(F.col("elem_no") / 6).cast("int").alias("page_no"),
        "elem_no",
        _element_type(F.col("m"), F.col("elem_no")).alias("type"),
        F.regexp_replace("m", "<[^>]*>", "").alias("text"),
    )


def _quoted(value: Column) -> Column:
    listed = F.to_json(F.array(value))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _node(kind, content: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lit('{"type":"'), kind, F.lit('","content":'), content, F.lit("}"))


def _listed(parts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))


def _word(w: Column, i: Column) -> Column:
    letters = F.transform(
        F.regexp_extract_all(w, F.lit("(?s)."), F.lit(0)), lambda c: _node("character", _quoted(c))
    )
    return _node("word", F.when(i % 5 == 4, _listed(letters)).otherwise(_quoted(w)))


def trees(spark, sf_dir) -> DataFrame:
    """Parse trees of the same elements: six to a page, every fifth word spelled."""

    def element(m: Column, pos: Column) -> Column:
        kind = _element_type(m, pos)
        words = F.split(F.regexp_replace(m, "<[^>]*>", ""), " ")
        line = _listed(F.array(_node("line", _listed(F.transform(words, _word)))))
        inner = F.when(kind == "list", _listed(F.array(_node("paragraph", line)))).otherwise(line)
        return _node(kind, inner)

    def one_page(items: Column, p: Column) -> Column:
        return F.concat(
            F.lit('{"pageNumber":'), p.cast("string"), F.lit(',"elements":'),
            _listed(F.slice(items, p * 6 + 1, 6)), F.lit("}"),
        )

    def whole(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / 6).cast("int")
        numbers = F.when(F.size(items) > 0, F.sequence(F.lit(0), last)).otherwise(
            F.array().cast("array<int>")
        )
        pages = _listed(F.transform(numbers, lambda p: one_page(items, p)))
        return F.parse_json(F.concat(F.lit('{"pages":'), pages, F.lit("}")))

    return dealt(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("doc_id"),
        let(F.transform(_items(), element), whole).alias("doc"),
    )


def names(spark, sf_dir) -> DataFrame:
    """Names to look for: whole passages, and their first two words."""
    bench = table(spark, sf_dir, "benchmark")
    whole = bench.select(F.col("item_id").alias("name_id"), F.col("text").alias("name"))
    short = bench.select(
        (F.col("item_id") + 1000000).alias("name_id"),
        F.regexp_extract("text", r"^([^ ]+ [^ ]+)", 1).alias("name"),
    )
    return whole.unionByName(short)


def tags(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("v"), text_of("o_orderkey")).alias("tag"),
        F.col("o_orderdate").alias("committed_at"),
    )


def routed_pages(spark, sf_dir) -> DataFrame:
    """Pages with some hosts that need a route of their own."""
    url = F.regexp_replace("url", r"//[^/]*example\.net", "//www.sciencedirect.com")
    url = F.regexp_replace(url, r"//[^/]*example\.org", "//a.onlinelibrary.wiley.com")
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


def embedding_pages(spark, sf_dir) -> DataFrame:
    """Pages, every third of which embeds a document."""
    tag = F.concat(F.lit('<embed src="/doc/'), text_of("page_id"), F.lit('.pdf">'))
    return table(spark, sf_dir, "pages").select(
        "page_id", "url",
        F.when(F.col("page_id") % 3 == 0, F.concat("html", tag)).otherwise(F.col("html")).alias("html"),
    )

"""One query per operator, over whole supplied tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from checks import views as V
from corpusloom.functions import scalars as S
from corpusloom.functions import text as T
from corpusloom.operators import corpus as C
from corpusloom.operators import documents, graph, link, rank, rules, texts, trees, versions, web

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Corpus ---------------------------------------------------------------------


@query
def corpus_entities(spark, d):
    return C.entities_of(V.records(spark, d)).select(
        "id", "type", F.array_join("access_urls", " ").alias("access_urls"),
        "access_is_list", "page_url",
    )


@query
def corpus_size(spark, d):
    return C.corpus_size(V.entities(spark, d))


@query
def publications(spark, d):
    return C.of_type(V.entities(spark, d), C.PUBLICATION).select("id", "type")


@query
def entity_ids(spark, d):
    return C.with_entity_id(V.entities(spark, d)).select("id", "entity_id")


@query
def access_urls(spark, d):
    return C.access_url(C.entities_of(V.records(spark, d))).select("id", "url")


@query
def duplicate_publications(spark, d):
    found = C.duplicate_publications(C.entities_of(V.records(spark, d)))
    return found.select("entity_id", F.array_join("access_urls", " ").alias("access_urls"))


@query
def page_urls(spark, d):
    return C.page_url(V.entities(spark, d)).select("id", "url")


@query
def non_empty_files(spark, d):
    return C.non_empty(V.files(spark, d))


@query
def files_of_kind(spark, d):
    return C.of_kind(V.files(spark, d), "pdf")


@query
def file_ids(spark, d):
    return C.id_set(V.files(spark, d))


@query
def id_difference(spark, d):
    return C.id_difference(
        C.id_set(V.files_in(spark, d, "pub/pdf")), C.id_set(V.files_in(spark, d, "pub/txt"))
    )


@query
def pending_publications(spark, d):
    return C.pending_publications(V.entities(spark, d), V.files_in(spark, d, "pub/pdf"))


@query
def all_publications(spark, d):
    return C.pending_publications(V.entities(spark, d), V.files_in(spark, d, "pub/pdf"), force=True)


@query
def pending_datasets(spark, d):
    return C.pending_datasets(V.entities(spark, d), V.files_in(spark, d, "dat"))


@query
def finished_publications(spark, d):
    pubs = C.with_entity_id(C.of_type(V.entities(spark, d), C.PUBLICATION))
    done = C.id_set(V.files_in(spark, d, "pub/pdf"))
    return C.finished(pubs, done).select("entity_id")


@query
def worklist(spark, d):
    return C.worklist(pending_publications(spark, d), pending_datasets(spark, d))


@query
def pending_conversions(spark, d):
    return C.pending_conversions(
        V.files_in(spark, d, "pub/pdf"), V.files_in(spark, d, "pub/txt")
    )


@query
def pending_parses(spark, d):
    return C.pending_parses(V.files_in(spark, d, "pub/pdf"), V.files_in(spark, d, "pub/txt"))


@query
def pending_uploads(spark, d):
    done = C.stored_ids(V.files(spark, d), "pdf")
    return C.pending_uploads(V.local_files(spark, d), done, "pdf")


@query
def stored_ids(spark, d):
    return C.stored_ids(V.files(spark, d), "pdf")


@query
def missing_resources(spark, d):
    return C.missing_resources(
        V.entities(spark, d), V.files_in(spark, d, "pub/pdf"), V.files_in(spark, d, "dat")
    )


@query
def resource_stats(spark, d):
    return C.resource_stats(
        V.entities(spark, d), V.files_in(spark, d, "pub/pdf"), V.files_in(spark, d, "dat")
    )


@query
def manifest(spark, d):
    return C.manifest(V.local_files(spark, d), V.files(spark, d), "2020-03-01", "v1")


@query
def manifest_lines(spark, d):
    return C.manifest_lines(manifest(spark, d))


@query
def first_keys(spark, d):
    return C.first_keys(V.files(spark, d)).select("path")


# Scalar functions -------------------------------------------------------------


@query
def url_parts(spark, d):
    return web.url_parts(V.table(spark, d, "pages").select("page_id", "url"))


@query
def file_stems(spark, d):
    path = F.col("path")
    return V.files(spark, d).select(
        "path", S.file_stem(path).alias("stem"), S.key_id(path, "pdf").alias("key_id")
    )


@query
def object_paths(spark, d):
    return V.table(spark, d, "pages").select(
        S.object_path(F.lit("corpus_docs"), F.lit("json"), V.text_of("page_id")).alias("path")
    )


@query
def split_lines(spark, d):
    return texts.split_lines(V.table(spark, d, "documents"))


@query
def stripped_lines(spark, d):
    return V.para_lines(spark, d).select(
        "doc_id", "line_no", T.strip(F.concat(F.lit("　 \t"), "text", F.lit("\xa0 \r"))).alias("text")
    )


@query
def dehyphenated(spark, d):
    joined = F.regexp_replace(F.replace("text", F.lit("e"), F.lit("- ")), "\n", " ")
    return V.table(spark, d, "documents").select("doc_id", T.dehyphenate(joined).alias("text"))


@query
def resource_types(spark, d):
    key = F.col("page_id")
    pages = V.table(spark, d, "pages").select(
        "page_id",
        F.when(key % 4 == 0, "pdf").when(key % 4 == 1, "html").otherwise("unknown").alias("type"),
        F.when(F.length("html") % 2 == 0, "text/html; charset=utf-8")
        .otherwise("application/pdf").alias("content_type"),
    )
    return web.resource_types(pages)


@query
def wrapped_tokens(spark, d):
    return V.table(spark, d, "documents").select(
        "doc_id", S.quoted_token(F.concat(F.lit('"\\'), "text")).alias("token"),
        S.quoted_token(F.concat(F.lit("http://t.test/"), V.text_of("doc_id"))).alias("iri"),
    )


@query
def pdf_flags(spark, d):
    head = F.when(F.col("page_id") % 2 == 0, "%PDF-1.4").otherwise("")
    files = V.table(spark, d, "pages").select(
        V.text_of("page_id").alias("path"), F.concat(head, "html").cast("binary").alias("content")
    )
    return web.pdf_flags(files)


@query
def iso_dates(spark, d):
    return V.table(spark, d, "orders").select(
        "o_orderkey", S.iso_date(F.col("o_orderdate")).alias("day")
    )


@query
def json_documents(spark, d):
    packed = S.to_json_doc(F.struct("url", F.col("html").alias("body")))
    back = S.from_json_doc(packed, "url string, body string")
    return V.table(spark, d, "pages").select("page_id", back.alias("b")).select(
        "page_id", "b.url", "b.body"
    )


# Text -------------------------------------------------------------------------


@query
def paragraphs(spark, d):
    return texts.paragraphs(V.para_docs(spark, d))


@query
def paragraphs_from_lines(spark, d):
    return texts.assemble_paragraphs(V.para_lines(spark, d))


@query
def document_text(spark, d):
    return texts.document_texts(V.para_docs(spark, d)).where("reason is null").select(
        "doc_id", "text"
    )


@query
def document_text_from_lines(spark, d):
    return texts.join_paragraphs(texts.assemble_paragraphs(V.para_lines(spark, d)))


# Trees ------------------------------------------------------------------------


@query
def sections(spark, d):
    return trees.sections(V.elements(spark, d))


@query
def sections_without_preamble(spark, d):
    """The first heading of every page is a paragraph here, and so a preamble."""
    first = F.when(F.col("elem_no") == 0, F.lit("paragraph")).otherwise(F.col("type"))
    return trees.sections(V.elements(spark, d).withColumn("type", first))


@query
def assigned_sections(spark, d):
    return trees.assign_sections(V.elements(spark, d)).select("doc_id", "elem_no", "sec_no")


@query
def sections_with_titles(spark, d):
    numbered = trees.drop_preamble(trees.assign_sections(V.elements(spark, d)))
    return trees.sections_with_titles(
        trees.section_text(numbered), trees.section_titles(numbered)
    )


@query
def text_elements(spark, d):
    return trees.text_elements(V.elements(spark, d), with_lists=False)


@query
def page_text(spark, d):
    return trees.page_text(V.elements(spark, d))


@query
def one_page_text(spark, d):
    return trees.page_text(V.elements(spark, d), 1)


@query
def flatten_tree(spark, d):
    return trees.flatten_tree(V.trees(spark, d)).select(
        "doc_id", F.array_join(F.col("path").cast("array<string>"), ".").alias("path"), "type", "text"
    )


@query
def leaf_text(spark, d):
    return trees.leaf_text(trees.flatten_tree(V.trees(spark, d))).groupBy("type").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")
    )


@query
def node_text(spark, d):
    return trees.node_text(trees.flatten_tree(V.trees(spark, d)))


@query
def tree_elements(spark, d):
    return trees.tree_elements(V.trees(spark, d))


@query
def tree_sections(spark, d):
    return trees.tree_sections(V.trees(spark, d))


@query
def tree_page_text(spark, d):
    return trees.tree_page_text(V.trees(spark, d), 1)


# Key phrases --------------------------------------------------------------------


@query
def candidate_phrases(spark, d):
    return rank.candidate_phrases(V.table(spark, d, "documents"))


@query
def phrase_counts(spark, d):
    return rank.phrase_counts(candidate_phrases(spark, d))


@query
def textrank_docs(spark, d):
    return rank.textrank(V.table(spark, d, "documents"))


@query
def textrank_by_rounds(spark, d):
    """The ranks of ``textrank_docs`` by rounds of joins."""
    toks = rank.default_tokenizer(["doc_id"])(V.table(spark, d, "documents"))
    return rank.textrank_by_rounds(toks, ["doc_id"], 20)


@query
def textrank_sections(spark, d):
    found = trees.sections(V.elements(spark, d))
    return rank.textrank_sections(found)


def _scored(spark, d):
    """Candidate phrases, scored by how often their text occurs in the document."""
    return phrase_counts(spark, d).withColumn("rank_score", F.col("cnt").cast("double"))


@query
def rank_phrases(spark, d):
    return rank.rank_phrases(_scored(spark, d))


@query
def top_phrases(spark, d):
    return rank.top_phrases(_scored(spark, d), 20)


@query
def top_section_phrases(spark, d):
    found = trees.sections(V.elements(spark, d)).select("doc_id", "sec_no", "text")
    keys = ["doc_id", "sec_no"]
    counts = rank.phrase_counts(rank.candidate_phrases(found, keys), keys)
    scored = counts.withColumn("rank_score", F.col("cnt").cast("double"))
    return rank.top_section_phrases(scored, 15)


@query
def unique_phrases(spark, d):
    ranked = candidate_phrases(spark, d).select(
        "doc_id", (F.col("seq") + 1).alias("rk"), "phrase",
        F.length("phrase").cast("long").alias("cnt"), F.col("seq").cast("double").alias("rank_score"),
    )
    return rank.unique_phrases(ranked)


# Graph --------------------------------------------------------------------------


@query
def distinct_triples(spark, d):
    twice = V.triples(spark, d)
    return graph.distinct_triples(twice.unionByName(twice))


@query
def touching(spark, d):
    return graph.touching(V.triples(spark, d), "nation/7").select("s", "p", "o")


@query
def neighbourhood(spark, d):
    return graph.neighbourhood(V.triples(spark, d), "customer/7")


@query
def index_nodes(spark, d):
    return graph.index_nodes(V.triples(spark, d))


@query
def node_edge_tables(spark, d):
    return graph.node_edge_tables(V.triples(spark, d))[1]


@query
def collapsed_edges(spark, d):
    edges = V.triples(spark, d).select(
        "seq", F.split_part("o", F.lit("/"), F.lit(-1)).alias("a"),
        F.substring("s", 1, 22).alias("b"), F.col("s").alias("label"),
    )
    return graph.collapse_edges(edges)


@query
def compact_triples(spark, d):
    return graph.compact_triples(V.triples(spark, d), V.CONTEXT)


@query
def ntriples_lines(spark, d):
    return graph.ntriples_lines(V.triples(spark, d))


@query
def ntriples_parsed(spark, d):
    docs = V.table(spark, d, "documents").select(
        F.concat(F.lit("http://t.test/doc/"), V.text_of("doc_id")).alias("s"),
        F.lit("http://t.test/text").alias("p"), F.concat(F.lit('"\\n'), "text").alias("o"),
    )
    return graph.parse_ntriples(graph.ntriples_lines(docs))


@query
def jsonld_nodes(spark, d):
    return graph.jsonld_nodes(V.triples(spark, d), V.CONTEXT)


# Versions -----------------------------------------------------------------------


@query
def version_history(spark, d):
    return versions.version_history(V.versions(spark, d).select("doc_id", "ver"))


@query
def versions_of(spark, d):
    return versions.versions_of(V.versions(spark, d), 1)


@query
def version_pairs(spark, d):
    return versions.consecutive_versions(V.versions(spark, d))


@query
def version_diff(spark, d):
    return versions.version_diff(V.versions(spark, d))


@query
def line_changes(spark, d):
    """Line by line what became of every text when its words are lines and the first of them moves to the end."""
    return versions.line_changes(V.moved_words(spark, d))


@query
def releases_by_time(spark, d):
    return versions.releases_by_time(V.tags(spark, d))


@query
def latest_release(spark, d):
    return versions.latest_release(V.tags(spark, d))


# Web and rules --------------------------------------------------------------------


@query
def attempt_outcomes(spark, d):
    return web.attempt_outcomes(V.attempts(spark, d))


@query
def links(spark, d):
    return web.extract_links(V.table(spark, d, "pages"))


@query
def first_link(spark, d):
    return web.first_link(V.table(spark, d, "pages"))


@query
def embedded_documents(spark, d):
    return web.embedded_documents(V.embedding_pages(spark, d))


@query
def fetch_routes(spark, d):
    return web.fetch_routes(V.routed_pages(spark, d))


@query
def label_matches(spark, d):
    return rules.label_matches(V.rule_texts(spark, d))


@query
def clean_table(spark, d):
    rows = V.table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        "o_orderpriority", F.lit("x").alias("Unnamed: 0"),
    )
    return rules.clean_table(rows)


# Documents and linking --------------------------------------------------------------


@query
def map_documents(spark, d):
    def count_words(batch: pd.DataFrame) -> pd.DataFrame:
        words = batch["text"].str.split(" ").str.len().astype("int64")
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_words": words})

    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return documents.map_documents(docs, count_words, "doc_id long, n_words long")


@query
def mentions(spark, d):
    return link.mentions(V.table(spark, d, "documents"), V.names(spark, d))


@query
def section_mentions(spark, d):
    found = trees.sections(V.elements(spark, d))
    return link.mentions(found, V.names(spark, d), ["doc_id", "sec_no"])


@query
def top_predictions(spark, d):
    return link.top_predictions(V.predictions(spark, d))


@query
def score_documents(spark, d):
    return link.score_documents(V.predictions(spark, d), V.truth(spark, d))


@query
def score_predictions(spark, d):
    return link.score_predictions(V.predictions(spark, d), V.truth(spark, d))

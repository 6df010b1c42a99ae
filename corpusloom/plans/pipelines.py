"""Whole jobs, put together from the operators. Each returns one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators import corpus, graph, rank, texts, trees
from corpusloom.sinks import writers
from corpusloom.sources import readers


def fetch_plan(
    spark: SparkSession,
    corpus_path: str,
    resources: str,
    force: bool = False,
    with_empty: bool = True,
) -> DataFrame:
    """Corpus file and stored files to the work list of what is still to be fetched.

    A file without a byte counts as there, unless ``with_empty`` is off.
    """
    entities = readers.read_corpus(spark, corpus_path)
    root = resources.rstrip("/")
    pub_files = readers.scan_files(spark, f"{root}/{corpus.PUBLICATION_FOLDER}", "pdf", with_empty=with_empty)
    dat_files = readers.scan_files(spark, f"{root}/{corpus.DATASET_FOLDER}", with_empty=with_empty)
    return corpus.worklist(
        corpus.pending_publications(entities, pub_files, force),
        corpus.pending_datasets(entities, dat_files, force),
    )


def fetch_report(
    spark: SparkSession, corpus_path: str, resources: str, with_empty: bool = True
) -> DataFrame:
    """Per type of entity: records, fetched, missing."""
    root = resources.rstrip("/")
    return corpus.resource_stats(
        readers.read_corpus(spark, corpus_path),
        readers.scan_files(spark, f"{root}/{corpus.PUBLICATION_FOLDER}", "pdf", with_empty=with_empty),
        readers.scan_files(spark, f"{root}/{corpus.DATASET_FOLDER}", with_empty=with_empty),
    )


def text_phrases(
    spark: SparkSession, folder: str, k: int = 20, rounds: int = 20, rebuild: bool = False
) -> DataFrame:
    """Text files to ranked phrases per document.

    ``rebuild`` first puts paragraphs together again, for texts that come as raw
    lines.
    """
    docs = readers.read_texts(spark, folder)
    if rebuild:
        docs = texts.document_texts(docs).select("doc_id", "text")
    return writers.phrase_documents(rank.textrank(docs, k=k, rounds=rounds))


def section_phrases(
    spark: SparkSession, folder: str, k: int = 15, rounds: int = 20
) -> DataFrame:
    """Parse trees to titled sections with their ranked phrases, one row per document."""
    sections = trees.tree_sections(readers.read_parsed_docs(spark, folder))
    phrases = rank.textrank_sections(
        sections, k=k, rounds=rounds, keys=["doc_id", "sec_no"]
    )
    return writers.section_documents(phrases, sections)


def neighbourhood_documents(
    spark: SparkSession, path: str, term: str, context: dict[str, str] | DataFrame
) -> DataFrame:
    """Triples around one entity as compact JSON-LD node objects."""
    near = graph.neighbourhood(readers.read_triples(spark, path), term)
    return graph.jsonld_nodes(near, context)

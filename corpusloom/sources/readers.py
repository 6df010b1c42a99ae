"""Sources S1-S10. Every reader is lazy and leaves column pruning to Spark."""

from __future__ import annotations

import re

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.scalars import read_file_stem
from corpusloom.operators.corpus import entities_of
from corpusloom.operators.graph import FAILFAST, parse_ntriples

TODO_SCHEMA = "type string, entity_id string, url string, path string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ``@graph`` of JSON-LD files, one VARIANT each.

    Only a record has to fit in a VARIANT, so a file may be of any size. A file that is
    cut off or no JSON raises.
    """
    reader = spark.read.schema("`@graph` array<variant>").option("multiLine", True).option("mode", "FAILFAST")
    return reader.json(path).select(F.explode("@graph").alias("record"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Corpus entities of JSON-LD files."""
    return entities_of(read_records(spark, path))


def read_parsed_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Parse trees ``(doc_id, doc)``; the id is the file stem, ``doc`` the pages, one VARIANT each.

    A file may be of any size; one that is cut off or no JSON raises.
    """
    reader = spark.read.schema("pages array<variant>").option("multiLine", True).option("mode", "FAILFAST")
    reader = reader.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    return reader.json(folder).select(read_file_stem().alias("doc_id"), F.col("pages").alias("doc"))


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole text files ``(doc_id, text)``."""
    reader = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True)
    return reader.text(folder, wholetext=True).select(
        read_file_stem().alias("doc_id"), F.col("value").alias("text")
    )


def scan_files(
    spark: SparkSession,
    folder: str,
    ext: str | None = None,
    content: bool = False,
    with_empty: bool = False,
) -> DataFrame:
    """Files with size and time; bytes are read only when ``content`` is asked for.

    Spark's file sources leave out files without a byte. ``with_empty`` adds them,
    for tests that ask whether a file exists at all.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if ext is not None:
        reader = reader.option("pathGlobFilter", f"*.{ext}")
    columns = ["path", "length", "modificationTime"] + (["content"] if content else [])
    files = reader.load(folder).select(*columns)
    if not with_empty:
        return files
    return files.unionByName(empty_files(spark, folder, ext), allowMissingColumns=True)


def _store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", re.sub(r"^s3[an]:", "s3:", uri)))


def file_heads(files: DataFrame, size: int) -> DataFrame:
    """``(path, head)``: the first ``size`` bytes of each file of a listing; fewer if it is shorter.

    The task that holds a path opens it and reads no more than that, so the work grows with the number of
    files, not with what they hold. A null path has a null head; a file that cannot be read raises.
    """

    def head(path: str | None) -> bytes | None:
        if path is None:
            return None
        store, place = _store_of(path)
        with store.open_input_file(place) as f:
            return f.read(size)

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "head": [head(p) for p in batch["path"]]})

    return files.select("path").mapInPandas(run, "path string, head binary")


def _lister(recursive: bool):
    """Entries below each folder of a batch, for ``mapInPandas``."""

    def run(batches):
        for batch in batches:
            for folder in batch["path"]:
                scheme = folder.split("://")[0] + "://" if "://" in folder else ""
                store, path = _store_of(folder)
                found = store.get_file_info(pafs.FileSelector(path, recursive=recursive))
                shown = [f for f in found if not f.base_name.startswith(("_", "."))]
                yield pd.DataFrame(
                    {
                        "path": [scheme + f.path for f in shown],
                        "length": [f.size or 0 for f in shown],
                        "seconds": [int((f.mtime_ns or 0) // 10**9) for f in shown],
                        "is_folder": [f.type == pafs.FileType.Directory for f in shown],
                    }
                ).astype({"path": "object", "length": "int64", "seconds": "int64", "is_folder": "bool"})

    return run


def empty_files(spark: SparkSession, folder: str, ext: str | None = None) -> DataFrame:
    """Files of a folder tree that hold nothing, listed by one task per sub-folder."""
    schema = "path string, length long, seconds long, is_folder boolean"
    top = spark.createDataFrame([(folder,)], "path string").mapInPandas(_lister(False), schema)
    folders = top.where("is_folder").select("path").repartition("path")
    entries = top.unionByName(folders.mapInPandas(_lister(True), schema))
    empty = entries.where("not is_folder and length = 0")
    if ext is not None:
        empty = empty.where(F.col("path").endswith(f".{ext}"))
    return empty.select(
        "path", "length", F.timestamp_seconds("seconds").alias("modificationTime")
    )


def read_todo(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=TODO_SCHEMA)


def list_keys(
    spark: SparkSession,
    uri: str,
    prefix: str = "corpus_docs",
    ext: str | None = None,
    with_empty: bool = False,
) -> DataFrame:
    """Keys below a store URI, without the URI, by prefix and extension."""
    root = uri.rstrip("/")
    plain = F.regexp_replace("path", r"^[A-Za-z0-9+.-]+:/*", "/")
    start = F.lit("/" + root.split(":", 1)[-1].lstrip("/") + "/")
    key = F.when(plain.startswith(start), F.substr(plain, F.length(start) + 1)).otherwise(plain)
    files = scan_files(spark, uri, ext, with_empty=with_empty).select(key.alias("path"), "length", "modificationTime")
    return files.where(F.col("path").startswith(prefix))


def read_triples(spark: SparkSession, path: str, mode: str = FAILFAST) -> DataFrame:
    """Triples of N-Triples files; ``mode`` says what becomes of a line that is none."""
    return parse_ntriples(spark.read.text(path), mode=mode)


def read_context(spark: SparkSession, path: str) -> DataFrame:
    """Prefix map of a vocabulary file as ``(prefix, iri)``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("prefix", "iri")
    )


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Label and regex rules, with their flags, of a parser configuration."""
    reader = spark.read.schema("cleaner array<variant>").option("multiLine", True).option("mode", "FAILFAST")
    step = reader.json(path).select(F.explode("cleaner").alias("step"))
    options = step.where(
        F.try_variant_get("step", "$[0]", "string") == "regex-matcher"
    ).select(F.try_variant_get("step", "$[1]", "variant").alias("o"))
    return options.select(
        F.try_variant_get("o", "$.isCaseSensitive", "boolean").alias("case_sensitive"),
        F.try_variant_get("o", "$.isGlobal", "boolean").alias("all_matches"),
        F.explode(F.try_variant_get("o", "$.queries", "array<variant>")).alias("q"),
    ).select(
        F.try_variant_get("q", "$.label", "string").alias("label"),
        F.try_variant_get("q", "$.regex", "string").alias("regex"),
        "case_sensitive",
        "all_matches",
    )


def read_tables(
    spark: SparkSession, path: str, sep: str = ";", schema: T.StructType | str | None = None
) -> DataFrame:
    """Extracted tables; types are inferred unless a schema is given."""
    if schema is not None:
        return spark.read.csv(path, sep=sep, header=True, schema=schema)
    return spark.read.csv(path, sep=sep, header=True, inferSchema=True)

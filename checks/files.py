"""Queries that pass through files: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.queries import query, textrank_docs, worklist
from corpusloom.operators import corpus as C
from corpusloom.operators import rules, web
from corpusloom.session import shared_folder
from corpusloom.sinks import batches, writers
from corpusloom.sources import readers
from corpusloom.streaming import incremental


@query
def read_corpus(spark, d):
    """One corpus file per type, read as entities."""
    folder = shared_folder(spark, "corpus")
    records = V.records(spark, d).select(
        F.to_json("record").alias("r"),
        F.try_variant_get("record", '$["@type"]', "string").alias("type"),
    )
    whole = records.groupBy("type").agg(
        F.concat(F.lit('{"@graph":['), F.array_join(F.collect_list("r"), ","), F.lit("]}")).alias("value")
    )
    whole.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return readers.read_corpus(spark, folder).select(
        "id", "type", F.array_join("access_urls", " ").alias("access_urls"),
        "access_is_list", "page_url",
    )


@query
def todo_file(spark, d):
    folder = shared_folder(spark, "todo")
    writers.write_todo(worklist(spark, d), folder)
    return readers.read_todo(spark, folder)


@query
def stored_texts(spark, d):
    """The texts of all documents, written twice as the same batch."""
    folder = shared_folder(spark, "texts")
    for _ in range(2):
        writers.write_texts(V.table(spark, d, "documents").select("doc_id", "text"), folder)
    return batches.read_batches(spark, folder).drop("batch")


@query
def stored_phrases(spark, d):
    """Ranked phrases as JSON documents, read back as rows."""
    folder = shared_folder(spark, "phrases")
    nested = writers.phrase_documents(textrank_docs(spark, d))
    writers.write_phrases(nested, folder)
    found = spark.read.schema(nested.schema).json(folder)
    return found.select("doc_id", F.explode("phrases").alias("phrase", "v")).select(
        "doc_id", "phrase", F.col("v.count").alias("cnt"), F.col("v.rank_score").alias("rank_score")
    )


@query
def manifest_file(spark, d):
    folder = shared_folder(spark, "manifest")
    row = C.manifest(V.local_files(spark, d), V.files(spark, d), "2020-03-01", "v1")
    writers.write_manifest(row, folder)
    return spark.read.text(folder)


@query
def triples_file(spark, d):
    folder = shared_folder(spark, "triples")
    writers.write_ntriples(V.triples(spark, d), folder)
    return readers.read_triples(spark, folder)


@query
def jsonld_file(spark, d):
    """Compact node objects of the whole graph."""
    folder = shared_folder(spark, "jsonld")
    writers.write_jsonld(V.triples(spark, d), V.CONTEXT, folder)
    return spark.read.text(folder)


@query
def synced_files(spark, d):
    """The store after the missing files were added, with both counts."""
    folder = shared_folder(spark, "store")
    local = V.local_files(spark, d).select(
        F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1).alias("entity_id"),
        F.regexp_extract("path", r"\.([^.]+)$", 1).alias("kind"), "path",
    )
    done = C.stored_ids(V.files(spark, d), "pdf").withColumn("kind", F.lit("pdf"))
    there, new = writers.sync_missing(local, done, folder, "first")
    return batches.read_batches(spark, folder).select(
        "entity_id", "kind", "path", F.lit(there).alias("there"), F.lit(new).alias("new")
    )


@query
def pdf_heads(spark, d):
    """Files of many pages each, told by their first bytes."""
    folder = shared_folder(spark, "heads")
    bucket = F.col("page_id") % 16
    value = F.concat(F.when(bucket % 2 == 0, "%PDF-1.4").otherwise(""), "html")
    pages = V.table(spark, d, "pages").select("page_id", bucket.alias("bucket"), value.alias("value"))
    in_order = pages.repartition("bucket").sortWithinPartitions("bucket", "page_id")
    in_order.select("value", "bucket").write.partitionBy("bucket").text(folder)
    heads = readers.file_heads(readers.scan_files(spark, folder), 5)
    flags = web.pdf_flags(heads.withColumnRenamed("head", "content"))
    return flags.select(F.regexp_extract("path", r"bucket=(\d+)/", 1).cast("long").alias("bucket"), "is_pdf")


@query
def extracted_tables(spark, d):
    folder = shared_folder(spark, "tables")
    rows = V.table(spark, d, "orders").select(
        F.lit(0).alias("Unnamed: 0"), F.concat(F.lit("o"), V.text_of("o_orderkey")).alias("order"),
        F.nullif("o_orderstatus", F.lit("F")).alias("status"), "o_orderpriority",
    )
    rows.write.csv(folder, sep=";", header=True)
    return rules.clean_table(readers.read_tables(spark, folder))


@query
def incremental_phrases(spark, d):
    """The documents as a stream of files; a second run finds nothing new."""
    folder = shared_folder(spark, "incremental")
    source = f"{d}/documents.parque[t]"  # a file or a folder of files of any name; as a plain path it has to be a folder
    schema = V.table(spark, d, "documents").schema
    process = incremental.phrase_writer(f"{folder}/phrases")
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(source)
        incremental.run_new(stream, f"{folder}/seen", process).awaitTermination()
    return spark.read.parquet(f"{folder}/phrases").drop("batch")

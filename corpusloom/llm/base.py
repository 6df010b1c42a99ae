"""What the operators share: input columns, written tables, components of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import shared_folder

#: White space of the contracts on ``documents``, as one character class.
BLANKS = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, so that no other column can clash; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fold(column: Column, parts: int) -> Column:
    """crc32 of a value's text modulo ``parts``; null for null."""
    return F.crc32(column.cast("string").cast("binary")) % parts


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read on from there, which cuts its lineage."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``edges(a, b)``; the root is the smallest node reachable.

    Alternating large and small stars: each round links the neighbours of a node to the
    smallest of them, larger neighbours first. A round is an aggregation and an equi
    join, both of which combine or split a hot node; the number of rounds grows with
    the logarithm of the longest path. Every round's edges are written to the shared folder.
    """
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                edges.select("a", "a").distinct()
            )
        mark = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a").where("b > a and m < b").select(F.col("m").alias("a"), "b").distinct()
        )
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(
            F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")
        )
        edges = written(small.where("a <> b").distinct(), "edges")

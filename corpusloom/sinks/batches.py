"""Batches of rows that are there once, however often their write is tried (K2, K7).

A batch has a name that its caller gives, the same when the write is run again. Its rows go to a folder of
the batch, which a second try replaces; when they are all there a record of the batch is written.
Readers take only batches with a record. So a job that is lost on its way leaves nothing
that is read, and a write of a batch that has its record does nothing. One writer at a time
may write a batch.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_RECORDS = "_batches"


def records(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``(batch, counts)`` per batch that is complete."""
    schema = "batch string, counts map<string,long>"
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{folder}/{_RECORDS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def counts_of(spark: SparkSession, folder: str, batch: str) -> dict[str, int] | None:
    """What was counted when the batch was written; None if it is not complete."""
    found = records(spark, folder).where(F.col("batch") == f"b-{batch}").take(1)
    return found[0]["counts"] if found else None


def write_batch(
    df: DataFrame, folder: str, batch: str, parts: list[str], seen: Observation
) -> dict[str, int]:
    """Write the rows of a batch, unless it is complete, and return its counts.

    ``seen`` is an observation in the plan of ``df``: its counts are taken by the one job that writes
    and are kept in the batch's record.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch's name is made of letters, digits and . _ -: {batch!r}")
    spark = df.sparkSession
    known = counts_of(spark, folder, batch)
    if known is not None:
        return known
    df.write.mode("overwrite").partitionBy(*parts).parquet(f"{folder}/batch=b-{batch}")
    got = seen.get
    record = spark.createDataFrame([(f"b-{batch}", got)], "batch string, counts map<string,long>")
    record.coalesce(1).write.mode("overwrite").json(f"{folder}/{_RECORDS}/b-{batch}")
    return got


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all complete batches, with ``batch``.

    The records are one small row a batch, so Spark can skip the files of all others.
    """
    return spark.read.parquet(folder).join(records(spark, folder).select("batch").distinct(), "batch", "left_semi")

"""Process only the text files an earlier run has not seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.scalars import read_file_stem
from corpusloom.operators.rank import textrank


def text_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New text files of a folder, one row ``(doc_id, text)`` each."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select(
        read_file_stem().alias("doc_id"), F.col("value").alias("text")
    )


def run_new(
    stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand everything that is new since the last run to ``process``, then stop.

    The checkpoint remembers the files. ``process`` gets a batch number that stays
    the same when a batch is run again after a failure, so that it can replace
    what the failed try wrote.
    """
    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def incremental_texts(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    process: Callable[[DataFrame, int], None],
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process only the text files of a folder that no earlier run has seen."""
    return run_new(text_stream(spark, folder, max_files_per_trigger), checkpoint, process)


def phrase_writer(target: str, k: int = 20, rounds: int = 20) -> Callable[[DataFrame, int], None]:
    """Key phrases of a batch as Parquet, in a folder of the batch.

    A batch that runs again overwrites its own folder, so no row is there twice.
    """

    def process(batch: DataFrame, number: int) -> None:
        phrases = textrank(batch, k=k, rounds=rounds)
        phrases.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return process


def incremental_phrases(
    spark: SparkSession, folder: str, checkpoint: str, target: str, k: int = 20, rounds: int = 20
) -> StreamingQuery:
    """Key phrases of new text files, one folder per batch."""
    return incremental_texts(spark, folder, checkpoint, phrase_writer(target, k, rounds))

"""F1 of the third round, on rows made here."""

import pytest

from checks import files, queries


@pytest.fixture
def tables(spark, tmp_path):
    """``documents`` as a folder of files, as Spark writes it."""
    rows = [(i, f"graph words {i} and the graph of words", "en") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_f1_a_folder_of_files_is_streamed(spark, rows, tables):
    want = queries.textrank_docs(spark, tables).select("doc_id", "phrase")
    assert rows(files.incremental_phrases(spark, tables).select("doc_id", "phrase")) == rows(want)

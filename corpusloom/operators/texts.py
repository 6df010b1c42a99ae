"""Paragraphs and document texts, for whole texts and for tables of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.arrays import let
from corpusloom.operators.running import running_total
from corpusloom.session import spread


def split_lines(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One row per line, numbered from 0."""
    return docs.select(
        key, F.posexplode(T.split_lines(F.col(column))).alias("line_no", "text")
    )


def paragraphs(
    docs: DataFrame, key: str = "doc_id", column: str = "text", keep_tail: bool = False
) -> DataFrame:
    """One row per paragraph of whole texts, worked out inside their rows."""
    parts = T.paragraphs(T.split_lines(F.col(column)), keep_tail)
    return spread(docs).select(key, F.posexplode(parts).alias("par_no", "text"))


def document_texts(
    docs: DataFrame, key: str = "doc_id", column: str = "text", keep_tail: bool = False
) -> DataFrame:
    """Rebuilt text per document and a reason where there is none, worked out inside its row."""
    whole = T.document_text(T.split_lines(F.col(column)), keep_tail)
    # A generator, so that a filter on the result does not rebuild the text.
    parts = let(
        whole,
        lambda t: F.struct(
            t.alias("text"),
            F.when(t.isNull(), "no text").when(t == "", "no paragraph").alias("reason"),
        ),
    )
    return spread(docs).select(key, F.inline(F.array(parts)))


def assemble_paragraphs(
    lines: DataFrame, key: str = "doc_id", keep_tail: bool = False
) -> DataFrame:
    """Paragraphs of a table of lines ``(key, line_no, text)``.

    An empty line closes a paragraph; the number of empty lines before a line is
    its paragraph number. Only the lines of one paragraph meet in one row.
    """
    flagged = lines.withColumn("_line", T.strip(F.col("text"))).withColumn(
        "_blank", (F.col("_line") == "").cast("long")
    )
    numbered = running_total(
        flagged.select(key, "line_no", "_line", "_blank"), [key], "line_no", "_blank", "_closed"
    ).withColumn("par_no", F.col("_closed") - F.col("_blank"))
    grouped = numbered.groupBy(key, "par_no").agg(
        F.max("_blank").alias("_ended"),
        F.sort_array(F.collect_list(F.struct("line_no", "_line"))).alias("_lines"),
    )
    if not keep_tail:
        grouped = grouped.where("_ended = 1")
    joined = F.array_join(F.transform("_lines", lambda x: x["_line"]), " ")
    return grouped.select(key, F.col("par_no").cast("int"), T.dehyphenate(joined).alias("text"))


def join_paragraphs(
    paragraphs: DataFrame, key: str = "doc_id", order: str = "par_no"
) -> DataFrame:
    """Paragraph rows of a document joined by a line break."""
    ordered = F.sort_array(F.collect_list(F.struct(order, "text")))
    return (
        paragraphs.groupBy(key)
        .agg(ordered.alias("_pars"))
        .select(
            key, F.array_join(F.transform("_pars", lambda x: x["text"]), "\n").alias("text")
        )
    )

"""Fetch logs and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import scalars as S

MAX_TRIALS = 3  # fixed value


def attempt_outcomes(
    attempts: DataFrame, max_trials: int = MAX_TRIALS, task: str = "task", order: str = "seq"
) -> DataFrame:
    """One row per task: ``ok``, ``retry`` or ``gave_up``, trials and the last status.

    The last status may be null, as an invalid file is tried again without one.
    """
    folded = attempts.groupBy(task).agg(
        F.bool_or("ok").alias("_ok"),
        F.count("*").alias("trials"),
        F.max_by("status", order).alias("last_status"),
    )
    return folded.select(
        task,
        F.when(F.col("_ok"), "ok")
        .when(F.col("trials") < max_trials, "retry")
        .otherwise("gave_up")
        .alias("outcome"),
        "trials",
        "last_status",
    )


def url_parts(df: DataFrame, column: str = "url") -> DataFrame:
    parts = S.url_parts(F.col(column))
    return df.select("*", parts["scheme"].alias("scheme"), parts["host"].alias("host"),
                     parts["fragment"].alias("fragment"))


def extract_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Absolute links of each page in page order; the first has ``link_no`` 0."""
    return pages.select(
        key, F.posexplode(S.links(F.col("html"), F.col("url"))).alias("link_no", "link")
    )


def first_link(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return pages.select(key, F.get(S.links(F.col("html"), F.col("url")), F.lit(0)).alias("link"))


def embedded_documents(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """URL of the document a page embeds, or the reason why there is none."""
    found = pages.select(key, S.embedded_src(F.col("html"), F.col("url")).alias("src"))
    return found.withColumn("status", F.when(F.col("src").isNull(), "no embedded PDF"))


def fetch_routes(df: DataFrame, column: str = "url") -> DataFrame:
    return df.withColumn("route", S.fetch_route(F.col(column)))


def resource_types(
    df: DataFrame, declared: str = "type", content_type: str = "content_type"
) -> DataFrame:
    return df.withColumn(
        "resource_type", S.resource_type(F.col(declared), F.col(content_type))
    )


def pdf_flags(files: DataFrame) -> DataFrame:
    """Does a stored file begin like a PDF? Only its first bytes are kept."""
    return files.select("path", S.pdf_flag(F.col("content")).alias("is_pdf"))

"""Dataset mentions, predictions and their score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.arrays import let
from corpusloom.session import dealt

def word_array(text: Column) -> Column:
    """Lower-cased words in order, stop words included."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _anchor(first: Column, second: Column) -> Column:
    """Hash of the first two words of a name; a name of one word has an empty second."""
    return F.xxhash64(first, F.coalesce(second, F.lit("")))


def postings(words: Column) -> Column:
    """``array<struct<anchor, at>>``: every anchor of a text at each of its positions."""

    def hits(w: Column) -> Column:
        alone = F.transform(w, lambda x, i: F.struct(_anchor(x, F.lit("")).alias("anchor"), i.alias("at")))
        paired = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
            lambda x, i: F.struct(_anchor(x, F.get(w, i + 1)).alias("anchor"), i.alias("at")),
        )
        return F.concat(alone, paired)

    return let(words, hits)


def mentions(docs: DataFrame, names: DataFrame, keys: list[str] = ["doc_id"]) -> DataFrame:
    """Where the word sequences of ``names(name_id, name)`` occur in ``docs(keys, text)``.

    Texts are an inverted index: every beginning of a name that a text could hold (a
    word alone, two words in a row) is posted, as a hash with its position. Postings
    meet the beginnings of the names by equality, whichever side Spark finds smaller,
    and only hits go on: they come back to their text, which verifies the whole name at each position. So
    no list of names enters the plan and nothing is collected.

    ``n`` counts the positions, overlapping ones too; ``first_pos`` counts words from 0. A
    name without a word is nowhere. Rows that share their keys are texts of their own.
    """
    wanted = names.select("name_id", word_array(F.col("name")).alias("_name")).where("size(_name) > 0").distinct()
    wanted = wanted.withColumn("anchor", _anchor(F.get("_name", F.lit(0)), F.get("_name", F.lit(1))))
    cut = dealt(docs.select(*keys, "text")).select(*keys, word_array(F.col("text")).alias("_words"))
    posted = cut.select(*keys, F.inline(postings(F.col("_words"))))
    # Rows that share their keys share their hits; the text that verifies a position decides.
    hits = posted.join(wanted, "anchor").groupBy(*keys, "name_id", F.col("_name").alias("name")).agg(
        F.collect_set("at").alias("at")
    )
    hits = hits.groupBy(*keys).agg(F.collect_list(F.struct("name_id", "name", "at")).alias("_hits"))
    back = F.lit(True)
    for k in keys:
        back = back & F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}"))
    found = cut.alias("d").join(hits.alias("h"), back).select(*[f"d.{k}" for k in keys], "_words", "_hits")

    def checked(hit: Column) -> Column:
        size = F.size(hit["name"])
        here = F.filter(hit["at"], lambda i: F.slice(F.col("_words"), i + 1, size) == hit["name"])
        return let(
            here,
            lambda h: F.struct(
                hit["name_id"].alias("name_id"),
                F.size(h).cast("long").alias("n"),
                F.array_min(h).alias("first_pos"),
            ),
        )

    return found.select(*keys, F.inline(F.transform("_hits", checked))).where("n > 0")


def top_predictions(
    scores: DataFrame, k: int = 5, doc: str = "doc_id", item: str = "dataset_id"
) -> DataFrame:
    """At most ``k`` datasets per document, best score first, ties by id.

    A dataset predicted twice counts once, with its best score.
    """
    best = scores.groupBy(doc, item).agg(F.max("score").alias("score"))
    ranked = Window.partitionBy(doc).orderBy(F.desc("score"), item)
    return best.withColumn("rk", F.row_number().over(ranked)).where(F.col("rk") <= k)


def score_documents(
    predictions: DataFrame,
    truth: DataFrame,
    k: int = 5,
    doc: str = "doc_id",
    item: str = "dataset_id",
) -> DataFrame:
    """Per document with D true datasets: right ones among the first min(k, D).

    A document nobody predicted for scores 0.
    """
    known = truth.select(doc, item).distinct()
    limits = known.groupBy(doc).agg(F.count("*").alias("d")).withColumn(
        "cut", F.least(F.col("d"), F.lit(k).cast("long"))
    )
    top = top_predictions(predictions, k, doc, item)
    hits = (
        top.join(known, [doc, item], "left_semi")
        .join(limits, doc)
        .where(F.col("rk") <= F.col("cut"))
        .groupBy(doc)
        .agg(F.count("*").alias("hits"))
    )
    n_hits = F.coalesce("hits", F.lit(0)).cast("long")
    return limits.join(hits, doc, "left").select(
        doc, "d", n_hits.alias("hits"), (n_hits / F.col("cut")).alias("share")
    )


def score_predictions(
    predictions: DataFrame,
    truth: DataFrame,
    k: int = 5,
    doc: str = "doc_id",
    item: str = "dataset_id",
) -> DataFrame:
    """Mean share over all documents that have true datasets.

    Shares are added up in whole units of 1e-12, so the mean does not depend on
    the order of the rows.
    """
    shares = score_documents(predictions, truth, k, doc, item)
    cut = F.least(F.col("d"), F.lit(k).cast("long"))
    units = F.call_function("div", F.col("hits") * F.lit(10**12), cut)
    return shares.agg(
        F.count("*").alias("documents"),
        (F.sum(units) / F.count("*") / F.lit(1e12)).alias("score"),
    )

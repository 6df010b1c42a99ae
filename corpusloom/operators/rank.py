"""Key phrases by TextRank (T3, T4) and ranking operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import words
from corpusloom.functions.arrays import let
from corpusloom.functions.ranks import DAMPING_PERCENT, UNITS, chunks, phrases_by_ranks, ranked_phrases, word_blocks
from corpusloom.session import checkpointed, dealt, tasks_for, written

REACH = 3


def _long(value) -> Column:
    return F.lit(value).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def default_tokenizer(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Text stage: ``(keys, text[, lang])`` to ``(keys, toks)``."""

    def run(docs: DataFrame) -> DataFrame:
        lang = F.col("lang") if "lang" in docs.columns else None
        return dealt(docs).select(*keys, words.tokens(F.col("text"), lang).alias("toks"))

    return run


def candidate_phrases(
    docs: DataFrame,
    keys: list[str] = ["doc_id"],
    tokenizer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Candidate phrases in text order: ``(keys, seq, phrase)``."""
    toks = (tokenizer or default_tokenizer(keys))(docs)
    return toks.select(*keys, F.posexplode(words.phrases(F.col("toks"))).alias("seq", "phrase"))


def phrase_counts(candidates: DataFrame, keys: list[str] = ["doc_id"]) -> DataFrame:
    """Nearly all phrases of a document are there once, so they are counted after they are dealt out."""
    return dealt(candidates, *keys, "phrase").groupBy(*keys, "phrase").agg(F.count("*").alias("cnt"))


def unique_phrases(phrases: DataFrame, keys: list[str] = ["doc_id"]) -> DataFrame:
    """The same text keeps its first place and its last value."""
    return (
        dealt(phrases, *keys, "phrase")
        .groupBy(*keys, "phrase")
        .agg(F.min("rk").alias("rk"), F.max_by(F.struct("cnt", "rank_score"), "rk").alias("_v"))
        .select(*keys, "rk", "phrase", "_v.cnt", "_v.rank_score")
    )


def rank_phrases(
    phrases: DataFrame, keys: list[str] = ["doc_id"], score: str = "rank_score"
) -> DataFrame:
    """Number all phrases of a document (or section) by score, ties by text.

    They come from one text cell, which bounds what a window has to sort (it spills
    to disk). For a top-k use ``top_phrases``, which cuts before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(F.desc(score), "phrase")
    return phrases.withColumn("rk", F.row_number().over(window))


def top_phrases(
    phrases: DataFrame, k: int = 20, keys: list[str] = ["doc_id"], score: str = "rank_score"
) -> DataFrame:
    """Spark cuts each task's rows to ``k`` per key before it shuffles them."""
    return rank_phrases(phrases, keys, score).where(F.col("rk") <= k)


def top_section_phrases(
    phrases: DataFrame, k: int = 15, keys: list[str] = ["doc_id", "sec_no"]
) -> DataFrame:
    return top_phrases(phrases, k, keys)


def _finish(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(
        *keys,
        F.col("rk").cast("int").alias("rk"),
        "phrase",
        "cnt",
        (F.col("units") / F.lit(float(UNITS))).alias("rank_score"),
    )


def textrank_in_rows(
    toks: DataFrame, keys: list[str], k: int | None, rounds: int = 20, reach: int = REACH
) -> DataFrame:
    """Rank every document inside its task: no shuffle, whatever the corpus size.

    The word graphs of some documents at a time are arrays of numbers.
    """
    toks = toks.select(*keys, "toks")
    found = ["rk int", "phrase string", "cnt long", "units long"]
    schema = T.StructType([*toks.schema.fields[:-1], *T.StructType.fromDDL(", ".join(found)).fields])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, length in chunks(batch.column("toks")):
                part = batch.slice(at, length)
                doc, rk, phrase, cnt, units = ranked_phrases(part.column("toks"), words.BREAK, k, rounds, reach)
                own = [part.column(i).take(pa.array(doc)) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(rk, pa.int32()), phrase, pa.array(cnt), pa.array(units)], schema.names
                )

    return _finish(toks.mapInArrow(rank, schema), keys)


def _ranked_or_left(
    toks: DataFrame, keys: list[str], k: int | None, rounds: int, reach: int, most: int
) -> DataFrame:
    """Ranked phrases of the documents that are one text of at most ``most`` tokens, and the tokens of all others."""
    texts = toks.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    repeated = written(texts.select(*keys, F.lit(True).alias("repeated")), "repeated")
    # By size, as the table of repeated keys has no row as a rule.
    flagged = toks.select(*keys, "toks").join(repeated, keys, "left")
    left = F.coalesce("repeated", F.lit(False)) | (F.size("toks") > most)
    flagged = flagged.select(*keys, "toks", left.alias("left"))
    found = T.StructType.fromDDL("toks array<string>, rk int, phrase string, cnt long, units long")
    schema = T.StructType([*flagged.schema.fields[:-2], *found.fields])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(batch.column("left"))
            if rest.num_rows:
                none = [pa.nulls(rest.num_rows, t) for t in (pa.int32(), pa.string(), pa.int64(), pa.int64())]
                toks_ = rest.column("toks").cast(pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*rest.columns[: len(keys)], toks_, *none], schema.names)
            batch = batch.filter(pc.invert(batch.column("left")))
            for at, length in chunks(batch.column("toks")):
                part = batch.slice(at, length)
                doc, rk, phrase, cnt, units = ranked_phrases(part.column("toks"), words.BREAK, k, rounds, reach)
                own = [part.column(i).take(pa.array(doc)) for i in range(len(keys))]
                rows = [pa.array(rk, pa.int32()), phrase, pa.array(cnt), pa.array(units)]
                yield pa.RecordBatch.from_arrays([*own, pa.nulls(len(doc), pa.list_(pa.string())), *rows], schema.names)

    return written(flagged.mapInArrow(rank, schema), "ranked")


def _word_blocks(parts: DataFrame, keys: list[str], reach: int, most: int) -> DataFrame:
    """``(keys, block, n, links, out)``, see ``ranks.word_blocks``."""
    found = "block int, n long, links array<array<int>>, out array<struct<to int, words array<int>>>"
    schema = T.StructType([*parts.schema.fields[: len(keys)], *T.StructType.fromDDL(found).fields])
    types = pa.list_(pa.list_(pa.int32())), pa.list_(pa.struct({"to": pa.int32(), "words": pa.list_(pa.int32())}))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in enumerate(batch.column("parts")):
                for block, n, links, out in word_blocks(texts.values, words.BREAK, reach, most):
                    own = [batch.column(i).slice(row, 1) for i in range(len(keys))]
                    rows = [pa.array([block], pa.int32()), pa.array([n]), *map(pa.array, ([links], [out]), types)]
                    yield pa.RecordBatch.from_arrays([*own, *rows], schema.names)

    return parts.mapInArrow(cut, schema)


def _phrases_by_ranks(ranked: DataFrame, keys: list[str], k: int | None) -> DataFrame:
    found = T.StructType.fromDDL("rk int, phrase string, cnt long, units long")
    schema = T.StructType([*ranked.schema.fields[: len(keys)], *found.fields])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (texts, ranks) in enumerate(zip(batch.column("parts"), batch.column("ranks"))):
                rk, phrase, cnt, units = phrases_by_ranks(texts.values, words.BREAK, ranks.values.to_numpy(), k)
                own = [batch.column(i).take(pa.array([row] * len(rk), pa.int32())) for i in range(len(keys))]
                rows = [pa.array(rk, pa.int32()), phrase, pa.array(cnt), pa.array(units)]
                yield pa.RecordBatch.from_arrays([*own, *rows], schema.names)

    return ranked.mapInArrow(score, schema)


def textrank_by_rounds(
    toks: DataFrame,
    keys: list[str],
    k: int | None,
    rounds: int = 20,
    reach: int = REACH,
    cut_every: int = 5,
    most: int = 1 << 12,
) -> DataFrame:
    """The same ranks by joins on (document, block of words), for documents of any size; no row without all its keys.

    Up to ``most`` tokens are one block, whose rounds need nothing from elsewhere, so they run inside a task. A longer
    document, or one of several rows, is cut into blocks of ``most`` words, as they first occur. In every round a block
    sends each block the shares of the words that the two have links with, and only these are shuffled;
    their lineage is cut every ``cut_every`` rounds.
    """
    for key in keys:
        toks = toks.where(F.col(key).isNotNull())
    found = _ranked_or_left(toks, keys, k, rounds, reach, most if rounds > 0 else -1)
    in_tasks = found.where("phrase is not null").select(*keys, "rk", "phrase", "cnt", "units")
    parts = found.where("toks is not null").groupBy(*keys).agg(F.collect_list("toks").alias("parts"))
    blocks = written(_word_blocks(parts, keys, reach, most), "blocks")
    tasks, at = tasks_for(blocks), [*keys, "block"]
    blocks = blocks.repartition(tasks, *at)

    def sent(ranked: DataFrame) -> DataFrame:
        """Shares that a block gets, in the order of the blocks that send them."""
        shares = lambda r: F.transform(
            "out",
            lambda o: F.struct(
                o["to"].alias("to"),
                F.transform(o["words"], lambda w: _div(F.get(r, w), F.size(F.get("links", w)).cast("long"))).alias("shares"),
            ),
        )
        mail = ranked.select(*keys, F.col("block").alias("from"), F.inline(let(F.col("ranks"), shares)))
        mail = mail.withColumnRenamed("to", "block").repartition(tasks, *at)
        return mail.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("from", "shares"))).alias("mail"))

    base = _div(_long(UNITS // 100 * (100 - DAMPING_PERCENT)), F.col("n"))
    start = F.transform("links", lambda _: _div(_long(UNITS), F.col("n")))
    ranked = blocks.withColumn("ranks", start)
    for done in range(1, rounds + 1):
        mail = sent(ranked)
        if done % cut_every == 0:
            mail = checkpointed(mail)
        gained = lambda got: F.transform(
            "links",
            lambda near: base
            + _div(F.aggregate(near, _long(0), lambda s, i: s + F.get(got, i)) * DAMPING_PERCENT, _long(100)),
        )
        got = F.flatten(F.transform("mail", lambda m: m["shares"]))
        ranked = blocks.join(mail, at, "left").withColumn("ranks", let(got, gained)).drop("mail")

    ranks = ranked.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("block", "ranks"))).alias("ranks"))
    ranks = ranks.select(*keys, F.flatten(F.transform("ranks", lambda b: b["ranks"])).alias("ranks"))
    by_rounds = _phrases_by_ranks(parts.join(ranks, keys).select(*keys, "parts", "ranks"), keys, k)
    return _finish(in_tasks.unionByName(by_rounds), keys)


def textrank(
    docs: DataFrame,
    keys: list[str] = ["doc_id"],
    k: int | None = 20,
    rounds: int = 20,
    reach: int = REACH,
    tokenizer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Key phrases of ``docs(keys, text[, lang])`` by a rank over co-occurring words.

    Every document is ranked inside its row, whatever its size; ``textrank_by_rounds`` gives the
    same numbers by joins. A document without phrases gives no rows.
    """
    return textrank_in_rows((tokenizer or default_tokenizer(keys))(docs), keys, k, rounds, reach)


def textrank_sections(
    sections: DataFrame,
    k: int = 15,
    rounds: int = 20,
    keys: list[str] = ["doc_id", "sec_no", "title"],
    **options,
) -> DataFrame:
    """Key phrases of titled sections ``(doc_id, sec_no, title, text[, lang])``."""
    return textrank(sections, keys, k, rounds, **options)

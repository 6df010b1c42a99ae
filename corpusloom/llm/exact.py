"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide.

1. Every document gets the 64-bit fingerprint of its normalised text.
2. Every input partition builds one counting quotient filter for each segment of the
   fingerprint space that it meets, so copies inside a partition become a count.
3. The filters of a segment merge by sorted remainders. A segment holds about
   ``SEGMENT`` fingerprints at any size of the corpus, since their number follows it.
4. Only documents whose fingerprint has a count above one go on to byte verification:
   an aggregation by (fingerprint, normalised bytes), which keeps one copy of a text per
   task before the shuffle, so a hot group costs one row per task.

Null and empty texts are one class. Repeated rows count in ``group_size``; of rows that
share ``doc_id`` and text one is marked as kept. A null ``doc_id`` is the largest. An empty table
gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.base import BLANKS, texts, written
from corpusloom.llm.quotient import QuotientFilter, combined

#: Fingerprints in a segment, on average.
SEGMENT = 1 << 20


def normalised(text) -> F.Column:
    return F.regexp_replace(text, f"[{BLANKS}]+", "")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, n_chars, text_sha256`` of every row."""
    rows = texts(docs).select("doc_id", F.char_length("text").alias("n_chars"), normalised("text").alias("norm"))
    return rows.select(
        "doc_id", F.xxhash64("norm").alias("fp"), "n_chars", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    )


def partition_filters(fingerprints: DataFrame, segment_bits: int) -> DataFrame:
    """``segment, filter`` rows: the filters of every partition of ``fingerprints(fp)``."""
    bits = 64 - segment_bits

    def build(batches):
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            values, counts = combined(np.r_[values, new], np.r_[counts, np.ones(len(new), np.int64)])
        segment = (values >> np.uint64(bits)).astype(np.int64) if segment_bits else np.zeros(len(values), np.int64)
        low = values & np.uint64((1 << bits) - 1)
        for s, a, b in runs(segment):
            data = QuotientFilter.of(low[a:b], counts[a:b], bits).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([data], pa.binary())], ["segment", "filter"])

    return fingerprints.select("fp").mapInArrow(build, "segment long, filter binary")


def runs(keys: np.ndarray):
    """``key, start, end`` of every run of equal sorted keys."""
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
    for a, b in zip(cuts, [*cuts[1:], len(keys)]):
        yield int(keys[a]), a, b


def counted(filters: DataFrame, segment_bits: int, least: int = 2) -> DataFrame:
    """``fp, n`` of the fingerprints that the filters of all partitions hold ``least`` times or more.

    The filters of a segment merge by sorted remainders without loss, and what they hold is read in
    the same step: of two Python steps in a row, each would have a worker of its own in every task.
    """
    bits = 64 - segment_bits

    def read(key, table):
        parts = [QuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()]
        while len(parts) > 1:  # in pairs, so that every entry moves a logarithm of times
            parts = [a.merge(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
        values, counts = parts[0].entries()
        often = counts >= least
        whole = values[often] | np.uint64((key[0].as_py() << bits) & (2**64 - 1))
        return pa.table({"fp": pa.array(whole.view(np.int64)), "n": pa.array(counts[often])})

    return filters.groupBy("segment").applyInArrow(read, "fp long, n long")


def repeated_fingerprints(fingerprints: DataFrame, n: int) -> DataFrame:
    """``fp, n`` of fingerprints that occur more than once among ``n`` rows."""
    segment_bits = max(3, (max(n, 1) // SEGMENT).bit_length())
    return counted(partition_filters(fingerprints, segment_bits), segment_bits)


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chars`` of every row."""
    rows = written(digests(docs), "digests")
    again = written(repeated_fingerprints(rows, rows.count()), "repeated")
    suspects = texts(docs).select(
        "doc_id", F.char_length("text").alias("n_chars"), normalised("text").alias("norm")
    ).withColumn("fp", F.xxhash64("norm"))
    suspects = suspects.join(again.select("fp"), "fp", "left_semi")
    best = F.min_by(F.col("doc_id"), F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id")))
    groups = suspects.groupBy("fp", "norm").agg(F.count("*").alias("group_size"), best.alias("keep_id"), F.max("n_chars").alias("most"))
    groups = groups.select("fp", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "group_size", "keep_id", "most")
    found = rows.join(written(groups, "groups"), ["fp", "text_sha256"], "left")
    single = F.col("group_size").isNull()
    is_best = single | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("most")))
    copy = F.row_number().over(W.partitionBy("doc_id", "text_sha256", "n_chars").orderBy("fp"))
    return found.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (is_best & (copy == 1)).alias("kept"),
        "text_sha256", "n_chars",
    )


def without_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is found again by ``doc_id``, text digest and length; of rows that repeat all
    three the first is kept.
    """
    key = ["__id", "__sha", "__len"]
    no_id = F.lit(-(2**63)).cast("long")
    stay = exact_groups(docs).where("kept").select(
        F.coalesce("doc_id", no_id).alias("__id"), F.col("text_sha256").alias("__sha"), F.col("n_chars").alias("__len")
    )
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({
        "__id": F.coalesce(F.col("doc_id").cast("long"), no_id),
        "__sha": F.sha2(normalised(plain).cast("binary"), 256),
        "__len": F.char_length(plain),
    })
    first = F.row_number().over(W.partitionBy(*key).orderBy(F.lit(0)))
    return keyed.join(stay, key, "left_semi").withColumn("__first", first).where("__first = 1").select(*docs.columns)

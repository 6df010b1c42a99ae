"""Version histories, line differences, releases."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.lines import KINDS, differences
from corpusloom.functions.text import split_lines
from corpusloom.operators.running import next_order, overlapping_ranges, running_total
from corpusloom.session import evened, tasks_for

#: Changes of lines that leave a task at a time.
PER_BATCH = 1 << 16

#: Versions of a key that are compressed together, and bytes of their texts: compression finds what is equal in so many.
PER_FRAME, FRAME = 4, 512 << 10

#: Rows of a batch that are packed or unpacked at a time.
PER_PART = 1 << 10

#: Bytes of texts that are compared at a time.
CHUNK = 1 << 20


def version_history(log: DataFrame, key: str = "doc_id", order: str = "ver") -> DataFrame:
    """All versions of all documents, numbered from 1 in order."""
    counted = log.withColumn("_one", F.lit(1).cast("long"))
    return running_total(counted, [key], order, "_one", "pos").drop("_one")


def versions_of(
    log: DataFrame, document, key: str = "doc_id", order: str = "ver"
) -> DataFrame:
    """Versions of one document in order; no rows for an unknown one."""
    return log.where(F.col(key) == F.lit(document)).orderBy(order)


def consecutive_versions(log: DataFrame, key: str = "doc_id", order: str = "ver") -> DataFrame:
    """``(key, ver, next_ver)`` for every version that has a successor."""
    return (
        next_order(log.select(key, order), [key], order, "next_ver")
        .where(F.col("next_ver").isNotNull())
        .select(key, order, "next_ver")
    )


def version_diff(log: DataFrame, key: str = "doc_id", order: str = "ver") -> DataFrame:
    """Lines of consecutive versions with how often each is kept, removed, added.

    A line counts as often as it occurs, so repeats are matched one to one. Each
    version's lines are counted once, as the left side of the pair it begins and
    as the right side of the pair it ends, and meet in one aggregation.
    """
    pairs = consecutive_versions(log, key, order)
    sides = pairs.select(
        key,
        F.inline(
            F.array(
                F.struct(
                    F.col(order).alias("_at"),
                    F.col(order).alias("_from"),
                    F.col("next_ver").alias("_to"),
                    F.lit(1).alias("_left"),
                ),
                F.struct(
                    F.col("next_ver").alias("_at"),
                    F.col(order).alias("_from"),
                    F.col("next_ver").alias("_to"),
                    F.lit(0).alias("_left"),
                ),
            )
        ),
    )
    texts = log.select(key, F.col(order).alias("_at"), "text")
    lines = texts.join(sides, [key, "_at"]).select(
        key, "_from", "_to", "_left", F.explode(split_lines(F.col("text"))).alias("line")
    )
    counts = lines.groupBy(key, "_from", "_to", "line").agg(
        F.count_if(F.col("_left") == 1).alias("_old"),
        F.count_if(F.col("_left") == 0).alias("_new"),
    )
    old, new = F.col("_old"), F.col("_new")
    kept = F.least(old, new)
    return counts.select(
        key,
        F.col("_from").alias(order),
        F.col("_to").alias("next_ver"),
        "line",
        kept.alias("kept"),
        (old - kept).alias("removed"),
        (new - kept).alias("added"),
    )


def line_changes(log: DataFrame, key: str = "doc_id", order: str = "ver") -> DataFrame:
    """The ordered difference of consecutive versions, one row a line, numbered by ``no`` from 1.

    ``change`` is ``kept``, ``removed`` or ``added``, with the line's number in either version. A line that
    moved is removed in one place and added in another. A null text has no lines. Versions of a key
    are distinct. Texts are compressed, versions of a key that lie side by side together, and shuffled once, by key
    and range of its order; the task that gets them compares neighbours.
    """
    known = log.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(key, order, "text")
    known = evened(known)  # packing and what makes the texts take longer than a shuffle of them
    kinds = {c: log.schema[c].dataType.simpleString() for c in (key, order)}
    placed = overlapping_ranges(known, [key], order, "_again").select(key, order, "_range", "_again", "text")
    held = f"array<struct<`{order}`: {kinds[order]}, _again: boolean, _at: int, _size: int>>"
    packed = placed.mapInArrow(_packed, f"`{key}` {kinds[key]}, _range int, _held {held}, _raw int, _packed binary")
    tasks = tasks_for(known)
    met = packed.repartition(tasks, key, "_range") if tasks else packed.repartition(key, "_range")
    window = Window.partitionBy(key, "_range").orderBy(order)
    sorted_ = met.select(key, "_range", F.inline("_held"), "_raw", "_packed").select(
        key,
        order,
        "_again",
        "_at",
        "_size",
        "_raw",
        "_packed",
        F.row_number().over(window).alias("_row"),
        F.dense_rank().over(window).alias("_version"),
    )
    return sorted_.mapInArrow(
        _compared,
        f"`{key}` {kinds[key]}, `{order}` {kinds[order]}, next_ver {kinds[order]}, no int, change string, old_no int, new_no int, line string",
    )


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(at, PER_PART) for at in range(0, batch.num_rows, PER_PART))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, order, _range, _again, text)``, some of a key and range that follow one another as one row: which
    they are, where in the texts of all each begins and its size, and the size of all and what they are compressed to."""
    codec = _codec()
    for batch in _parts(batches):
        key, order, place, again, text = batch.columns
        text = text.cast(pa.string())
        _, offsets, data = text.buffers()
        ends = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1].tolist()
        first, at, before = [], [], None
        for i, found in enumerate(zip(key.to_pylist(), place.to_pylist())):
            if found != before or i - first[-1] == PER_FRAME or ends[i + 1] - ends[first[-1]] > FRAME:
                first.append(i)
                before = found
            at.append(ends[i] - ends[first[-1]])
        bounds = [*first, len(batch)]
        spans = [(ends[i], ends[j] - ends[i]) for i, j in zip(bounds, bounds[1:])]
        frames = [codec.compress(data.slice(*span) if span[1] else b"", asbytes=True) for span in spans]
        held = [order, again, pa.array(at, pa.int32()), pc.binary_length(text)]
        held = pa.StructArray.from_arrays(held, [batch.schema.names[1], "_again", "_at", "_size"])
        columns = [key.take(pa.array(first)), place.take(pa.array(first)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), held)]
        raw = pa.array([size for _, size in spans], pa.int32())
        yield pa.RecordBatch.from_arrays([*columns, raw, pa.array(frames, pa.binary())], [batch.schema.names[0], "_range", "_held", "_raw", "_packed"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The changes of the pairs of versions in sorted rows, some pairs at a time."""
    codec = _codec()
    for rows, pairs in _neighbours(batches):
        at, size, raw = (rows.column(c).to_pylist() for c in ("_at", "_size", "_raw"))
        packed = rows.column("_packed")

        @lru_cache(maxsize=2)  # a version is the new one of a pair, then the old one
        def text(i: int) -> bytes | None:
            if size[i] is None:
                return None
            return codec.decompress(packed[i].as_buffer(), raw[i], asbytes=True)[at[i] : at[i] + size[i]]

        chunk, texts, most = [], [], 0
        for pair in pairs:
            chunk.append(pair)
            texts += map(text, pair)
            most += sum(size[i] or 0 for i in pair)
            if most >= CHUNK:
                yield from _changes(rows, chunk, texts, most)
                chunk, texts, most = [], [], 0
        if chunk:
            yield from _changes(rows, chunk, texts, most)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[int, int]]]]:
    """Parts of batches, and the places in them of all pairs of rows with consecutive versions of a key.

    The rows of the last two versions of a part go on to the next one. Rows that repeat a version are a
    pair too, as often as rows of that version follow one another.
    """
    rows, done = None, 0
    for batch in chain(_parts(batches), [None]):
        if batch is not None:
            rows = pa.concat_batches([rows, batch]) if rows else batch
        if not rows:
            continue
        first, version, again = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("_row", "_version", "_again"))
        starts = np.append(True, np.diff(version) != 0) | (first == 1)
        starts[0] = True
        begin = np.append(np.flatnonzero(starts), len(starts)).tolist()
        upto = len(begin) - (1 if batch is None else 2)

        def pairs(begin=begin, done=done, upto=upto, first=first, again=again) -> Iterator[tuple[int, int]]:
            for n in range(done, upto):
                here = range(begin[n], begin[n + 1])
                if not again[begin[n]]:
                    for _ in here[1:]:
                        yield from product(here, here)
                if n and first[begin[n]] != 1:
                    yield from product(range(begin[n - 1], begin[n]), here)

        yield rows, pairs()
        if upto:
            rows, done = rows.slice(begin[upto - 1]), 1


def _changes(rows: pa.RecordBatch, pairs: list[tuple[int, int]], texts: list[bytes | None], size: int) -> Iterator[pa.RecordBatch]:
    """The changes of pairs of rows, whose texts are given two and two."""
    cut = pc.split_pattern(pa.array(texts, pa.string() if size < 1 << 30 else pa.large_string()), "\n")
    lines = cut.flatten()
    bounds = np.append(0, np.cumsum(cut.value_lengths().fill_null(0).to_numpy()))
    pair, no, kind, old_no, new_no, place = differences(lines.dictionary_encode().indices.to_numpy(), bounds)
    old, new = np.array(pairs).T
    kinds, names = pa.array(KINDS), [*rows.schema.names[:2], "next_ver", "no", "change", "old_no", "new_no", "line"]
    for at in range(0, len(pair), PER_BATCH):
        part = slice(at, at + PER_BATCH)
        left, right = (pa.array(side[pair[part]]) for side in (old, new))
        numbers = [pa.array(n[part], pa.int32(), mask=n[part] == 0) for n in (old_no, new_no)]
        line = lines.take(pa.array(place[part])).cast(pa.string())
        of_pair = [rows.column(0).take(left), rows.column(1).take(left), rows.column(1).take(right)]
        yield pa.RecordBatch.from_arrays([*of_pair, pa.array(no[part], pa.int32()), kinds.take(pa.array(kind[part])), *numbers, line], names)


def releases_by_time(tags: DataFrame) -> DataFrame:
    return tags.orderBy("committed_at", "tag")


def latest_release(tags: DataFrame) -> DataFrame:
    """The newest tag; of several at one time the last by name."""
    return tags.agg(F.max_by("tag", F.struct("committed_at", "tag")).alias("tag"))

"""Best-fit packing by minimum bin slack.

``plan`` needs only how many pieces there are of each length, at most ``capacity`` numbers,
so it runs on the driver at any size of the corpus. Per bin it takes the longest piece left
and finds, by a subset sum over a bitset, the fullest combination of the lengths that are
left. While the lengths last, the next bin gets the same combination, so it is
taken as often as they allow at once. ``assign`` then deals the pieces of each length to
their places: a piece's rank among those of its length names its bin and offset.

Ranks are numbered inside salted parts of a length, with offsets from the counts of the
parts, so a length that a third of all pieces share is spread over many tasks.

A null text is empty and is one piece of length one, its end id. Repeated rows are
packed as often as they come. An empty table gives no rows. Only ``doc_id`` and ``text`` are
read. A piece that is as long as a bin fills one by itself.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.base import texts, written
from corpusloom.llm.tokens import Encoder

CAPACITY = 2048
#: Pieces in one salted part of a length, on average.
PART = 1 << 17


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """The multiset of available lengths with the largest sum up to ``room``.

    ``lengths`` are those in ``counts``, longest first. Bit s of ``reach`` says that
    some choice of the lengths seen so far sums to s.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


@dataclass
class Plan:
    """Places of the pieces of a length, from the rank ``first`` of that length on."""

    length: np.ndarray
    first: np.ndarray
    per_bin: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    counts = {n: c for n, c in histogram.items() if c > 0}
    if any(n > capacity or n < 1 for n in counts):
        raise ValueError("a piece is longer than a bin or has no length")
    lengths = sorted(counts, reverse=True)
    used = dict.fromkeys(lengths, 0)
    rows, bins = [], 0
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        chosen = [seed, *fullest(counts, lengths, capacity - seed)]
        counts[seed] += 1
        times = {n: chosen.count(n) for n in set(chosen)}
        copies = min(counts[n] // k for n, k in times.items())
        offset = 0
        for n in sorted(times, reverse=True):
            rows.append((n, used[n], times[n], bins, offset))
            offset += n * times[n]
            used[n] += times[n] * copies
            counts[n] -= times[n] * copies
        bins += copies
        if any(not counts[n] for n in times):
            lengths = [n for n in lengths if counts[n]]
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T, bins)


def pieces(docs: DataFrame, path: str, kind: str = "word", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and end id 0."""

    def run(batches):
        for batch in batches:
            rows = []
            encoded = Encoder.of(path, kind).encode(t.as_py() for t in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encoded):
                raw, n = ids.astype("<u4").tobytes() + bytes(4), len(ids) + 1
                for piece, at in enumerate(range(0, n, capacity)):
                    part = raw[4 * at : 4 * (at + capacity)]
                    rows.append((doc, piece, at, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def assign(items: DataFrame, key: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``items(length, ...)`` with ``sequence_id`` and ``offset``; ``key`` orders equal lengths.

    Items that are equal in ``key`` and length must be equal.
    """
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = plan(histogram, capacity)
    parts = max(1, sum(histogram.values()) // PART)
    salted = items.withColumn("__part", F.pmod(F.xxhash64(*key), F.lit(parts)))
    sizes = salted.groupBy("length", "__part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("length", "__part", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.row_number().over(W.partitionBy("length", "__part").orderBy(*key))
    ranked = salted.withColumn("__rank", local - 1).join(sizes, ["length", "__part"])
    ranked = ranked.select(*items.columns, (F.col("__rank") + F.col("__before")).alias("__rank"))

    def place(batches):
        # lengths and ranks as one ascending number: a rank is below 2**48
        starts = (places.length << 48) + places.first
        for batch in batches:
            *columns, rank = batch.columns
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = rank.to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, (length << 48) + rank, side="right") - 1
            copy, slot = np.divmod(rank - places.first[at], places.per_bin[at])
            columns += [pa.array(places.bin[at] + copy), pa.array(places.offset[at] + slot * length)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, kind: str = "word", capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place in it."""
    made = written(pieces(docs, path, kind, capacity), "pieces")
    return assign(made, ["doc_id", "piece", "start", "ids_crc32"], capacity)


def sequences(placed: DataFrame, docs: DataFrame, path: str, kind: str = "word", capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, from ``packed`` and its documents.

    A sequence holds at most ``capacity`` ids, so its group is bounded.
    """

    def run(batches):
        for batch in batches:
            rows = []
            encoded = Encoder.of(path, kind).encode(t.as_py() for t in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encoded):
                ids = np.r_[ids, np.uint32(0)]
                rows += [(doc, i, zlib.crc32(c.tobytes()), c) for i, c in enumerate(ids[a : a + capacity] for a in range(0, len(ids), capacity))]
            columns = list(zip(*rows)) or [()] * 4
            kinds = pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "ids_crc32", "ids"])

    cut = texts(docs).dropDuplicates().mapInArrow(run, "doc_id long, piece int, ids_crc32 long, ids array<long>")
    cut = cut.dropDuplicates(["doc_id", "piece", "ids_crc32"]).withColumn("doc", F.struct("doc_id")).drop("doc_id")
    placed = placed.withColumn("doc", F.struct("doc_id"))
    found = placed.join(cut, ["doc", "piece", "ids_crc32"])
    groups = found.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return groups.select("sequence_id", F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids"))

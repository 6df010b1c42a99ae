"""Near duplicates by SimHash: byte-position inverted index with count filtering.

A fingerprint is eight bytes. If two differ in at most four bits, at least four bytes in
the same positions are equal: the guaranteed minimum of matches. Posting lists of one
positional byte would hold a 256th of all fingerprints each, so the index is keyed by
three positional bytes. Twenty of the 56 position triples suffice: every choice of four
positions contains one of them, so a pair with four matches meets in at least one list.
Inside a list the shared positional bytes of a pair are tallied, pairs with fewer than
four are left out, and the rest are verified by the number of differing bits.

A list keeps only the links of a spanning forest, never all pairs: each fingerprint is
compared with those not reached yet. Lists above ``LIST`` fingerprints leave the task:
two fingerprints differ in at most four bits exactly if some value differs from both in at
most two, so each fingerprint of such a list posts the 529 values around it in its free
bits, and an aggregation links those that meet. Both ways give the same classes.

Fingerprints are distinct in the index; documents join their class afterwards. Null and
empty texts have fingerprint zero. Repeated rows repeat in the result. A null ``doc_id``
never names a class that has another. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.base import components, texts, written

BITS = 4
MATCHES = 8 - BITS
#: Fingerprints of a list that one task compares with one another.
LIST = 4096


def triples() -> list[tuple[int, int, int]]:
    """Twenty triples of the positions 0 to 7 such that any four positions hold one."""
    classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
    inside = [c for c in classes if len(c) == 3]
    across = [(*pair, x) for i in range(3) for pair in combinations(classes[i], 2) for x in classes[(i + 1) % 3]]
    return [tuple(sorted(t)) for t in inside + across]


def fingerprint(text: str, words: int) -> int:
    """A bit is one if it is set in over half the hashes of the word shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: only A-Z change, only the six blanks cut
    if not tokens:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return hashed(b" ".join(tokens), 42)
    hashes = [hashed(s, 42) for s in map(b" ".join, zip(*(tokens[i:] for i in range(words))))]
    ones, step = np.zeros(64, np.int64), 1 << 16
    for at in range(0, len(hashes), step):
        part = np.array(hashes[at : at + step], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp`` of every row."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def postings(distinct: DataFrame) -> DataFrame:
    """``key, fp``: a fingerprint under each of its twenty positional byte triples."""
    keys = []
    for number, triple in enumerate(triples()):
        key = F.lit(number).cast("long")
        for position in triple:
            byte = F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255).cast("long"))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")


def tallied(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which pairs reach the minimum of shared positional bytes and pass the check."""
    apart = one ^ many
    shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    enough = shared >= MATCHES
    enough[enough] = np.bitwise_count(apart[enough]) <= BITS
    return enough


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the fingerprints of one list, each reached once."""
    links, rest, front = [], fps, []
    while len(rest):
        here = front.pop() if front else None
        if here is None:
            here, rest = rest[0], rest[1:]
            if not len(rest):
                break
        hit = tallied(here, rest)
        if hit.any():
            near = rest[hit]
            links += [(here, x) for x in near]
            front += list(near)
            rest = rest[~hit]
    return links


def list_links(sorted_postings: DataFrame) -> DataFrame:
    """Links ``a, b`` inside the lists of postings that are sorted by key."""

    def out(a, b):
        a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def links(keys, fps):
        cuts = np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]
        size = np.diff(cuts)
        pair = cuts[:-1][size == 2]
        hit = pair[tallied(fps[pair], fps[pair + 1])]
        more = [x for at, n in zip(cuts[:-1][size > 2], size[size > 2]) for x in forest(fps[at : at + n])]
        a, b = zip(*more) if more else ((), ())
        return out(np.r_[fps[hit], np.array(a, np.uint64)], np.r_[fps[hit + 1], np.array(b, np.uint64)])

    def run(batches):
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
            fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
            if len(keys):
                open_list = int(np.searchsorted(keys, keys[-1]))
                if open_list:
                    yield links(keys[:open_list], fps[:open_list])
                    keys, fps = keys[open_list:], fps[open_list:]
        if len(keys):
            yield links(keys, fps)

    return sorted_postings.mapInArrow(run, "a long, b long")


def midpoint_links(hot: DataFrame) -> DataFrame:
    """Links of long lists: fingerprints meet at values that differ from each in two bits at most.

    Only bits outside the three bytes that the list shares can differ.
    """
    free = {n: [b for b in range(64) if b // 8 not in t] for n, t in enumerate(triples())}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    flips = F.array(*(
        F.array(*(F.lit(signed(m)) for m in [0] + [1 << b for b in bits] + [1 << a | 1 << b for a, b in combinations(bits, 2)]))
        for bits in free.values()
    ))
    number = F.shiftright("key", 24).cast("int")
    around = hot.select("key", "fp", F.explode(F.element_at(flips, number + 1)).alias("flip"))
    around = around.select("key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    meet = around.groupBy("key", "mid").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b")
    rest = around.join(meet.select("key", "mid", "a"), ["key", "mid"]).select("a", F.col("fp").alias("b"))
    return rest.where("a <> b").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all distinct fingerprints with a path of near pairs."""
    posted = postings(distinct)
    long_lists = posted.groupBy("key").count().where(F.col("count") > LIST).select("key")
    long_lists = written(long_lists, "long-lists")
    short = posted.join(long_lists, "key", "left_anti")
    short = short.repartition("key").sortWithinPartitions("key", "fp")
    found = list_links(short)
    if long_lists.isEmpty():
        return found
    return found.union(midpoint_links(posted.join(long_lists, "key", "left_semi")))


def simhash_groups(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    rows = written(fingerprints(docs, words), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(distinct.select("fp")))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = named.select("fp", F.min("first").over(W.partitionBy("root")).alias("component_id"))
    return rows.join(written(named, "classes"), "fp").select("doc_id", "fp", "component_id")


def without_near_copies(docs: DataFrame, words: int = 4) -> DataFrame:
    """Of each class the row with the smallest ``doc_id``, with all its columns.

    Of rows that repeat that ``doc_id`` the first in the order of their texts is kept. Rows
    without a ``doc_id`` cannot be named by a class and stay.
    """
    stay = simhash_groups(docs, words).select(F.col("component_id").alias("__id")).where("__id is not null").distinct()
    keyed = docs.withColumn("__id", F.col("doc_id").cast("long"))
    first = F.row_number().over(W.partitionBy("__id").orderBy("text"))
    kept = keyed.join(stay, "__id", "left_semi").withColumn("__n", first).where("__n = 1")
    return kept.select(*docs.columns).union(docs.where(F.col("doc_id").cast("long").isNull()))

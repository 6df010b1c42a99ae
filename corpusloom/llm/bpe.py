"""Byte-level BPE by ranks: encoding folds ranked merges, decoding concatenates pieces.

A text is cut into words by the pattern. A word is an array of parts, at first one per byte,
next to an array of what neighbours join to. A fold with Spark's higher-order functions
takes the lowest rank, puts the joined part in the place of its two, and looks up
only its two new neighbourhoods, until no neighbours join. As ids are ranks, a part is its
own rank. The rank map is a literal of the plan: flat arrays in which two parts have one
place, found by arithmetic, since a lookup in a Spark map would read it from its beginning.

Words repeat, so those that occur often in the whole corpus are folded once. A histogram
of the counts gives the lowest count that at most ``WORDS`` words of up to ``LONGEST`` bytes
reach; they are the table that Arrow tasks look words up in, a broadcast with that bound.
All other words are folded in the row of their document by the same fold, so no row is
joined or shuffled and results do not depend on the table. Such a document comes back
from the look-up as the ids between its missing words, one array for each stretch.

A merge copies the arrays of its word. A word above ``LONG_WORD`` bytes is therefore held as blocks of
parts, each with its lowest rank: the leftmost block with the lowest rank is merged together with its
neighbours and cut into blocks again, so a merge copies a few blocks and the list of blocks,
never a long word.

A null or empty text has no ids and decodes to no bytes. Repeated rows repeat. An empty table gives
no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.arrays import let
from corpusloom.llm.base import texts, written

#: After every rank.
NONE = 1 << 40
#: Shifts that are tried for a bucket of joins.
SHIFTS = 1 << 20
#: Bounds of the table of frequent words.
WORDS = 1 << 20
LONGEST = 64
#: Bytes above which a word is long, and parts of a block of a long word.
LONG_WORD = 128
BLOCK = 64
#: Words of the documents that a task looks up at a time; a longer document is looked up alone.
STRETCH = 1 << 18
#: Documents whose words are looked up at a time.
LOOKED_UP = 4096
#: Documents that are put together and decoded at a time.
TOGETHER = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def java_pattern(pattern: str) -> str:
    r"""The pattern for Spark, whose \s means six characters; here it is Unicode white space."""
    inside = pattern.replace(r"[^\s", r"[^\p{IsWhite_Space}").replace(r"(?!\S)", r"(?!\P{IsWhite_Space})")
    return inside.replace(r"\s", r"\p{IsWhite_Space}")


def split_words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), 0)


@dataclass
class Ranks:
    """Literals of the plan: the rank of every byte, and a table of the joins of two parts.

    The table has no two joins in one place: joins that share a bucket share a ``shift``,
    the first one that puts all of them in free places.
    """

    tables: Column
    buckets: int
    places: int

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> "Ranks":
        joins = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    joins[left, right] = rank
        buckets, places = len(joins) // 3 + 1, 2 * len(joins) + 1
        groups: dict[int, list] = {}
        for two in joins:
            groups.setdefault(bucket(*two) % buckets, []).append(two)
        shifts, keys, joined = [0] * buckets, [-1] * places, [-1] * places
        for number, group in sorted(groups.items(), key=lambda g: -len(g[1])):
            for shift in range(SHIFTS):
                at = [place(*two, shift) % places for two in group]
                if len(set(at)) == len(at) and all(keys[i] < 0 for i in at):
                    break
            else:
                raise ValueError("no table for these ranks")
            shifts[number] = shift
            for i, two in zip(at, group):
                keys[i], joined[i] = key(*two), joins[two]
        own = [ranks[bytes([b])] for b in range(256)]
        named = {"bytes": own, "shifts": shifts, "keys": keys, "joined": joined}
        return cls(F.struct(*(numbers(values).alias(name) for name, values in named.items())), buckets, places)

    def join(self, tables: Column, left: Column, right: Column) -> Column:
        """The part that two neighbours join to, ``NONE`` for none; ``tables`` is a variable that holds them."""
        at = place(left, right, F.get(tables["shifts"], bucket(left, right) % self.buckets)) % self.places
        return F.when(F.get(tables["keys"], at) == key(left, right), F.get(tables["joined"], at)).otherwise(F.lit(NONE))


# Of two parts, as numbers or as columns; all stay below 2**63 for ranks below 2**31.


def key(left, right):
    return left * (1 << 31) + right


def bucket(left, right):
    return left * 7919 + right * 104729


def place(left, right, shift):
    return left * 15485863 + right * 32452843 + shift * (left * 6007 + right * 3001 + 1)


def numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def folded(word: Column, ranks: Ranks) -> Column:
    """Ids of one word: ranked merges folded over its bytes.

    The tables are bound to a variable, so that they stand in the plan, and in its text, once.
    """
    return let(ranks.tables, lambda tables: _folded(word, ranks, tables))


def _folded(word: Column, ranks: Ranks, tables: Column) -> Column:
    short = F.octet_length(word.cast("binary")) <= LONG_WORD
    return F.when(short, _folded_whole(word, ranks, tables)).otherwise(_folded_blocks(word, ranks, tables))


def _parts(word: Column, tables: Column) -> Column:
    """One part per byte."""
    latin = F.decode(word.cast("binary"), "ISO-8859-1")
    return let(latin, lambda t: F.transform(positions_of(t), lambda i: F.get(tables["bytes"], F.ascii(F.substr(t, i, F.lit(1))))))


def _folded_blocks(word: Column, ranks: Ranks, tables: Column) -> Column:
    """The same for a long word; ``joins`` is as long as ``parts``, each part's join with the next one."""
    rest = F.lit(1 << 30)

    def blocks(flat: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(flat["parts"]) - 1) / BLOCK).cast("int"))

        def block(i: Column) -> Column:
            cut = lambda a: F.slice(a, i * BLOCK + 1, F.lit(BLOCK))
            return let(cut(flat["joins"]), lambda j: F.struct(F.array_min(j).alias("best"), cut(flat["parts"]).alias("parts"), j.alias("joins")))

        return F.transform(starts, block)

    def merged(flat: Column, at: Column, best: Column) -> Column:
        """``flat`` with the parts at ``at`` and after it joined to ``best``."""
        parts, joins = flat["parts"], flat["joins"]
        before = F.when(at > 0, F.array(ranks.join(tables, F.get(parts, at - 1), best))).otherwise(F.array().cast("array<bigint>"))
        after = F.when(at + 2 < F.size(parts), ranks.join(tables, best, F.get(parts, at + 2))).otherwise(F.lit(NONE))
        return F.struct(
            F.concat(F.slice(parts, F.lit(1), at), F.array(best), F.slice(parts, at + 3, rest)).alias("parts"),
            F.concat(F.slice(joins, F.lit(1), F.greatest(at - 1, F.lit(0))), before, F.array(after), F.slice(joins, at + 3, rest)).alias("joins"),
        )

    def planned(held: Column) -> Column:
        """The place ``low`` of the up to four blocks that the next merge touches, and these blocks after it; -1 for none."""

        def in_four(four: Column, best: Column, k: Column, low: Column) -> Column:
            flat = F.struct(
                F.flatten(F.transform(four, lambda b: b["parts"])).alias("parts"),
                F.flatten(F.transform(four, lambda b: b["joins"])).alias("joins"),
            )
            offset = F.when(k > 0, F.size(F.get(four, F.lit(0))["parts"])).otherwise(F.lit(0))
            inside = F.array_position(F.get(four, k - low)["joins"], best).cast("int") - 1
            after = let(flat, lambda f: let(merged(f, offset + inside, best), blocks))
            return F.struct(low.alias("low"), after.alias("four"))

        def at_block(best: Column, k: Column) -> Column:
            low = F.greatest(k - 1, F.lit(0))
            return let(F.slice(held, low + 1, F.lit(4)), lambda four: in_four(four, best, k, low))

        return let(
            F.transform(held, lambda b: b["best"]),
            lambda found: let(
                F.array_min(found),
                lambda best: F.when(best == NONE, F.struct(F.lit(-1).alias("low"), empty.alias("four"))).otherwise(
                    let(F.array_position(found, best).cast("int") - 1, lambda k: at_block(best, k))
                ),
            ),
        )

    # A transform copies what it gives, so the list of blocks never goes through one: one step plans a
    # merge, which gives a few blocks, and the next step puts them into the list.
    empty = F.array().cast("array<struct<best:bigint,parts:array<bigint>,joins:array<bigint>>>")
    unplanned = F.lit(None).cast("struct<low:int,four:array<struct<best:bigint,parts:array<bigint>,joins:array<bigint>>>>")

    def step(state: Column, _) -> Column:
        held, plan = state["held"], state["plan"]
        replaced = F.concat(F.slice(held, F.lit(1), plan["low"]), plan["four"], F.slice(held, plan["low"] + 5, rest))
        return (
            F.when(plan["low"] < 0, state)
            .when(plan.isNull(), F.struct(held.alias("held"), planned(held).alias("plan")))
            .otherwise(F.struct(replaced.alias("held"), unplanned.alias("plan")))
        )

    joins = lambda p: F.transform(p, lambda x, i: F.when(i + 1 < F.size(p), ranks.join(tables, x, F.get(p, i + 1))).otherwise(F.lit(NONE)))
    start = let(let(_parts(word, tables), lambda p: F.struct(p.alias("parts"), joins(p).alias("joins"))), blocks)
    rounds = F.sequence(F.lit(1), 2 * F.octet_length(word.cast("binary")))
    state = F.struct(start.alias("held"), unplanned.alias("plan"))
    return F.aggregate(rounds, state, step, lambda s: F.flatten(F.transform(s["held"], lambda b: b["parts"])).cast("array<int>"))


def _folded_whole(word: Column, ranks: Ranks, tables: Column) -> Column:
    none = F.array().cast("array<bigint>")
    rest = F.lit(1 << 30)  # longer than any array

    def merged(parts: Column, joins: Column, at: Column, best: Column) -> Column:
        left = F.when(at > 1, F.array(ranks.join(tables, F.get(parts, at - 2), best))).otherwise(none)
        right = F.when(at < F.size(joins), F.array(ranks.join(tables, best, F.get(parts, at + 1)))).otherwise(none)
        return F.struct(
            F.concat(F.slice(parts, F.lit(1), at - 1), F.array(best), F.slice(parts, at + 2, rest)).alias("parts"),
            F.concat(F.slice(joins, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(joins, at + 2, rest)).alias("joins"),
        )

    def step(state: Column) -> Column:
        parts, joins = state["parts"], state["joins"]
        best = F.coalesce(F.array_min(joins), F.lit(NONE))
        place_of = lambda b: F.array_position(joins, b).cast("int")
        return let(best, lambda b: F.when(b == NONE, state).otherwise(let(place_of(b), lambda at: merged(parts, joins, at, b))))

    start = _parts(word, tables)
    pairs = lambda p: F.when(F.size(p) > 1, F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: ranks.join(tables, F.get(p, i - 1), F.get(p, i)))).otherwise(none)
    first = let(start, lambda p: F.struct(p.alias("parts"), pairs(p).alias("joins")))
    rounds = F.sequence(F.lit(1), F.greatest(F.octet_length(word.cast("binary")), F.lit(1)))
    return F.aggregate(rounds, first, lambda s, _: step(s), lambda s: s["parts"].cast("array<int>"))


def positions_of(word: Column) -> Column:
    none = F.array().cast("array<int>")
    return F.when(F.char_length(word) > 0, F.sequence(F.lit(1), F.char_length(word))).otherwise(none)


def vocabulary(docs: DataFrame, pattern: str) -> DataFrame:
    """``word, n`` of all words of all texts."""
    return texts(docs).select(F.explode(split_words(F.col("text"), pattern)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def frequent_words(docs: DataFrame, pattern: str, ranks: Ranks, most: int = WORDS) -> pa.Table:
    """``word, ids`` of the most frequent words, ``most`` or fewer: all above a count."""
    short = F.octet_length("word") <= LONGEST
    words = written(vocabulary(docs, pattern).where(short & (F.col("n") > 1)), "words")
    level = F.least("n", F.lit(1 << 16)).alias("n")  # a table of at most so many rows
    total, bar = 0, (1 << 16) + 1
    for r in sorted(words.select(level).groupBy("n").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["n"]):
        total += r["words"]
        if total > most:
            break
        bar = r["n"]
    spread = words.where(F.col("n") >= bar).repartition("word")
    return spread.select("word", folded(F.col("word"), ranks).alias("ids")).toArrow()


def looked_up(at: np.ndarray, ends: np.ndarray, bounds: np.ndarray, ids: np.ndarray) -> tuple[pa.ListArray, pa.Array]:
    """Ids of documents whose words stand at ``at`` in the table, and the bounds of their missing words.

    A missing word has -1 in ``at``. A document has one array of ids before each missing word and one after the last.
    """
    missing = at < 0
    size = np.where(missing, 0, bounds[at + 1] - bounds[at])
    upto = np.r_[0, np.cumsum(size)]
    place = np.repeat(np.where(missing, 0, bounds[at]) - upto[:-1], size) + np.arange(upto[-1])
    holes = np.flatnonzero(missing)
    begins = np.r_[ends[:-1], holes]
    begins = begins[np.argsort(begins, kind="stable")]  # a document begins before its first missing word
    before = np.r_[0, np.cumsum(missing)][ends]
    inner = pa.ListArray.from_arrays(pa.array(np.r_[upto[begins], upto[-1]].astype(np.int32)), pa.array(ids[place]))
    outer = (before + np.arange(len(ends))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(outer), inner), pa.array(before.astype(np.int32))


def assembled(runs: pa.ListArray, fills: pa.ListArray) -> pa.ListArray:
    """The ids of documents from the ``runs`` of ids between their missing words and the ids of these."""
    sides = []
    for lists in (runs, fills):
        inner = lists.flatten()
        outer, at = (x.offsets.to_numpy().astype(np.int64) for x in (lists, inner))
        sides.append((outer - outer[0], at - at[0], inner.flatten().to_numpy(zero_copy_only=False)))
    (outer, at, values), (gaps, fill_at, fill) = sides
    docs = outer + gaps  # pieces of a document: a run, a word, a run, ...
    size, slots = np.zeros(docs[-1], np.int64), []
    for bounds, offset, sizes in ((outer, 0, np.diff(at)), (gaps, 1, np.diff(fill_at))):
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        slot = docs[owner] + 2 * (np.arange(len(owner)) - bounds[owner]) + offset
        size[slot] = sizes
        slots.append((slot, sizes))
    begin = np.r_[0, np.cumsum(size)]
    ids = np.empty(begin[-1], np.int32)
    for (slot, sizes), start, source in zip(slots, (at, fill_at), (values, fill)):
        ids[np.repeat(begin[slot] - start[:-1], sizes) + np.arange(len(source))] = source
    return pa.ListArray.from_arrays(pa.array(begin[docs].astype(np.int32)), pa.array(ids))


def encoded(docs: DataFrame, path: str, pattern: str, most: int = WORDS) -> DataFrame:
    """``doc_id, ids`` of every row."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), assembled(batch.column(1), batch.column(2))], ["doc_id", "ids"])

    return stretched(docs, path, pattern, most).mapInArrow(run, "doc_id long, ids array<int>")


def stretched(docs: DataFrame, path: str, pattern: str, most: int = WORDS) -> DataFrame:
    """``doc_id, runs, fills`` of every row: ids between the words that no table holds, and the ids of these words."""
    ranks = Ranks.of(read_ranks(path))
    known = frequent_words(docs, pattern, ranks, most)
    words, lists = (pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in known.columns)
    del known
    bounds = lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int32)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
    sent = docs.sparkSession.sparkContext.broadcast((words.cast(pa.string()), bounds - bounds[0], flat))

    def run(batches):
        table, bounds, ids = sent.value
        for batch in (b.slice(a, LOOKED_UP) for b in batches for a in range(0, len(b), LOOKED_UP)):
            lists = batch.column(1)
            inside = lists.flatten().dictionary_encode()
            # the table is sought among the words of the batch, so only these are hashed
            place = pc.fill_null(pc.index_in(table, value_set=inside.dictionary), -1).to_numpy(zero_copy_only=False)
            here = np.flatnonzero(place >= 0)
            known = np.full(len(inside.dictionary), -1, np.int64)
            known[place[here]] = here
            ends = lists.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            cuts = np.r_[np.unique(ends[:-1] // STRETCH, return_index=True)[1], len(batch)]
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                part = inside.slice(ends[a], ends[b] - ends[a])
                at = known[part.indices.to_numpy(zero_copy_only=False)]
                found, missing = looked_up(at, ends[a : b + 1] - ends[a], bounds, ids)
                rest = pa.ListArray.from_arrays(missing, part.dictionary.take(part.indices.filter(pa.array(at < 0))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), found, rest], ["doc_id", "runs", "missing"])
            del lists, inside, part, found, rest
            pa.default_memory_pool().release_unused()

    split = texts(docs).select("doc_id", split_words(F.col("text"), pattern).alias("words"))
    found = split.mapInArrow(run, "doc_id long, runs array<array<int>>, missing array<string>")
    fills = let(ranks.tables, lambda t: F.transform("missing", lambda w: _folded(w, ranks, t)))
    none = F.array().cast("array<array<int>>")
    return found.select("doc_id", "runs", F.when(F.size("missing") == 0, none).otherwise(fills).alias("fills"))


def pieces_of(path: str) -> pa.Array:
    """The bytes of each id."""
    ranks = read_ranks(path)
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pa.array(pieces, pa.large_binary())


def joined(ids: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """The binary pieces of each list of ids, one after another."""
    bounds = ids.offsets.to_numpy()
    taken = pieces.take(ids.flatten())
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][bounds - bounds[0]] if len(taken) else np.zeros(len(bounds), np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets.tobytes()), taken.buffers()[2]]).cast(pa.binary())


def decoded(encoded_rows: DataFrame, path: str) -> DataFrame:
    """The rows with a column ``bytes`` in the place of ``ids``: their binary pieces, one after another."""
    pieces = pieces_of(path)
    at = encoded_rows.columns.index("ids")
    fields = [f for f in encoded_rows.schema.fields if f.name != "ids"]

    def run(batches):
        for batch in batches:
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, joined(batch.column(at), pieces)], [f.name for f in fields] + ["bytes"])

    return encoded_rows.mapInArrow(run, T.StructType([*fields, T.StructField("bytes", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str, most: int = WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids, bytes``: encoded and decoded in one pass; ``ids`` as decimals with commas between."""
    pieces = pieces_of(path)

    def run(batches):
        for batch in (b.slice(a, TOGETHER) for b in batches for a in range(0, len(b), TOGETHER)):
            ids = assembled(batch.column(1), batch.column(2))
            decimals = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.list_value_length(ids).cast(pa.int64()), pc.binary_join(decimals, ","), joined(ids, pieces)],
                ["doc_id", "n_tokens", "ids", "bytes"],
            )

    return stretched(docs, path, pattern, most).mapInArrow(run, "doc_id long, n_tokens long, ids string, bytes binary")

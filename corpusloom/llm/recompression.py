"""Substring dedup by recompression: repeated windows of words, found by symbols that equal passages share.

Every word is a symbol. A round names the runs of equal neighbours, then the pairs of a
symbol of the first kind and one of the second; the kind of a symbol is a bit of its name in that
round. A name is a hash of what it stands for, so every task of every
executor gives one run or pair the same name without a table of names, and equal passages get
equal symbols but for a margin at their ends. Symbols above ``LONG`` words are not
paired any more, so that symbols stay shorter than a window.

With each symbol goes its margin: the span of words on which its name and its bounds depend.
A symbol whose margin lies inside a window stands at the same place in every other occurrence of
that window. So of the symbols with their margin inside, the longest (then the one with the largest
name, then the last) is the same in all occurrences: it reveals the window. Neighbouring windows that
one symbol reveals are one row, with the symbol's name and a hash of all words they span. Windows without such a
symbol (long runs) are rows by the hash of their own words, one for all equal windows of a text.

Rows are counted by name. A name that occurs once belongs to windows that occur once. If all rows of
a name span the same words, all their windows are repeated. If they do not, one row of each span
is cut into its windows, which are verified by 128 bits of their words and counted with
the number of rows that the span has; nothing is compared in pairs.

No join has a hot key: a name that holds more than a ``HOT``-th of the rows (fewer than ``HOT``
names) is sent to the tasks, all others are joined by equality. A text's rows meet in one row whose size is
bounded by the text. Copies of a text share the SHA-256 that stands for it. Nothing of the
corpus reaches the driver but those names.

A null or blank text has no words. Texts shorter than a window lose nothing. Repeated rows are
occurrences of their own, whatever their ids, and repeat in the result; so all windows of a text that occurs
twice are repeated. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import texts, written

WINDOW = 35
ROUNDS = 6
#: Words of a symbol that is still paired.
LONG = 16
#: Names that are sent along hold more than a HOT-th of the rows each.
HOT = 1024
#: Words and windows that are worked on at a time; a longer text is alone.
STRETCH = 1 << 19
#: Outside every window.
OUTSIDE = 1 << 60
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    for shift, times in ((31, _ODD), (29, _MIX)):
        x = (x ^ (x >> np.uint64(shift))) * times
    return x ^ (x >> np.uint64(32))


def named(number: int, *parts: np.ndarray) -> np.ndarray:
    """Names of runs or pairs of a round."""
    name = np.full(len(parts[0]), number, np.uint64)
    for part in parts:
        name = mixed(name * _ODD + part.astype(np.uint64))
    return name


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # of bytes: exactly the six blanks


def digests(words: list[bytes]) -> np.ndarray:
    """128 bits of each word as two numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


@dataclass
class Symbols:
    """Symbols of some texts one after another: names, words ``start`` to ``end``, margins ``low`` to ``high``, texts."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    owner: np.ndarray

    @classmethod
    def of_words(cls, names: np.ndarray, sizes: np.ndarray) -> "Symbols":
        at = np.arange(len(names), dtype=np.int64)
        return cls(names, at, at + 1, at, at + 1, np.repeat(np.arange(len(sizes)), sizes))

    def _widened(self, low, high, before: np.ndarray, after: np.ndarray) -> None:
        """Add the margins of the neighbours before and after the symbols at these places; a text's edge is outside."""
        begins, ends = self.edges()
        for at, edge, step in ((before, begins, -1), (after, ends, 1)):
            inner, outer = at[~edge[at]], at[edge[at]]
            low[inner] = np.minimum(low[inner], self.low[inner + step])
            high[inner] = np.maximum(high[inner], self.high[inner + step])
            (low if step < 0 else high)[outer] = step * OUTSIDE

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a symbol begins and whether it ends its text."""
        new = self.owner[1:] != self.owner[:-1]
        return np.r_[True, new], np.r_[new, True]

    def runs(self, number: int, words: np.ndarray) -> "Symbols":
        """Runs of equal neighbours become one symbol.

        A neighbour is another symbol for certain if its nearest word is not the word that this symbol has
        there; otherwise that depends on all that the neighbour depends on.
        """
        begins, ends = self.edges()
        low, high = np.minimum(self.low, self.start - 1), np.maximum(self.high, self.end + 1)
        last, first = words[self.end - 1], words[self.start]
        alike_before = begins | np.r_[True, last[1:] == last[:-1]]
        alike_after = ends | np.r_[first[1:] == first[:-1], True]
        self._widened(low, high, np.flatnonzero(alike_before), np.flatnonzero(alike_after))
        head = np.flatnonzero(begins | np.r_[True, self.name[1:] != self.name[:-1]])
        tail = np.r_[head[1:], len(self.name)] - 1
        times = tail - head + 1
        name = np.where(times > 1, named(2 * number, self.name[head], times), self.name[head])
        return Symbols(
            name, self.start[head], self.end[tail], np.minimum.reduceat(low, head), np.maximum.reduceat(high, head), self.owner[head]
        )

    def pairs(self, number: int) -> "Symbols":
        """A symbol of the first kind and one of the second after it become one symbol.

        A symbol of the second kind that found no partner before it depends on what is there, one
        of the first kind on what comes after it; nothing else widens a margin.
        """
        _, ends = self.edges()
        kind = mixed(self.name + np.array([number + 1], np.uint64) * _MIX) >> np.uint64(63) == 0
        free = self.end - self.start <= LONG
        first, second = kind & free, ~kind & free
        joins = np.r_[first[:-1] & second[1:] & ~ends[:-1], False]
        joined = np.r_[False, joins[:-1]]
        low, high = self.low.copy(), self.high.copy()
        self._widened(low, high, np.flatnonzero(second & ~joined), np.flatnonzero(first & ~joins))
        a = np.flatnonzero(joins)
        low[a], high[a] = np.minimum(low[a], self.low[a + 1]), np.maximum(high[a], self.high[a + 1])
        name, end = self.name.copy(), self.end.copy()
        name[a], end[a] = named(2 * number + 1, self.name[a], self.name[a + 1]), self.end[a + 1]
        stay = ~joined
        return Symbols(name[stay], self.start[stay], end[stay], low[stay], high[stay], self.owner[stay])


def parsed(words: np.ndarray, sizes: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """The symbols of the last round of texts with ``sizes`` words."""
    found = Symbols.of_words(words, sizes)
    for number in range(rounds if len(words) else 0):
        found = found.runs(number, words).pairs(number)
    return found


def revealing(symbols: Symbols, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all windows, and for each the symbol that reveals it, -1 for none."""
    total = int(sizes.sum())
    fit = np.flatnonzero(symbols.high - symbols.low <= window)
    order = fit[np.lexsort((fit, symbols.name[fit], symbols.end[fit] - symbols.start[fit]))]
    best = np.full(total, -1, np.int64)
    rank = np.arange(len(order))
    first, last = np.maximum(symbols.high[order] - window, 0), symbols.low[order]
    for step in range(window):
        at = first + step
        some = at <= last
        if not some.any():
            break
        np.maximum.at(best, at[some], rank[some])
    whole = np.ones(total, bool)
    ends = np.cumsum(sizes)
    for back in range(1, window):  # the last places of a text begin no window
        whole[ends[sizes >= back] - back] = False
    starts = np.flatnonzero(whole)
    return starts, np.where(best[starts] < 0, -1, order[best[starts]] if len(order) else -1)


def ranges(values: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Where stretches of consecutive values begin over which all of ``same`` are constant; the end comes last."""
    cut = values[1:] != values[:-1] + 1
    for s in same:
        cut |= s[1:] != s[:-1]
    return np.r_[0, np.flatnonzero(cut) + 1, len(values)] if len(values) else np.zeros(1, np.int64)


def stretches(batches) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Neighbouring rows of ``key, text, ...`` of about ``STRETCH`` words in all, and their words."""
    for batch in batches:
        rows, total, start = [], 0, 0
        for i, text in enumerate(batch.column(1)):
            rows.append(words_of(text.as_py()))
            total += len(rows[-1])
            if total >= STRETCH:
                yield batch.slice(start, i + 1 - start), rows
                rows, total, start = [], 0, i + 1
        if rows:
            yield batch.slice(start), rows


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64))


ROWS = "key binary, name long, span long, n long, a int, b int, more array<struct<a: int, b: int>>"
_SPOTS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _rows(keys, owner, name, span, n, a, b, more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(owner, pa.int64())), signed(name), signed(span), pa.array(n, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), more],
        ["key", "name", "span", "n", "a", "b", "more"],
    )


def revealed(keyed: DataFrame, window: int) -> DataFrame:
    """A row for neighbouring windows of a text that one symbol reveals, and one for equal windows that none reveals.

    Windows begin at words ``a`` to ``b``, and in the ranges of ``more``; ``n`` tells how often the row counts.
    """

    def run(batches):
        for batch, rows in stretches(batches):
            sizes = np.array([len(r) for r in rows], np.int64)
            words = digests([w for r in rows for w in r])
            found = parsed(words[:, 0], sizes)
            starts, by = revealing(found, sizes, window)
            ends = np.cumsum(sizes)
            begins = ends - sizes
            cuts = ranges(starts, by)
            first, last, symbol = starts[cuts[:-1]], starts[cuts[1:] - 1] if len(starts) else starts, by[cuts[:-1]]
            some = symbol >= 0
            first, last, symbol = first[some], last[some], symbol[some]
            owner = np.searchsorted(ends, first, side="right")
            hashed = xxhash.xxh3_64_intdigest
            offset = found.start[symbol] - first
            span = [hashed(words[x : y + window], o) for x, y, o in zip(first.tolist(), last.tolist(), offset.tolist())]
            yield _rows(
                batch.column(0), owner, found.name[symbol], np.array(span, np.uint64), np.ones(len(owner)),
                first - begins[owner], last - begins[owner], pa.nulls(len(owner), _SPOTS),
            )
            bare = starts[by < 0]
            for x in range(0, len(bare), STRETCH):
                at = bare[x : x + STRETCH]
                owner = np.searchsorted(ends, at, side="right")
                two = window_hashes(words, at, window)
                order = np.lexsort((at, two[:, 1], two[:, 0], owner))
                at, owner, two = at[order], owner[order], two[order]
                group = ranges(np.arange(len(at)), owner, two[:, 0], two[:, 1])
                cuts = ranges(at, owner, two[:, 0], two[:, 1])
                local = (at - begins[owner]).astype(np.int32)
                spots = pa.StructArray.from_arrays([pa.array(local[cuts[:-1]]), pa.array(local[cuts[1:] - 1])], ["a", "b"])
                head = np.searchsorted(cuts[:-1], group)  # the first range of each group
                lists = pa.ListArray.from_arrays(pa.array(head.astype(np.int32)), spots)
                own = group[:-1]
                yield _rows(batch.column(0), owner[own], two[own, 0], two[own, 1], np.diff(group), local[own], local[own], lists)

    return keyed.select("key", "text").mapInArrow(run, ROWS)


def window_hashes(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """128 bits of the words of each window as two numbers."""
    hashes = b"".join(xxhash.xxh3_128_digest(words[s : s + window]) for s in starts.tolist())
    return np.frombuffer(hashes, "<u8").reshape(-1, 2)


def meet(rows: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` joined with the written ``table``, which has one row for each of ``names`` and the number ``rows`` of rows with it."""
    total = table.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") * HOT > total
    frequent = F.broadcast(table.where(hot).drop("rows"))  # fewer than HOT rows
    rest = rows.join(frequent.select(*names), names, "left_anti").join(table.where(~hot).drop("rows"), names)
    return rows.join(frequent, names).unionByName(rest)


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, key, text``; the key is 128 bits of the text's SHA-256."""
    return texts(docs).select("doc_id", F.unhex(F.substring(F.sha2(F.col("text"), 256), 1, 32)).alias("key"), "text")


def verified(open_rows: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """``key, a, b`` of the repeated windows among rows whose names have several spans."""
    spans = open_rows.groupBy("name", "span").agg(
        F.sum("n").alias("weight"), F.count("*").alias("rows"), F.min(F.struct("key", "a", "b", "more")).alias("one")
    )
    spans = written(spans, "spans")
    by_text = spans.groupBy("one.key").agg(F.collect_list(F.struct("name", "span", "weight", "one.a", "one.b", "one.more")).alias("spans"))
    text = keyed_texts(docs).select("key", "text").join(by_text.select("key"), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    fields = ["name", "span", "weight", "k", "one", "two"]

    def run(batches):
        for batch in batches:
            for text, spans in zip(batch.column(0), batch.column(1)):
                words = digests(words_of(text.as_py()))
                parts = {f: [] for f in fields}
                for s in spans.as_py():
                    spots = [(r["a"], r["b"]) for r in s["more"]] if s["more"] else [(s["a"], s["b"])]
                    at = np.concatenate([np.arange(a, b + 1) for a, b in spots])
                    two = window_hashes(words, at, window)
                    for f, v in zip(fields, (s["name"], s["span"], s["weight"])):
                        parts[f].append(np.full(len(at), v))
                    for f, v in zip(fields[3:], (at - s["a"], two[:, 0], two[:, 1])):
                        parts[f].append(v)
                    if sum(map(len, parts["k"])) >= STRETCH:
                        yield packed(parts)
                        parts = {f: [] for f in fields}
                if parts["k"]:
                    yield packed(parts)

    def packed(parts):
        flat = {f: np.concatenate(v) for f, v in parts.items()}
        columns = [pa.array(flat[f]) for f in fields[:3]] + [pa.array(flat["k"].astype(np.int32))] + [signed(flat[f]) for f in fields[4:]]
        return pa.RecordBatch.from_arrays(columns, fields)

    windows = text.join(by_text, "key").select("text", "spans").mapInArrow(run, "name long, span long, weight long, k int, one long, two long")
    windows = written(windows, "windows")
    counted = windows.groupBy("one", "two").agg(F.sum("weight").alias("n"), F.count("*").alias("rows")).where("n > 1").drop("n")
    again = meet(windows, written(counted, "repeated"), ["one", "two"]).groupBy("name", "span").agg(F.collect_list("k").alias("ks"))
    sizes = spans.select("name", "span", "rows")
    found = meet(open_rows, written(again.join(sizes, ["name", "span"]), "repeated-spans"), ["name", "span"])
    return found.select("key", F.explode(F.transform("ks", lambda k: k + F.col("a"))).alias("a")).select("key", "a", F.col("a").alias("b"))


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, spots``: the ranges of words of a text at which windows begin that also begin elsewhere."""
    rows = written(revealed(keyed_texts(docs), window), "symbols")
    counts = rows.groupBy("name").agg(
        F.sum("n").alias("n"), F.count("*").alias("rows"), (F.min("span") == F.max("span")).alias("same")
    )
    met = written(meet(rows, written(counts.where("n > 1").drop("n"), "shared-names"), ["name"]), "shared-symbols")
    spots = F.coalesce("more", F.array(F.struct("a", "b")))
    equal = met.where("same").select("key", F.inline(spots))
    both = equal.union(verified(met.where("not same"), docs, window))
    return both.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spots"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row: the words outside repeated windows, one space between."""
    spots = written(repeated_windows(docs, window), "repeated-windows")
    joined = keyed_texts(docs).join(spots, "key", "left").select("doc_id", "text", "spots")

    def run(batches):
        for batch in batches:
            sizes, gone, kept = [], [], []
            for text, at in zip(batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                sizes.append(len(words))
                if at.is_valid:
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, at.values.field("a").to_numpy(), 1)
                    np.add.at(step, at.values.field("b").to_numpy() + window, -1)
                    out = np.cumsum(step[:-1]) > 0
                    words = [w for w, x in zip(words, out.tolist()) if not x]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")

"""Ids of a ``tokenizers`` file, with every distinct unit of text encoded once per worker.

A unit is a stretch that the file's own splitting pattern never joins with its
neighbours: a word up to the next white space, with the blank before it, or white
space. Units are cut and hashed for a whole group of texts with numpy; the library
encodes those that a worker has not met. The worker's table is bounded, and a unit that
finds no room in it is encoded again when it is met, so ids never depend on it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer

#: Units a worker keeps.
KEPT = 1 << 19
#: Characters of a group of texts; a longer text is a group of its own.
GROUP = 1 << 17
#: Units of more characters are not looked up by their hash.
LONGEST = 64

#: Unicode's White_Space.
SPACES = np.array([*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
#: Odd factors of the two hashes.
FACTORS = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Encoder:
    _all: dict[tuple[str, str], "Encoder"] = {}

    def __init__(self, path: str, kind: str):
        """kind: "byte" for files that keep white space, "word" for files that drop it."""
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.keeps_space = kind == "byte"
        # what stands between units when several are encoded at once: one token that no unit has
        self.between, self.mark = ("\n", "\n") if self.keeps_space else (" \x01 ", "\x01")
        (self.mark_id,) = self._encode([self.mark])[0]
        self.hashes = np.zeros(0, np.uint64)  # ascending; the others go with it
        self.checks = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.n_ids = 0
        self.powers = [(_powers(f, 1 << 16), _powers(pow(f, -1, 2**64), 1 << 16)) for f in FACTORS]

    @classmethod
    def of(cls, path: str, kind: str) -> "Encoder":
        """The worker's encoder for a file, kept between its tasks."""
        if (path, kind) not in cls._all:
            cls._all[path, kind] = cls(path, kind)
        return cls._all[path, kind]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after another, and how many each has."""
        alone = [i for i, u in enumerate(units) if self.mark in u or u.isspace()]
        apart = set(alone)
        rest = [i for i in range(len(units)) if i not in apart] if alone else range(len(units))
        counts, parts, where = np.zeros(len(units), np.int64), [], []
        for at in range(0, len(rest), 256):
            some = rest[at : at + 256]
            ids = np.array(self._encode([self.between.join([units[i] for i in some])])[0], np.uint32)
            cut = np.flatnonzero(ids == self.mark_id)
            counts[list(some)] = np.diff(np.r_[-1, cut, len(ids)]) - 1
            parts.append(ids[ids != self.mark_id])
            where.append(np.repeat(np.array(list(some)), counts[list(some)]))
        for i in alone:
            ids = np.array(self._encode([units[i]])[0], np.uint32)
            counts[i] = len(ids)
            parts.append(ids)
            where.append(np.full(len(ids), i))
        if not parts:
            return np.zeros(0, np.uint32), counts
        order = np.argsort(np.concatenate(where), kind="stable") if alone else slice(None)
        return np.concatenate(parts)[order], counts

    def cut(self, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the units of texts that begin at ``first``."""
        space = (codes < 0x3001) & np.isin(codes, SPACES) if codes.max(initial=0) > 127 else ((codes == 32) | ((codes >= 9) & (codes <= 13)))
        begins = np.zeros(len(codes) + 1, bool)
        begins[first] = True
        before = np.r_[False, space[:-1]]
        if not self.keeps_space:
            start = ~space & (before | begins[:-1])
            end = ~space & (np.r_[space[1:], True] | begins[1:])
            return np.flatnonzero(start), np.flatnonzero(end) + 1
        after = np.r_[~space[1:], False] & ~begins[1:]  # a word goes on behind this character
        start = begins[:-1] | (space & (~before | after)) | (~space & before & np.r_[False, codes[:-1] != 32])
        starts = np.flatnonzero(start)
        return starts, np.r_[starts[1:], len(codes)] if len(starts) else starts

    def hashed(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        out = []
        for (power, inverse), factor in zip(self.powers, FACTORS):
            total = np.zeros(len(codes) + 1, np.uint64)
            step = len(power)
            np.cumsum(codes.astype(np.uint64) * np.resize(power, len(codes)), out=total[1:])
            # powers start anew every ``step`` characters; a unit across that edge is hashed in two parts
            edge = (starts // step + 1) * step
            head = (total[np.minimum(ends, edge)] - total[starts]) * inverse[starts % step]
            over = np.flatnonzero(ends > edge)
            tail = total[ends[over]] - total[edge[over]]
            head[over] += tail * power[(edge - starts)[over] % step]
            out.append((head ^ (ends - starts).astype(np.uint64)) * np.uint64(factor))
        return out

    def group(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) for t in texts], np.int64)
        offset = np.cumsum(size) - size
        starts, ends = self.cut(codes, offset[size > 0])
        if not len(starts):
            return [np.zeros(0, np.uint32)] * len(texts)
        key, check = self.hashed(codes, starts, ends)
        long = np.flatnonzero(ends - starts > LONGEST)
        keys, at, owner = np.unique(key, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, keys)
        near = np.minimum(place, max(len(self.hashes) - 1, 0))
        known = (self.hashes[near] == keys) & (self.checks[near] == check[at]) if len(self.hashes) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        fresh, counts = self.encode_units([whole[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
        # what does not equal the first unit of its hash in every way is encoded by itself
        other = np.union1d(long, np.flatnonzero(check[at][owner] != check))
        odd, odd_counts = self.encode_units([whole[a:b] for a, b in zip(starts[other].tolist(), ends[other].tolist())])
        table = np.concatenate([self.ids[: self.n_ids], fresh, odd])
        begin, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        begin[known], count[known] = self.starts[near[known]], self.counts[near[known]]
        begin[new], count[new] = self.n_ids + np.cumsum(counts) - counts, counts
        self._keep(keys, check[at], at, starts, ends, new, place, fresh, counts)
        begin, count = begin[owner], count[owner]
        begin[other] = len(table) - len(odd) + np.cumsum(odd_counts) - odd_counts
        count[other] = odd_counts
        upto = np.cumsum(count)
        ids = table[np.repeat(begin - (upto - count), count) + np.arange(upto[-1])]
        cuts = np.r_[0, upto][np.searchsorted(starts, np.r_[offset, len(codes)])]
        return [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def _keep(self, keys, checks, at, starts, ends, new, place, fresh, counts) -> None:
        room = KEPT - len(self.hashes)
        free = self.hashes[np.minimum(place[new], len(self.hashes) - 1)] != keys[new] if len(self.hashes) else np.ones(len(new), bool)
        fits = free & ((ends - starts)[at[new]] <= LONGEST)
        fits &= np.cumsum(fits) <= room
        if not fits.any():
            return
        begin = np.cumsum(counts) - counts
        need = self.n_ids + len(fresh)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n_ids], np.zeros(need, np.uint32)])
        self.ids[self.n_ids : need] = fresh
        add = new[fits]
        self.hashes = np.insert(self.hashes, place[add], keys[add])
        self.checks = np.insert(self.checks, place[add], checks[add])
        self.starts = np.insert(self.starts, place[add], self.n_ids + begin[fits])
        self.counts = np.insert(self.counts, place[add], counts[fits])
        self.n_ids = need

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The unsigned 32-bit ids of each text."""
        for group in grouped(texts):
            yield from self.group(group)


def grouped(texts: Iterable[str], chars: int = GROUP) -> Iterator[list[str]]:
    """Lists of whole texts of about ``chars`` characters; a longer text is alone."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > chars:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group

"""Counting quotient filter: a multiset of 64-bit fingerprints as slots of remainders.

A fingerprint is cut into a quotient, the slot it belongs to, and a remainder, which the
slot holds. Remainders of one quotient form a run of consecutive slots in ascending
order; runs that do not fit at their quotient are shifted to the right, in order. Two bit
vectors say which quotients have a run and where runs end; a third marks slots that
hold the count of the remainder before them. Nothing is lost: the fingerprints come back
from quotient and remainder, so two filters merge by merging their sorted entries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class QuotientFilter:
    bits: int  # of the fingerprint
    quotient_bits: int
    occupied: np.ndarray  # bool, by quotient
    run_end: np.ndarray  # bool, by slot
    is_count: np.ndarray  # bool, by slot
    slots: np.ndarray  # uint64: remainders and counts

    @classmethod
    def of(cls, values: np.ndarray, counts: np.ndarray, bits: int) -> "QuotientFilter":
        """Build from distinct ascending values below 2**bits and their counts."""
        n = len(values)
        q_bits = min(bits, max(1, int(np.ceil(np.log2(max(n, 1) * 4 / 3 + 1)))))
        shift = np.uint64(bits - q_bits)
        quotient = (values >> shift).astype(np.int64) if bits > q_bits else values.astype(np.int64)
        remainder = values & ((np.uint64(1) << shift) - np.uint64(1))
        width = 1 + (counts > 1)
        before = np.cumsum(width) - width
        # a run starts at its quotient or right behind the run before it
        first = np.maximum.accumulate(quotient - before) + before if n else quotient
        last = np.r_[quotient[1:] != quotient[:-1], True] if n else np.zeros(0, bool)
        size = max(1 << q_bits, int(first[-1] + width[-1]) if n else 0)
        occupied = np.zeros(1 << q_bits, bool)
        occupied[quotient] = True
        run_end, is_count = np.zeros(size, bool), np.zeros(size, bool)
        slots = np.zeros(size, np.uint64)
        slots[first] = remainder
        many = counts > 1
        slots[first[many] + 1] = counts[many].astype(np.uint64)
        is_count[first[many] + 1] = True
        run_end[(first + width - 1)[last]] = True
        return cls(bits, q_bits, occupied, run_end, is_count, slots)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct fingerprints in ascending order and their counts."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        starts = np.maximum(quotients, np.r_[0, ends[:-1] + 1]) if len(ends) else quotients
        length = ends - starts + 1
        at = np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(length.sum())
        owner = np.repeat(quotients, length)
        own = ~self.is_count[at]
        slot, owner = at[own], owner[own]
        shift = np.uint64(self.bits - self.quotient_bits)
        values = (owner.astype(np.uint64) << shift) | self.slots[slot]
        nxt = np.minimum(slot + 1, len(self.slots) - 1)
        counted = self.is_count[nxt] & (nxt > slot)
        return values, np.where(counted, self.slots[nxt], np.uint64(1)).astype(np.int64)

    def merge(self, other: "QuotientFilter") -> "QuotientFilter":
        """The filter of both multisets, by merging the sorted entries."""
        (a, m), (b, n) = self.entries(), other.entries()
        return QuotientFilter.of(*combined(np.r_[a, b], np.r_[m, n]), self.bits)

    def to_bytes(self) -> bytes:
        head = np.array([self.bits, self.quotient_bits, len(self.slots)], np.int64).tobytes()
        used = np.packbits(self.occupied), np.packbits(self.run_end), np.packbits(self.is_count)
        return head + b"".join(x.tobytes() for x in used) + self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "QuotientFilter":
        bits, q_bits, size = np.frombuffer(data, np.int64, 3).tolist()
        at, vectors = 24, []
        for n in (1 << q_bits, size, size):
            packed = np.frombuffer(data, np.uint8, (n + 7) // 8, at)
            vectors.append(np.unpackbits(packed, count=n).astype(bool))
            at += (n + 7) // 8
        return cls(bits, q_bits, *vectors, np.frombuffer(data, np.uint64, size, at))


def combined(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order with the sums of their counts."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts

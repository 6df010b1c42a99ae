"""TextRank of the documents of one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Ranks are whole units of 1e-12, so that sums do not depend on their order.
UNITS = 10**12
DAMPING_PERCENT = 85


def chunks(toks: pa.ListArray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of documents in a row with at most ``most`` tokens together; a longer one is alone."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(toks):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, end - at
        at = end


def _links(ids: np.ndarray, doc: np.ndarray, n: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Both ends of every link between two words at most ``reach`` apart, in order, each once."""
    pairs = [np.empty(0, np.int64)]
    for d in range(1, reach + 1):
        a, b = ids[:-d], ids[d:]
        near = (doc[:-d] == doc[d:]) & (a != b)
        pairs += [a[near] * n + b[near], b[near] * n + a[near]]
    pairs = np.sort(np.concatenate(pairs))
    first = np.ones(len(pairs), bool)
    first[1:] = pairs[1:] != pairs[:-1]
    return np.divmod(pairs[first], max(n, 1))


def _ranks(ids: np.ndarray, node_doc: np.ndarray, doc: np.ndarray, rounds: int, reach: int) -> np.ndarray:
    """Rank units of every node after the given number of rounds."""
    n = len(node_doc)
    size = np.bincount(node_doc)[node_doc]
    source, target = _links(ids, doc, n, reach)
    degree = np.bincount(source, minlength=n)
    linked = degree > 0
    starts = (np.cumsum(degree) - degree)[linked]
    base = UNITS // 100 * (100 - DAMPING_PERCENT) // size
    ranks = UNITS // size
    for _ in range(max(rounds, 1)):
        share = ranks // np.maximum(degree, 1)
        total = np.zeros(n, np.int64)
        if len(starts):
            total[linked] = np.add.reduceat(share[target], starts)
        ranks = base + total * DAMPING_PERCENT // 100
    return ranks


def _kept_words(toks: pa.ListArray, break_: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.StringArray, int]:
    """Of every kept word: whether it opens a phrase, its token array, its code and its text; and the number of codes."""
    words = toks.flatten()
    coded = words.dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(toks), dtype=np.int64), lengths)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kept = code != pc.index(coded.dictionary, break_).as_py()
    # A word opens a phrase at the start of its document and after a break.
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | ~kept[:-1]
    return head[kept], doc[kept], code[kept], words.filter(pa.array(kept)), max(len(coded.dictionary), 1)


def _best(
    head: np.ndarray, doc: np.ndarray, words: pa.StringArray, ranks: np.ndarray, k: int | None
) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``doc, rk, phrase, cnt, units`` of the best ``k`` phrases of each document, from the ranks of its words."""
    at = np.flatnonzero(head)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, words, none, none
    lengths = np.diff(at, append=len(doc))
    units = np.add.reduceat(ranks, at) // lengths
    runs = pa.ListArray.from_arrays(pa.array([*at, len(doc)], pa.int32()), words)
    phrases = pc.binary_join(runs, " ").dictionary_encode()
    in_order = pc.sort_indices(phrases.dictionary).to_numpy()
    place = np.empty(len(in_order), np.int64)
    place[in_order] = np.arange(len(in_order))
    found, first, cnt = np.unique(
        doc[at] * len(place) + place[phrases.indices.to_numpy()], return_index=True, return_counts=True
    )
    found_doc, phrase = np.divmod(found, len(place))
    best = np.lexsort((-units[first], found_doc))
    rk = np.arange(1, len(best) + 1) - np.searchsorted(found_doc, found_doc[best])
    if k is not None:
        best, rk = best[rk <= k], rk[rk <= k]
    return found_doc[best], rk, phrases.dictionary.take(pa.array(in_order[phrase[best]])), cnt[best], units[first][best]


def ranked_phrases(
    toks: pa.ListArray, break_: str, k: int | None, rounds: int, reach: int
) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``doc, rk, phrase, cnt, units`` of the best ``k`` phrases of each token array, in rank order."""
    head, doc, code, words, codes = _kept_words(toks, break_)
    nodes, ids = np.unique(doc * codes + code, return_inverse=True)
    ranks = _ranks(ids, nodes // codes, doc, rounds, reach) if len(nodes) else nodes
    return _best(head, doc, words, ranks[ids], k)


def _numbers(code: np.ndarray) -> np.ndarray:
    """Words of one document, numbered as they first occur, so that words near each other have near numbers."""
    _, first, ids = np.unique(code, return_index=True, return_inverse=True)
    number = np.empty(len(first), np.int64)
    number[np.argsort(first)] = np.arange(len(first))
    return number[ids]


def word_blocks(
    parts: pa.ListArray, break_: str, reach: int, most: int
) -> Iterator[tuple[int, int, list[np.ndarray], list[dict]]]:
    """``block, words of the document, links, out`` of every ``most`` words of one document, whose texts are ``parts``.

    ``out`` has the words of the block that a block ``to`` has links with. What a block gets from all blocks, itself
    included, in their order, are the words that it has links with, in order; ``links`` of a word are places there.
    """
    _, part, code, _, _ = _kept_words(parts, break_)
    ids = _numbers(code)
    n = int(ids.max(initial=-1)) + 1
    source, target = _links(ids, part, n, reach)
    ends = np.searchsorted(source, np.arange(n + 1))
    for start in range(0, n, most):
        end = min(start + most, n)
        s, t = source[ends[start] : ends[end]], target[ends[start] : ends[end]]
        needed = np.unique(t)
        links = np.split(np.searchsorted(needed, t), ends[start + 1 : end] - ends[start])
        to, word = np.divmod(np.unique(t // most * n + s), n)
        blocks, at = np.unique(to, return_index=True)
        out = [{"to": int(b), "words": w} for b, w in zip(blocks, np.split(word - start, at[1:]))]
        yield start // most, n, links, out


def phrases_by_ranks(
    parts: pa.ListArray, break_: str, ranks: np.ndarray, k: int | None
) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``rk, phrase, cnt, units`` of one document, whose words have these ranks in the order of their numbers."""
    head, part, code, words, _ = _kept_words(parts, break_)
    return _best(head, np.zeros_like(part), words, ranks[_numbers(code)], k)[1:]

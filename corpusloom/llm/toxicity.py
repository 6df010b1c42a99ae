"""Toxic passages: all maximal scoring segments of a text under token log-odds.

Every token has a log-odds of toxic against other text with an informative Dirichlet
prior: the counts of both classes are smoothed by the counts of both together. A token
that is too rare to be significant (by its z-score) falls back on its first five, then
four letters, so that inflected and compound words count; what is not significant then
is neutral and costs ``DRIFT``. A linear scan finds all maximal scoring segments of a text. By
extreme-value theory, a text of n tokens without toxicity has K n exp(-lambda S) segments
of score S or more, where lambda follows from the scores of ordinary tokens and K from the
segments of ordinary texts. A segment with fewer than ``EXPECTED`` such is significant. Evidence
of a text is the sum of lambda S - ln(K n) over its significant segments, or that of the
best one, and a logistic curve turns it into a score.

Fitting uses at most ``ROWS`` labelled rows, by a hash of ``doc_id``, of which near copies
count once, and keeps the ``TOKENS`` most significant tokens; scoring reads every token of
every text.

A null or empty text has no tokens and the score of no evidence. A row without ``doc_id``
or label is not learned from. If a label is missing from the sample, all texts get
the share of toxic rows. An empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import fold, texts, written
from corpusloom.llm.language import by_batches

#: Bounds of the fit.
ROWS = 20_000
TOKENS = 50_000
#: z-score from which a token counts, share of the prior in all counts, cost of a neutral token.
SIGNIFICANT = 3.5
PRIOR = 0.1
DRIFT = 0.25
#: Letters of the beginnings that stand in for rare words.
STEMS = (5, 4)
#: Expected number of segments by chance below which a segment is significant.
EXPECTED = 0.05

WORD = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(text: str) -> set[str]:
    """Words and their beginnings; beginnings are marked, as no word has a tilde."""
    words = set(tokens(text))
    return words.union(*({"~" + w[:n] for w in words if len(w) > n} for n in STEMS))


def sketch(text: str) -> int:
    """The smallest hash of three words in a row, which near copies mostly share."""
    words = tokens(text)
    return min((xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1


def segments(places: list[int], weights: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: first token, end, score.

    ``places`` and ``weights`` are the tokens with a weight of their own; any other token
    costs ``drift``. The list of candidates with the sums before and after each is the
    linear-time method of Ruzzo and Tompa (1999).
    """
    found: list[list] = []  # first, end, sum before, sum after, index of the last candidate with a smaller sum before
    total, last = 0.0, -1
    for place, weight in zip(places, weights):
        total -= drift * (place - last - 1)
        before, total, last = total, total + weight, place
        if weight <= 0:
            continue
        new = [place, place + 1, before, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            new[4] = j
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


@dataclass
class Model:
    weights: dict[str, float]
    rate: float  # lambda
    spread: float  # K
    slope: float
    offset: float
    constant: float | None = None

    def __post_init__(self):
        self.stems = [(n, {k[1:]: w for k, w in self.weights.items() if k[0] == "~" and len(k) == n + 1}) for n in STEMS]

    def found(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        words = tokens(text)
        get, places, weights = self.weights.get, [], []
        (n, long), (m, short) = self.stems
        for i, word in enumerate(words):
            weight = get(word)
            if weight is None and (part := word[:n]) in long and len(word) > n:
                weight = long[part]
            elif weight is None and (part := word[:m]) in short and len(word) > m:
                weight = short[part]
            if weight is not None:
                places.append(i)
                weights.append(weight)
        return segments(places, weights, DRIFT), len(words)

    def judged(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The score, and the significant segments: first token, end, expected number by chance."""
        parts, n = self.found(text)
        chance = [(a, b, float(self.spread * n * np.exp(-self.rate * s))) for a, b, s in parts]
        passages = [x for x in chance if x[2] <= EXPECTED]
        if self.constant is not None:
            return self.constant, passages
        x = self.slope * evidence(self, [s for _, _, s in parts], n) + self.offset
        return float(1 / (1 + np.exp(-x))), passages


def evidence(model: Model, scores: list[float], n: int) -> float:
    """Of the scores of all segments of a text of n tokens."""
    each = [model.rate * s - np.log(max(model.spread * n, 1e-300)) for s in scores]
    strong = [e for e in each if e >= -np.log(EXPECTED)]
    return min(max(float(sum(strong)) if strong else max(each, default=0.0), 0.0), 50.0)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of labelled rows outside the held-out fold, ``ROWS`` or about as many."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(ROWS)
    return texts(docs).join(F.broadcast(drawn), "doc_id")  # of ROWS rows at most


def token_counts(rows: DataFrame) -> DataFrame:
    """``token, n1, n0``: documents of either label that hold a token; near copies count once."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # the tokens of few documents at a time
                yield act(whole.slice(at, 256))

    def act(batch):
        docs = batch.column(1).to_pylist()
        return pa.RecordBatch.from_arrays([batch.column(2), pa.array(map(sketch, docs), pa.int64()), pa.array([list(features(t)) for t in docs], pa.list_(pa.string()))], ["toxic", "sketch", "tokens"])

    found = rows.mapInArrow(run, "toxic int, sketch long, tokens array<string>").dropDuplicates(["toxic", "sketch"])
    return found.select("toxic", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("toxic").cast("double").alias("n1"), F.sum(1 - F.col("toxic")).cast("double").alias("n0")
    )


def token_weights(counts: DataFrame) -> DataFrame:
    """``token, weight, z, n1, n0`` of the tokens with significant log-odds."""
    sums = counts.agg(F.sum("n1").alias("a"), F.sum("n0").alias("b")).first()
    one, none = float(sums["a"] or 0), float(sums["b"] or 0)
    weight = PRIOR * (one + none)
    prior = F.lit(PRIOR) * (F.col("n1") + F.col("n0"))
    y1, y0 = F.col("n1") + prior, F.col("n0") + prior
    odds = F.ln(y1 / (one + weight - y1)) - F.ln(y0 / (none + weight - y0))
    z = odds / F.sqrt(1 / y1 + 1 / y0)
    rows = counts.select("token", odds.alias("weight"), z.alias("z"), "n1", "n0").where(F.abs("z") >= SIGNIFICANT)
    return rows.orderBy(F.desc(F.abs("z")), "token").limit(TOKENS)


def decay(weights: np.ndarray, shares: np.ndarray) -> float:
    """lambda: where the mean of exp(lambda s) over ordinary tokens is one."""
    rest = max(1 - shares.sum(), 0.0)
    excess = lambda x: (shares * np.exp(np.minimum(x * weights, 700))).sum() + rest * np.exp(-x * DRIFT) - 1
    low, high = 1e-3, 1e-3
    while excess(high) < 0 and high < 50:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled(docs, labels).select("doc_id", "text", "toxic").persist()
    try:
        sums = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        if not sums.get(0) or not sums.get(1):
            share = sums.get(1, 0) / max(1, sum(sums.values()))
            return Model({}, 1.0, 1.0, 0.0, 0.0, share)
        counts = written(token_counts(rows), "tokens")
        found = token_weights(counts).collect()
        weight = {r["token"]: r["weight"] for r in found}
        ordinary = counts.agg(F.sum("n0")).first()[0] or 1.0
        shares = np.array([(r["n0"] + 0.5) / ordinary for r in found])
        model = Model(weight, decay(np.array([r["weight"] for r in found]), shares), 1.0, 1.0, 0.0)
        best = best_segments(rows, model).collect()
    finally:
        rows.unpersist()
    # K: segments that ordinary texts have above a low score, over those expected for K = 1
    calm = [r for r in best if not r["toxic"]]
    bar = float(np.median([w for w in weight.values() if w > 0])) if any(w > 0 for w in weight.values()) else 1.0
    n = sum(r["n"] for r in calm)
    over = sum(1 for r in calm for s in r["scores"] if s >= bar)
    model.spread = (over + 0.5) / max(n * np.exp(-model.rate * bar), 1e-12)
    found = np.array([evidence(model, r["scores"], r["n"]) for r in best])
    model.slope, model.offset = logistic(found, np.array([r["toxic"] for r in best], float))
    return model


def best_segments(rows: DataFrame, model: Model) -> DataFrame:
    """``toxic, n, scores`` of the rows of the sample: their tokens and the scores of their segments."""

    def act(batch):
        got = [model.found(t) for t in batch.column(1).to_pylist()]
        scores = [[s for _, _, s in parts] for parts, _ in got]
        return pa.RecordBatch.from_arrays([batch.column(2), pa.array([n for _, n in got], pa.int64()), pa.array(scores, pa.list_(pa.float64()))], ["toxic", "n", "scores"])

    return by_batches(rows, act, "toxic int, n long, scores array<double>")


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method with a light penalty."""
    slope, offset = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([(x * (p - y)).sum() + 1e-3 * slope, (p - y).sum() + 1e-3 * offset])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, passages`` of every row; passages are word positions and their chance."""

    def act(batch):
        got = [model.judged(t) for t in batch.column(1).to_pylist()]
        spans = [[{"start": a, "end": b, "chance": c} for a, b, c in parts] for _, parts in got]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in got], pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "passages"])

    return by_batches(texts(docs), act, "doc_id long, score double, passages array<struct<start: long, end: long, chance: double>>")


def harmless(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``most``, with all their columns."""
    at = [i for i, c in enumerate(docs.columns) if c.lower() == "text"][0]

    def act(batch):
        return batch.filter(pa.array([model.judged(t or "")[0] < most for t in batch.column(at).cast(pa.string()).to_pylist()], pa.bool_()))

    return by_batches(docs, act, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, 5) == 0, F.lit(False))

"""Language of a text: averaged hashed subword embeddings and a linear softmax.

Subwords are the two- and three-letter strings of the lower-cased text, word edges
included, hashed to ``BUCKETS`` rows of an embedding table. The average of the rows goes
through a linear softmax; both are trained by stochastic gradient descent in numpy on a
bounded sample: at most ``PER_LANGUAGE`` passages of ``PASSAGE`` characters per language,
the first by a hash of document and passage. As the layers are linear, a text's scores
are the average of one row of numbers per subword, so whole texts of any length are one pass.

Calibration uses a part of the sample that is not trained on: a temperature for the
scores, and two thresholds for rejection, which turn away what is no learned language. The
first is a score that nearly all calibration passages with the right language reach, whole or
cut short. The second is on the share of subwords that training has met. A passage under
several languages has each of them right, so labels that disagree raise neither.

A null text or one without a letter (a mark alone is none) is ``und`` with score 0 and is rejected; so is every
text if no row has a language. Repeated rows are predicted alike. Null languages and
``doc_id`` are not learned from. An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.base import fold

BUCKETS = 1 << 17
WIDTH = 16
#: Bounds of the sample that the model is fitted on.
PASSAGE = 400
PER_LANGUAGE = 2000
LANGUAGES = 500
#: Characters of the short texts that calibration cuts from its passages.
SHORT = (20, 80)
#: Characters scored at a time.
GROUP = 1 << 16
#: Rows of a batch whose texts are Python strings at a time.
ROWS = 256


@cache
def letters() -> np.ndarray:
    """Whether a code point is a letter or a mark."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed subwords of texts one after another, and where each text's begin."""
    codes = np.frombuffer(("  " + "  ".join(texts) + "  ").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if any(len(t) != len(t.lower()) for t in texts):  # few letters become longer in lower case
        texts = [t.lower() for t in texts]
    at = np.cumsum([0, *(len(t) + 2 for t in texts)])
    letter = letters()[codes]
    code = np.where(letter, codes, 0).astype(np.uint64)
    two = code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + code[2:] * np.uint64(0x94D049BB133111EB)
    both = np.stack([two, three], axis=1)
    both ^= both >> np.uint64(31)
    hashed = (both * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 17)
    some2 = letter[:-2] | letter[1:-1]
    keep = np.stack([some2, some2 | letter[2:]], axis=1).ravel()
    begins = np.r_[0, np.cumsum(keep)][2 * np.minimum(at, len(some2))]
    return hashed.ravel()[keep].astype(np.int64), begins


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # a row of language scores per bucket
    seen: np.ndarray  # buckets met in training
    least_score: float
    least_seen: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated score and whether the text is rejected, of each text."""
        full = [t or "" for t in texts]
        names, scores, seen = [], np.zeros(len(full)), np.zeros(len(full))
        for a, b in spans([len(t) for t in full], GROUP):
            found, begins = subwords(full[a:b])
            n = np.diff(begins)
            if not self.languages or not len(found):
                names += ["und"] * (b - a)
                continue
            have = np.flatnonzero(n)
            lettered = np.array([any(map(str.isalpha, full[a + i])) for i in have.tolist()], bool)
            some = have[lettered]
            if not len(some):
                names += ["und"] * (b - a)
                continue
            rows = np.add.reduceat(self.table[found], begins[have], axis=0)[lettered] / n[some, None]
            p = softmax(rows)
            best = p.argmax(axis=1)
            part = ["und"] * (b - a)
            for i, k in zip(some.tolist(), best.tolist()):
                part[i] = self.languages[k]
            names += part
            scores[a:b][some] = p[np.arange(len(best)), best]
            seen[a:b][some] = np.add.reduceat(self.seen[found].astype(np.float64), begins[have])[lettered] / n[some]
        return names, scores, (scores < self.least_score) | (seen < self.least_seen) | (scores == 0)


def spans(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring items of about ``most`` in all; a larger item is alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(passages: list[str], labels: list[str], epochs: int = 4, rate: float = 4.0, keep: float = 0.999) -> Model:
    """Fit by stochastic gradient descent; every fifth passage is for calibration only."""
    languages = sorted(set(labels))
    usable = [(p, languages.index(k)) for p, k in zip(passages, labels) if p]
    found, begins = subwords([p for p, _ in usable]) if usable else (np.zeros(0, np.int64), np.zeros(1, int))
    have = np.flatnonzero(np.diff(begins))
    if not len(have):
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(BUCKETS, bool), 0.0, 0.0)
    y = np.array([k for _, k in usable])
    held = have[::5] if len(have) >= 10 else have
    learn = np.setdiff1d(have, held) if len(have) >= 10 else have
    rng = np.random.default_rng(0)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    seen = np.zeros(BUCKETS, bool)
    total, step = max(1, epochs * len(learn)), 0
    for _ in range(epochs):
        order = rng.permutation(learn)
        for at in range(0, len(order), 16):
            batch = order[at : at + 16]
            idx = np.concatenate([found[begins[i] : begins[i + 1]] for i in batch])
            n = np.array([begins[i + 1] - begins[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), n)
            mean = np.add.reduceat(embed[idx], np.cumsum(n) - n, axis=0) / n[:, None]
            error = softmax(mean @ layer)
            error[np.arange(len(batch)), y[batch]] -= 1
            speed = rate * (1 - step / total) / len(batch)
            back = (error @ layer.T / n[:, None]).astype(np.float32)
            layer -= (speed * mean.T @ error).astype(np.float32)
            np.add.at(embed, idx, -np.float32(speed * WIDTH) * back[owner])
            seen[idx] = True
            step += len(batch)
    table = embed @ layer
    n = np.array([begins[i + 1] - begins[i] for i in held])
    idx = np.concatenate([found[begins[i] : begins[i + 1]] for i in held])
    rows = np.add.reduceat(table[idx], np.cumsum(n) - n, axis=0) / n[:, None]
    loss = lambda t: -np.log(softmax(rows * t)[np.arange(len(held)), y[held]] + 1e-12).mean()
    heat = min(np.geomspace(0.25, 64, 49), key=loss)
    p = softmax(rows * heat)
    best, named = p.argmax(axis=1), {}
    for i in have.tolist():
        named.setdefault(usable[i][0], set()).add(usable[i][1])
    top = [p[j, k] for j, (i, k) in enumerate(zip(held.tolist(), best.tolist())) if k in named[usable[i][0]]]
    for i in held.tolist():  # texts may be shorter than passages
        for most in SHORT:
            part = subwords([usable[i][0][:most]])[0]
            if len(part):
                q = softmax((table[part].mean(axis=0) * heat)[None])[0]
                top += [q.max()] if q.argmax() in named[usable[i][0]] else []
    least = float(np.quantile(top, 1 - keep)) if top else 0.0
    share = np.add.reduceat(seen[idx].astype(np.float64), np.cumsum(n) - n) / n
    return Model(languages, (table * heat).astype(np.float32), seen, least, float(share.min()) / 2)


def learnable(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang`` of the rows that may be learned from: those outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return rows.where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), 4) != 2))


def sample(rows: DataFrame) -> DataFrame:
    """At most ``PER_LANGUAGE`` passages of each of ``LANGUAGES`` languages, by a hash.

    Documents go in by a hash of ``doc_id`` below a bar that lets about as many through
    as are wanted; only their texts are cut into passages.
    """
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    span = 1 << 30
    bar = F.lit(None).cast("long")
    for r in sizes:
        bar = F.when(F.col("lang") == r["lang"], F.lit(int(span * min(1.0, 1.5 * PER_LANGUAGE / r["n"])))).otherwise(bar)
    drawn = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < bar) if sizes else rows.limit(0)
    cut = drawn.select("doc_id", "lang", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PASSAGE}}}"), 0)).alias("part", "passage"))
    order = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id", "part"), "doc_id", "part", "passage"))
    return cut.withColumn("n", order).where(F.col("n") <= PER_LANGUAGE).select("lang", "doc_id", "part", "passage")


def fitted(docs: DataFrame) -> Model:
    rows = sorted(sample(learnable(docs)).collect(), key=lambda r: (hash_order(r["doc_id"], r["part"]), r["lang"], r["passage"]))
    return train([r["passage"] for r in rows], [r["lang"] for r in rows])


def hash_order(*values) -> int:
    """A fixed mixing order, so that languages do not follow one another."""
    return (sum((v or 0) * f for v, f in zip(values, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)))) % 2**64


def by_batches(docs: DataFrame, act: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """What ``act`` makes of every ``ROWS`` rows. A batch may have 10,000 rows, and a worker never gives back
    all the memory that their texts and results take at once."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield act(batch.slice(at, ROWS))

    return docs.mapInArrow(run, schema)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row."""

    def act(batch):
        names, scores, out = model.predict(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(out)], ["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return by_batches(rows, act, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""
    at = [i for i, c in enumerate(docs.columns) if c.lower() == "text"][0]

    def act(batch):
        return batch.filter(pa.array(~model.predict(batch.column(at).cast(pa.string()).to_pylist())[2]))

    return by_batches(docs, act, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, 4) == 2, F.lit(False))

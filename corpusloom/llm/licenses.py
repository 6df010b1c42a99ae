"""Licence scan: a trained paragraph classifier with an unknown class and a template check.

A paragraph is a line of a text, or a window of neighbouring lines up to a line without a word, as
notices are wrapped; a window ends where it holds the words of the longest template. Its features are single words and pairs of words next
to each other, of the words that templates use. A logistic regression over them, one against
the rest per family, is trained by gradient descent on variants of the templates, with
words left out, added and cut off, against a bounded sample of the corpus' own
paragraphs and variants of ``FOREIGN`` notices. A score is calibrated on held-out variants: below the level that
``RIGHT`` of them reach, the family is unknown; ``false_names`` is the share of held-out foreign notices that reach it.
A prediction is confirmed if the paragraph holds a long enough part of a template of that family in order, and in that
part the words that name the licence, none that name another, and no denial there or in the two words before it (of
the last sentence, too); a known family without that is
``unconfirmed``. Where paragraphs overlap, the one that holds most words of a template counts, of
equal ones the one of fewest lines; a line with a whole template always counts. ``line`` is its first line.

Lines without a word that any weight uses have the score of the bias, which is unknown, so
they are passed over; so are windows with none but words of ``COMMON``. Null and empty texts have no paragraphs. Repeated rows repeat. An empty table
gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import texts
from corpusloom.llm.language import by_batches

# Notices by which common licences are named.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Words that name a licence where a template has one of them. A paragraph holds all of
# them that its template has, within the part it shares with it, or it is no confirmation.
NAMES = frozenset("affero apache attribution boost bsd by cc cc0 commons eclipse gnu isc lesser mit mozilla noncommercial nc sa sharealike unencumbered".split())
# Words that make another licence of a named one, unless the template has them.
OTHER = frozenset("affero documentation lesser library nc nd noderivatives noderivs noncommercial sa sharealike".split())
# Families named with a version, which has to stand there too.
VERSIONS = {"Apache-2.0": "2", "MPL-2.0": "2", "EPL-2.0": "2", "BSL-1.0": "1"}
# Words that deny what follows them, and how far before a notice they do.
DENIALS = frozenset("aren cannot isn neither never no nor not unlike wasn weren".split())
DENIED = 2
# Notices of none of these licences; the classifier learns them as unknown.
FOREIGN = [
    "Licensed under the Artistic License 2.0.",
    "Licensed under the Common Development and Distribution License.",
    "Licensed under the Microsoft Public License.",
    "Licensed under the Academic Free License, version 3.0.",
    "Licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Business Source License 1.1.",
    "Released under the PostgreSQL License.",
    "Released under the Python Software Foundation License.",
    "Distributed under the PHP License, version 3.01.",
    "Distributed under the terms of the sale.",
    "This work is licensed under the terms of a private agreement.",
    "The seller is licensed under the laws of the country.",
    "This program is the property of its owner, and you may not redistribute or modify it.",
    "All rights reserved. No part of this publication may be copied without permission of the publisher.",
    "Use of this software is subject to the terms of the agreement with the vendor.",
    "Permission to copy this work is granted by the owner on request, for a fee.",
]
WORD = re.compile(r"\w+")
#: Bounds of the fit: paragraphs of the corpus and their characters; variants of a template.
OTHERS = 2000
PARAGRAPH = 400
VARIANTS = 60
RIGHT = 0.98
#: Share of a template's words that a confirmed paragraph holds in order.
SHARE = 0.6
#: Words of templates that name no licence by themselves.
COMMON = frozenset("a and any are as by can following for in is it may not of or that the this to under use with without you".split())


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


@dataclass
class Model:
    families: list[str]
    features: dict[str, int]
    weights: np.ndarray  # feature by family
    bias: np.ndarray
    least: float
    false_names: float = 0.0  # share of held-out foreign notices whose score reaches ``least``

    def __post_init__(self):
        self.vocabulary = {f for f in self.features if " " not in f}
        self.rare = self.vocabulary - COMMON
        self.templates = {f: [words_of(t) for t in TEMPLATES[f]] for f in self.families}
        self.longest = max(len(t) for ts in self.templates.values() for t in ts)

    def vector(self, words: list[str]) -> np.ndarray:
        grams = set(words) | {f"{a} {b}" for a, b in zip(words, words[1:])}
        return np.array(sorted(self.features[g] for g in grams if g in self.features), np.int64)

    def judge(self, words: list[str], before: Callable[[], list[str]]) -> tuple[str, float, int, bool]:
        """Family, score, how many words of a template that confirms it stand there (0 if none), and whether all do."""
        at = self.vector(words)
        x = self.weights[at].sum(axis=0) / np.sqrt(max(len(at), 1)) + self.bias
        p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        best = int(p.argmax())
        if p[best] < self.least:
            return "unknown", float(p[best]), 0, False
        family = self.families[best]
        held = [(shared(words, t), t) for t in self.templates[family]]
        held = [(share, t) for share, t in held if share >= SHARE and confirmed(words, t, family, before())]
        most = max((round(share * len(t)) for share, t in held), default=0)
        return family, float(p[best]), most, any(share == 1 for share, _ in held)

    def windows(self, lines: list[list[str]]) -> Iterator[tuple[int, int, list[str]]]:
        """First and last line and words of windows of two lines or more; their ends hold words of templates."""
        known = [not self.vocabulary.isdisjoint(w) for w in lines]
        rare = [not self.rare.isdisjoint(w) for w in lines]
        for first in range(len(lines)):
            if not known[first]:
                continue
            words, named = lines[first][-self.longest :], rare[first]
            inner = 0  # words between the first line and the last
            for last in range(first + 1, len(lines)):
                if not lines[last] or inner >= self.longest:
                    break
                named = named or rare[last]
                if named and known[last]:
                    yield first, last, words + lines[last][: self.longest]
                inner += len(lines[last])
                words = words + lines[last]

    def ahead(self, lines: list[list[str]], first: int, cut: int) -> list[str]:
        """As many words of the paragraph as a denial can stand before word ``cut`` of a line."""
        out, most = lines[first][:cut], self.longest + DENIED
        while first and len(out) < most and lines[first - 1]:
            first -= 1
            out = lines[first] + out
        return out[-most:]

    def scan(self, text: str) -> list[tuple[int, str, float, bool]]:
        lines = [words_of(line) for line in text.split("\n")]
        found = []
        for first, last, words in chain(((i, i, w) for i, w in enumerate(lines) if not self.vocabulary.isdisjoint(w)), self.windows(lines)):
            cut = max(0, len(lines[first]) - self.longest) if last > first else 0
            family, score, held, whole = self.judge(words, partial(self.ahead, lines, first, cut))
            if family != "unknown":
                found.append((first, last, family, score, held, whole and first == last))
        taken, out = set(), []
        for first, last, family, score, held, whole in sorted(found, key=lambda x: (not x[5], -x[4], x[1] - x[0], -x[3], x[0])):
            if whole or taken.isdisjoint(range(first, last + 1)):
                taken.update(range(first, last + 1))
                out.append((first, family, score, held > 0))
        return sorted(out)


def shared(words: list[str], template: list[str]) -> float:
    """Share of the template's words in the longest common subsequence with the paragraph."""
    row = [0] * (len(template) + 1)
    for w in words:
        last = 0
        for j, t in enumerate(template, 1):
            last, row[j] = row[j], last + 1 if w == t else max(row[j], row[j - 1])
    return row[-1] / len(template)


def aligned(words: list[str], template: list[str]) -> list[int]:
    """Places of a longest common subsequence in the paragraph: it ends as early as any and is as close as it can be."""
    rows = [[0] * (len(template) + 1)]
    for w in words:
        above, row = rows[-1], [0]
        for j, t in enumerate(template, 1):
            row.append(above[j - 1] + 1 if w == t else max(above[j], row[-1]))
        rows.append(row)
    i, j, out = next(i for i, r in enumerate(rows) if r[-1] == rows[-1][-1]), len(template), []
    while i and j:
        if words[i - 1] == template[j - 1]:
            i, j = i - 1, j - 1
            out.append(i)
        elif rows[i][j - 1] >= rows[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def confirmed(words: list[str], template: list[str], family: str, before: list[str]) -> bool:
    """Is the part that is shared with the template named as the template is, and not denied?"""
    places = aligned(words, template)
    part = words[places[0] : places[-1] + 2]
    wanted = NAMES.intersection(template) | ({VERSIONS[family]} if family in VERSIONS else set())
    # words that the template does not have, from a little before where it would begin to the part's end
    apart, begin = set(places), places[0] - DENIED - template.index(words[places[0]])
    between = {w for i, w in enumerate(words[: places[-1]]) if i >= begin and i not in apart}
    between.update(before[begin:] if begin < 0 else [])
    return wanted.issubset(part) and not (OTHER - set(template)).intersection(part) and DENIALS.isdisjoint(between)


def variants(template: str, rng: np.random.Generator) -> list[list[str]]:
    base, found = words_of(template), []
    for i in range(VARIANTS):
        words = [w for w in base if i == 0 or rng.random() > 0.08]
        if i % 3 == 1:
            words = words[: max(3, int(len(words) * rng.uniform(0.7, 1)))]
        if i % 3 == 2:
            words = [f"x{rng.integers(1000)}" for _ in range(rng.integers(0, 4))] + words + [f"x{rng.integers(1000)}" for _ in range(rng.integers(0, 4))]
        found.append(words)
    return found


def train(others: list[str], rounds: int = 300, rate: float = 2.0) -> Model:
    rng, families = np.random.default_rng(0), sorted(TEMPLATES)
    rows = [(v, k, i) for k, f in enumerate(families) for t in TEMPLATES[f] for i, v in enumerate(variants(t, rng))]
    # variants of every fourth foreign notice are held out whole
    rows += [(v, -2, 4 if n % 4 == 3 else 0) for n, t in enumerate(FOREIGN) for v in variants(t, rng)]
    rows += [(words_of(o), -1, i) for i, o in enumerate(others)]
    vocabulary = {w for f in families for t in TEMPLATES[f] for w in words_of(t)}
    grams = {f"{a} {b}" for f in families for t in TEMPLATES[f] for a, b in zip(words_of(t), words_of(t)[1:])}
    features = {g: i for i, g in enumerate(sorted(vocabulary | grams))}
    model = Model(families, features, np.zeros((len(features), len(families))), np.full(len(families), -4.0), 0.5)
    x = np.zeros((len(rows), len(features)), np.float32)
    for i, (words, _, _) in enumerate(rows):
        at = model.vector(words)
        x[i, at] = 1 / np.sqrt(max(len(at), 1))
    y = np.array([[k == f for f in range(len(families))] for _, k, _ in rows], np.float32)
    held = np.array([i % 5 == 4 for _, _, i in rows])
    kind = np.array([k for _, k, _ in rows])
    a, b = x[~held], y[~held]
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(a @ model.weights + model.bias))) - b
        model.weights -= rate * (a.T @ error / len(a) * 20 + 1e-4 * model.weights)
        model.bias -= rate * error.mean(axis=0)
    p = 1 / (1 + np.exp(-(x[held] @ model.weights + model.bias)))
    own = p[y[held] > 0]
    other = p[kind[held] == -1].max(axis=1, initial=0)
    model.least = max(float(np.quantile(own, 1 - RIGHT)) if len(own) else 0.5, float(other.max(initial=0.0)) if len(other) else 0.0, 0.2)
    model.false_names = float((p[kind[held] == -2].max(axis=1) >= model.least).mean())
    return model


def fitted(docs: DataFrame) -> Model:
    """Against ``OTHERS`` paragraphs of the corpus, the first by a hash, that name no licence word."""
    share = min(1.0, OTHERS / max(1, docs.count()))
    bar = int(share * (1 << 30))
    drawn = texts(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= bar)
    lines = drawn.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).where("length(line) > 0")
    clean = lines.where(~F.lower("line").rlike("licen|copyright|permission|redistribut|public domain"))
    rows = clean.orderBy(F.xxhash64("doc_id", "n"), "doc_id", "n", "line").limit(OTHERS).select(F.substring("line", 1, PARAGRAPH).alias("line")).collect()
    return train([r["line"] for r in rows])


def found(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, licenses, unconfirmed, paragraphs``: families of every row, and where they stand."""

    def act(batch):
        scans = [model.scan(t) for t in batch.column(1).to_pylist()]
        kind = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("score", pa.float64()), ("confirmed", pa.bool_())]))
        return pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([sorted({f for _, f, _, c in s if c}) for s in scans], pa.list_(pa.string())),
            pa.array([sorted({f for _, f, _, c in s if not c}) for s in scans], pa.list_(pa.string())),
            pa.array([[{"line": a, "family": b, "score": c, "confirmed": e} for a, b, c, e in s] for s in scans], kind),
        ], ["doc_id", "licenses", "unconfirmed", "paragraphs"])

    return by_batches(texts(docs), act, "doc_id long, licenses array<string>, unconfirmed array<string>, paragraphs array<struct<line: int, family: string, score: double, confirmed: boolean>>")

"""Repeated passages against counting all windows, on small alphabets, runs, copies and odd rows."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries as Q
from corpusloom.llm import recompression as R

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain(texts, window):
    """``n_words, n_removed, kept`` of each text by counting every window."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(window)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def corpus(rng, letters, texts, copied):
    """Random texts with copied passages, runs and periods."""
    out = []
    for _ in range(texts):
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, copied)):
            if out:
                other = rng.choice(out).split()
                a = rng.randint(0, len(other))
                at = rng.randint(0, len(words))
                words[at:at] = other[a : a + rng.randint(0, 40)]
            if rng.random() < 0.3:
                words[rng.randint(0, len(words)) : 0] = [rng.choice(letters) for _ in range(rng.randint(1, 3))] * rng.randint(2, 20)
        out.append(" ".join(words))
    return out


def test_equal_windows_have_one_symbol():
    """What reveals a window follows from its words alone."""
    rng = random.Random(1)
    for letters, window in (("ab", 9), ("abc", 12), ("abcdefghij", 7), ([f"w{i}" for i in range(200)], 20)):
        for _ in range(40):
            rows = [t.encode().split() for t in corpus(rng, letters, 12, 3)]
            sizes = np.array([len(r) for r in rows], np.int64)
            flat = [w for r in rows for w in r]
            if not flat:
                continue
            found = R.parsed(R.digests(flat)[:, 0], sizes)
            starts, by = R.revealing(found, sizes, window)
            ends = np.cumsum(sizes)
            assert starts.tolist() == [e - n + i for e, n in zip(ends, sizes) for i in range(n - window + 1)]
            signs = {}
            for s, symbol in zip(starts.tolist(), by.tolist()):
                sign = (int(found.name[symbol]), int(found.start[symbol]) - s) if symbol >= 0 else None
                assert signs.setdefault(tuple(flat[s : s + window]), sign) == sign


def test_names_stand_for_words():
    rng = random.Random(2)
    rows = [t.encode().split() for t in corpus(rng, "abcd", 60, 3)]
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = [w for r in rows for w in r]
    found = R.parsed(R.digests(flat)[:, 0], sizes)
    meaning = {}
    for name, a, b in zip(found.name.tolist(), found.start.tolist(), found.end.tolist()):
        assert meaning.setdefault(name, flat[a:b]) == flat[a:b]
    assert found.start.tolist() == [0, *found.end.tolist()[:-1]] and len(found.name) < len(flat) / 2


@pytest.mark.parametrize("letters, window, hot", [("ab", 9, 1024), ("abcde", 6, 4), ([f"w{i}" for i in range(60)], 12, 2)])
def test_against_all_windows(spark, monkeypatch, letters, window, hot):
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "STRETCH", 300)  # many stretches and parts
    texts = corpus(random.Random(window), letters, 150, 2)
    texts += texts[:20] + [texts[5]] * 30
    rows = list(enumerate(texts))
    found = R.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(7), window).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found}
    assert got == dict(enumerate(plain(texts, window)))


def test_odd_rows(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    filler = lambda n: " ".join(f"f{rng.random()}" for _ in range(n))
    texts = [
        None, "", " \t\n", "one", passage, f"{filler(50)} {passage}\n{filler(5)}", f"{passage.replace(' ', chr(9))}  {filler(40)}",
        "run " * 5000, "x " * 34, "y " * 35, "y " * 35, "z " * 36, "ü ß " * 20, filler(20_000), "é" * 100_000,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "lone row without an id"), (3, "one")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("key", "name", "span", "n", "a", "b", "kept", "rows")})
    found = R.without_repeats(frame).collect()
    want = [(d, *p) for (d, _), p in zip(rows, plain([t for _, t in rows], 35))]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert R.without_repeats(frame.limit(0)).count() == 0


def test_sql(spark):
    found = Q.QUERIES["op12_repeated_passages"](spark, SF_DIR)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    want = con.execute(f"select {', '.join(found.columns)} from ({Q.ORACLE['op12_repeated_passages']})").fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert any(r[2] for r in want) and not all(r[2] for r in want)

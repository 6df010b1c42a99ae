"""Orchard search and conversation repair against brute force, with nulls, ties, repeats and hot inputs."""

import hashlib
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import orchard, repair
from corpusloom.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"


def same_as_sql(spark, name, sf_dir):
    """The query's rows on tables of ``sf_dir`` equal those of its SQL."""
    found = Q.QUERIES[name](spark, sf_dir)
    columns = found.columns
    con = duckdb.connect()
    for table in ("embeddings", "conversations", "documents"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    want = con.execute(f"select {', '.join(columns)} from ({Q.ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))


def test_sql(spark):
    same_as_sql(spark, "op11_orchard_clusters", SF_DIR)
    same_as_sql(spark, "op13_repaired_conversations", SF_DIR)


def test_search_equals_comparing_all():
    rng = np.random.default_rng(1)
    for k, size, span in ((1, 3, 9), (7, 2, 3), (40, 8, 5), (40, 64, 300)):
        centroids = rng.integers(-span, span + 1, (k, size))
        centroids[-1] = centroids[0]  # a tie of equal centroids
        vectors = np.r_[rng.integers(-span, span + 1, (500, size)), centroids, (centroids[:1] + centroids) // 2]
        cluster, distance = orchard.Neighbours.of(centroids).search(vectors)
        plain = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
        assert (cluster == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def embeddings(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.withColumns({c: F.lit("x") for c in ("v", "x", "cluster", "distance", "n")})


def test_clusters_with_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, (rng.integers(-9, 9, 4) / 8).tolist()) for i in range(60)]
    good += [good[3], (3, good[5][1]), (None, good[7][1]), (61, [0.0] * 4)]
    odd = [(70, None), (71, []), (72, [1.0] * 3), (73, [1.0, None, 1.0, 1.0]), (74, [1.0, float("nan"), 1.0, 1.0]), (75, [float("inf")] * 4)]
    found, centroids = orchard.clustered(embeddings(spark, [(i, v, 0) for i, v in good + odd]), k=9, rounds=5, seed=2, size=4)
    whole = [(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in good]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r)
    plain = [list(v) for _, v in sorted(whole, key=key)[:9]]
    place = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(plain))
    for _ in range(5):
        groups = {}
        for _, v in whole:
            groups.setdefault(place(v)[1], []).append(v)
        plain = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(plain)]
    assert centroids.tolist() == plain
    rows = orchard.with_inertia(found, centroids).collect()
    want = sorted(((i, place(v)[1], place(v)[0]) for i, v in whole), key=repr)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in rows), key=repr) == want
    assert {r["inertia"] for r in rows} == {sum(d for _, _, d in want)}
    assert all(r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"]) for r in rows)


def test_few_or_no_vectors(spark):
    found, centroids = orchard.clustered(embeddings(spark, [(1, [0.5, 0.5], 0), (2, [0.25, 1.0], 0)]), k=40, size=2)
    assert len(centroids) == 2 and {r["distance"] for r in found.collect()} == {0}
    found, centroids = orchard.clustered(embeddings(spark, [(1, None, 0)]), k=40, size=2)
    assert orchard.with_inertia(found, centroids).count() == 0


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str]:
    """Cost and audit by trying every list of edits with at most two insertions in a place."""
    best = [(10**9, "")]

    def go(i, state, cost, audit):
        if cost > best[0][0]:
            return
        if i == len(rows):
            for more, to in ((0, state), (1, 2 if state != 2 else 3), (2, 3 if state != 2 else 2)):
                if to in (0, 3):
                    best[0] = min(best[0], (cost + 5 * more, audit + "I" * more))
            return
        initial, fault = rows[i]
        for more in range(3):
            at, c, a = state, cost + 5 * more, audit + "I" * more
            for _ in range(more):
                at = 3 if at == 2 else 2
            go(i + 1, at, c + 2, a + "D")
            if fault in ("blank", "duplicate"):
                continue
            c += 5 if fault == "truncated" else 0
            if initial == "s" and at == 0:
                go(i + 1, 1, c, a + "K")
            if initial == "u" and at != 2 or initial == "a" and at == 2:
                go(i + 1, 3 if at == 2 else 2, c, a + "K")
            go(i + 1, 3 if at == 2 else 2, c + 1, a + "R")

    go(0, 0, 0, "")
    return best[0]


def test_search_finds_the_cheapest_and_least(spark):
    rng = random.Random(3)
    codes = {"": repair.SOUND, "blank": repair.EMPTY, "truncated": repair.TORN, "duplicate": 3}
    for _ in range(1500):
        rows = [(rng.choice("suuaaax"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 7))]
        search, out = repair.Search(), []
        for i, (initial, fault) in enumerate(rows):
            out += search.add((i, "t", initial), initial, codes[fault])
        out += search.end()
        found = (sum(n.cost for n in out), "".join(n.edit for n in out))
        assert found == cheapest(rows), rows


def test_long_conversation_keeps_a_small_tree():
    search, out, most = repair.Search(), 0, 0
    rng = random.Random(5)
    for i in range(30_000):
        out += len(search.add((i, "t", "u"), rng.choice("uaaus"), rng.choice([0, 0, 0, 1, 2, 3])))
        most = max(most, max(n.depth for _, n in search.best.values()) - search.root.depth)
    assert out > 29_000 and most < 300


def test_odd_conversations(spark):
    rows = [
        (1, None, "user", "Hi."), (1, 0, None, "So?"), (1, 0, "assistant", "Yes."), (1, 3, "assistant", "Yes."), (1, 5, "", "x"),
        (None, 1, "system", "Be."), (None, 2, "user", "A!"), (None, 3, "assistant", "cut"), (2, 1, "user", None), (2, 1, "user", " \t\n"),
        (3, 7, "user", "Long. " * 50_000), (3, 8, "assistant", "ok."), (3, 8, "assistant", "ok."),
    ]
    frame = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in ("at", "edit", "digest", "kind", "fault", "known")})
    found = {r["conv_id"]: r for r in repair.summary(repair.edits(frame)).collect()}
    assert set(found) == {1, 2, 3, None}
    assert (found[2]["audit"], found[2]["blank"], found[2]["cost"], found[2]["gaps"]) == ("DD", 2, 4, 0)
    assert (found[3]["audit"], found[3]["duplicate"]) == ("KKD", 1)
    assert found[3]["repaired_sha256"] == hashlib.sha256(("user:" + "Long. " * 50_000 + "\nassistant:ok.").encode()).hexdigest()
    assert (found[None]["truncated"], found[None]["audit"], found[None]["cost"]) == (1, "RRD", 4)
    assert (found[1]["gaps"], found[1]["duplicate"], found[1]["truncated"]) == (3, 1, 1)
    assert repair.edits(frame.limit(0)).count() == 0


def test_hot_conversation_over_small_batches(spark):
    """One conversation across many Arrow batches gives what a plain walk gives."""
    rng = random.Random(8)
    rows = [(5, i, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", "", f"{i}."])) for i in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = repair.edits(spark.createDataFrame(rows, ROWS)).orderBy("at").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    search, seen, out = repair.Search(), set(), []
    for _, turn, role, text in rows:
        fault = repair.EMPTY if not text else 3 if (role, text) in seen else repair.SOUND if text[-1] == "." else repair.TORN
        seen.add((role, text))
        out += search.add((turn, text, role), role[0], fault)
    out += search.end()
    assert [(r["edit"], r["turn"], r["fault"], r["role"]) for r in found] == [
        (n.edit, n.row[0] if n.row else None, repair.FAULTS[n.fault], n.role) for n in out
    ]

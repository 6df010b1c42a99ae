"""Key phrases and mentions against plain Python on small inputs."""

import json
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import words
from corpusloom.operators import link, rank, trees
from corpusloom.sinks import writers
from corpusloom.streaming import incremental

TEXTS = {
    1: ("Graph ranks and graph words. The graph rank, graph words; words of a graph rank!", "en"),
    2: ("alone", "en"),
    3: ("the and of", "en"),
    4: ("", "en"),
    5: ("La maison rouge et la maison verte\nmaison rouge - rouge", "fr"),
    6: ("x " * 40 + "y z x", None),
    7: (None, "en"),
    8: ("Straße über Köln; straße KÖLN 12 a1", "de"),
}


def docs(spark):
    return spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in TEXTS.items()], "doc_id long, text string, lang string"
    )


def phrase_runs(text, lang):
    stops = set(words.stop_words(lang or "en"))
    runs = []
    for segment in re.split(r"(?:[^\w\s]|_)+", text.lower()):
        run = []
        for token in segment.split() + [None]:
            if token is None or token in stops:
                if run:
                    runs.append(run)
                run = []
            else:
                run.append(token)
    return runs


def by_hand(text, lang, rounds, reach=3):
    """Phrases with their counts and rank units, by the definition."""
    runs = phrase_runs(text, lang)
    kept = [w for run in runs for w in run]
    near = defaultdict(set)
    for i, a in enumerate(kept):
        for b in kept[i + 1 : i + 1 + reach]:
            if a != b:
                near[a].add(b)
                near[b].add(a)
    vocabulary = set(kept)
    n = len(vocabulary)
    ranks = {w: 10**12 // n for w in vocabulary}
    for _ in range(rounds):
        ranks = {
            w: 150 * 10**9 // n + 85 * sum(ranks[b] // len(near[b]) for b in near[w]) // 100
            for w in vocabulary
        }
    counts = Counter(" ".join(run) for run in runs)
    scored = {p: sum(ranks[w] for w in p.split()) // len(p.split()) for p in counts}
    order = sorted(counts, key=lambda p: (-scored[p], p))
    return [(k + 1, p, counts[p], scored[p] / 1e12) for k, p in enumerate(order)]


@pytest.mark.parametrize("rounds", [1, 2, 7])
def test_textrank(spark, rows, rounds):
    want = [
        (i, *row)
        for i, (text, lang) in TEXTS.items()
        if text
        for row in by_hand(text, lang, rounds)
    ]
    assert rows(rank.textrank(docs(spark), k=None, rounds=rounds)) == sorted(want, key=repr)


def test_both_ways_agree(spark, rows):
    toks = rank.default_tokenizer(["doc_id"])(docs(spark))
    in_rows = rank.textrank_in_rows(toks, ["doc_id"], 5, rounds=6)
    by_rounds = rank.textrank_by_rounds(toks, ["doc_id"], 5, rounds=6, cut_every=4)
    assert rows(in_rows) == rows(by_rounds)
    assert rows(rank.textrank(docs(spark), k=5, rounds=6)) == rows(in_rows)


def test_every_language_has_its_stop_words(spark):
    frame = spark.createDataFrame([(1, "il gatto e la casa della nonna", "it")], "doc_id long, text string, lang string")
    assert [r["phrase"] for r in rank.candidate_phrases(frame).collect()] == ["gatto", "casa", "nonna"]


def test_rank_properties(spark):
    full = rank.textrank(docs(spark), k=None)
    top = rank.textrank(docs(spark), k=3)
    keep = {tuple(r) for r in full.where("rk <= 3").collect()}
    assert {tuple(r) for r in top.collect()} == keep
    single = full.where("doc_id = 2").first()
    assert (single["phrase"], single["cnt"], single["rank_score"]) == ("alone", 1, 0.15)
    assert full.where("doc_id in (3, 4, 7)").isEmpty()


def test_own_tokenizer(spark, rows):
    def letters(frame):
        return frame.select("doc_id", F.split(F.lower("text"), " ").alias("toks"))

    frame = spark.createDataFrame([(1, "A b c a")], "doc_id long, text string")
    got = rank.textrank(frame, tokenizer=letters, k=None)
    assert rows(got.select("phrase", "cnt")) == [("a b c a", 1)]


def test_candidate_phrases(spark):
    got = rank.candidate_phrases(docs(spark)).orderBy("doc_id", "seq").collect()
    want = [
        (i, n, " ".join(run))
        for i, (text, lang) in TEXTS.items()
        if text
        for n, run in enumerate(phrase_runs(text, lang))
    ]
    assert [tuple(r) for r in got] == want


def test_sections_without_phrases_stay(spark):
    sections = spark.createDataFrame(
        [(1, 1, "T1 ", "graph rank graph"), (1, 2, "The ", "the of and")],
        "doc_id long, sec_no int, title string, text string",
    )
    phrases = rank.textrank_sections(sections, keys=["doc_id", "sec_no"])
    nested = writers.section_documents(phrases, sections).first()["sections"]
    assert [s["section_title"] for s in nested] == ["T1 ", "The "]
    assert [len(s["text_rank"]) for s in nested] == [1, 0]


def test_unique_phrases(spark, rows):
    ranked = spark.createDataFrame(
        [(1, 1, "a", 5, 0.5), (1, 2, "b", 4, 0.4), (1, 3, "a", 3, 0.3)],
        "doc_id long, rk int, phrase string, cnt long, rank_score double",
    )
    assert rows(rank.unique_phrases(ranked)) == [(1, 1, "a", 3, 0.3), (1, 2, "b", 4, 0.4)]


def test_write_phrases_keeps_order_and_letters(spark, tmp_path):
    nested = writers.phrase_documents(rank.textrank(docs(spark), k=2))
    writers.write_phrases(nested, str(tmp_path / "p"))
    raw = [r["value"] for r in spark.read.text(str(tmp_path / "p")).collect()]
    assert any("straße" in line for line in raw)
    lines = [json.loads(line) for line in raw]
    ranked = rank.textrank(docs(spark), k=2).orderBy("doc_id", "rk").collect()
    want = {}
    for r in ranked:
        want.setdefault(r["doc_id"], []).append((r["phrase"], (r["cnt"], r["rank_score"])))
    got = {
        d["doc_id"]: [(p, (v["count"], v["rank_score"])) for p, v in d["phrases"].items()]
        for d in lines
    }
    assert got == want


NAMES = [
    (1, "Census of Housing"), (2, "census"), (3, "housing census"), (4, "of housing census of"),
    (5, "Census of Housing"), (6, "---"),
]
BODIES = [
    (1, "The Census of Housing, and the housing census of housing census of housing."),
    (2, "No name here"), (3, "census census CENSUS"), (4, None),
]


@pytest.mark.parametrize("skip", [0, 1])
def test_mentions(spark, rows, skip):
    """With and without one-word names; two texts share their key, two have none."""
    names = [n for n in NAMES if not (skip and n[1] == "census")]
    bodies = BODIES + [(1, "housing census, a housing census"), (None, "the census of housing"), (None, "census")]
    want = []
    for doc_id, body in bodies:
        tokens = re.findall(r"\w+", (body or "").lower())
        for name_id, name in names:
            parts = re.findall(r"\w+", name.lower())
            at = [i for i in range(len(tokens)) if parts and tokens[i : i + len(parts)] == parts]
            if at:
                want.append((doc_id, name_id, len(at), at[0]))
    got = link.mentions(
        spark.createDataFrame(bodies, "doc_id long, text string"),
        spark.createDataFrame(names, "name_id long, name string"),
    )
    assert rows(got) == sorted(want, key=repr)


def test_mentions_of_many_names(spark, rows):
    """No number of names changes the plan or leaves the cluster: thousands of names, all found."""
    names = spark.range(5000).selectExpr("id as name_id", "concat('set ', id, ' of ', id % 7) as name")
    texts = spark.range(50).selectExpr("id as doc_id", "array_join(transform(sequence(id * 100, id * 100 + 99), i -> concat('the Set ', i, ' of ', i % 7, ';')), ' ') as text")
    found = link.mentions(texts, names)
    assert rows(found) == sorted(((i // 100, i, 1, i % 100 * 5 + 1) for i in range(5000)), key=repr)


def test_mentions_of_nothing(spark):
    names = spark.createDataFrame([], "name_id long, name string")
    got = link.mentions(spark.createDataFrame(BODIES, "doc_id long, text string"), names)
    assert got.columns == ["doc_id", "name_id", "n", "first_pos"] and got.isEmpty()


def test_scores(spark, rows):
    predictions = spark.createDataFrame(
        [(1, 10, 0.9), (1, 11, 0.8), (1, 12, 0.7), (1, 10, 0.1), (2, 20, 0.5)],
        "doc_id long, dataset_id long, score double",
    )
    truth = spark.createDataFrame(
        [(1, 10), (1, 12), (1, 12), (2, 21), (3, 30)], "doc_id long, dataset_id long"
    )
    # Two true datasets for document 1, so its first two predictions count.
    assert rows(link.score_documents(predictions, truth)) == [
        (1, 2, 1, 0.5), (2, 1, 0, 0.0), (3, 1, 0, 0.0)
    ]
    assert rows(link.score_documents(predictions, truth, k=1)) == [
        (1, 2, 1, 1.0), (2, 1, 0, 0.0), (3, 1, 0, 0.0)
    ]
    row = link.score_predictions(predictions, truth).first()
    assert row["documents"] == 3 and row["score"] == pytest.approx(0.5 / 3)


def test_incremental(spark, tmp_path):
    folder, target, memory = (str(tmp_path / n) for n in ("in", "out", "seen"))
    (tmp_path / "in").mkdir()

    def run():
        incremental.incremental_phrases(spark, folder, memory, target).awaitTermination()
        return spark.read.parquet(target).select("doc_id").distinct().count()

    (tmp_path / "in/a.txt").write_text("graph rank\n\ngraph words")
    (tmp_path / "in/b.txt").write_text("graph rank")
    assert run() == 2
    before = spark.read.parquet(target).count()
    assert run() == 2 and spark.read.parquet(target).count() == before
    (tmp_path / "in/c.txt").write_text("one more text")
    assert run() == 3
    assert spark.read.parquet(target).select("doc_id", "rk").distinct().count() == spark.read.parquet(target).count()

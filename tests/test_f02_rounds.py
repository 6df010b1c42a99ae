"""F2 of the third round: rounds shuffle shares alone, on rows made here."""

import re

from corpusloom.operators import rank

TEXTS = [
    (1, "alpha beta the gamma alpha; beta delta"), (2, " ".join(f"w{i * i % 97} w{i % 31}" for i in range(400))),
    (3, "alone"), (4, None), (5, ""), (6, "the of"), (7, "x y the z " * 9), (None, "alpha beta"),
]


def toks(spark, texts):
    return rank.default_tokenizer(["doc_id"])(spark.createDataFrame(texts, "doc_id long, text string"))


def test_f2_blocks_of_any_size_give_the_same_ranks(spark, rows):
    want = rows(rank.textrank_in_rows(toks(spark, TEXTS[:-1]), ["doc_id"], None, rounds=6))
    for most in (7, 1 << 11):
        assert rows(rank.textrank_by_rounds(toks(spark, TEXTS), ["doc_id"], None, rounds=6, cut_every=4, most=most)) == want


def test_f2_rows_that_share_their_key_are_one_document(spark, rows):
    got = rows(rank.textrank_by_rounds(toks(spark, TEXTS + TEXTS), ["doc_id"], 5, rounds=3, most=7))
    once = rows(rank.textrank_by_rounds(toks(spark, TEXTS), ["doc_id"], 5, rounds=3))
    assert got == [(d, rk, p, 2 * n, score) for d, rk, p, n, score in once]


def test_f2_no_round_shuffles_words_or_links(spark):
    found = rank.textrank_by_rounds(toks(spark, TEXTS), ["doc_id"], 5, rounds=3, most=7)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    kinds = re.findall(r"Exchange hashpartitioning\(doc_id#\d+L, block#\d+, \d+\), (\w+)", plan)
    assert len(kinds) >= 4 and set(kinds) == {"REPARTITION_BY_NUM"}  # blocks, and the mail of each round

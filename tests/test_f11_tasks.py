"""F11, F13, F14, F15 of the third round: tasks grow in number with the input."""

import pytest

import corpusloom.session as session
from corpusloom.operators import rank, versions


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "PER_TASK", 1 << 10)


def test_f14_phrases_are_dealt_before_they_are_counted(spark, rows, tmp_path, small_tasks):
    spark.range(2000).selectExpr("id % 7 doc_id", "cast(id % 5 as string) phrase", "cast(id as int) rk", "id cnt", "1.0 rank_score").coalesce(1).write.parquet(f"{tmp_path}/p")
    frame = spark.read.parquet(f"{tmp_path}/p")
    for found in (rank.phrase_counts(frame), rank.unique_phrases(frame)):
        assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    assert sum(r[2] for r in rows(rank.phrase_counts(frame))) == 2000


def test_f13_pairs_of_texts_are_dealt(spark, tmp_path, small_tasks):
    log = [(d, v, "\n".join(f"{i}" for i in range(d * v, 40))) for d in range(20) for v in (1, 2, 3)]
    spark.createDataFrame(log, "doc_id long, ver int, text string").coalesce(1).write.parquet(f"{tmp_path}/log")
    found = versions.line_changes(spark.read.parquet(f"{tmp_path}/log"))
    assert "RoundRobinPartitioning" in found._jdf.queryExecution().toString()
    kept = found.where("doc_id = 10 and ver = 1").groupBy("change").count().collect()
    assert {tuple(r) for r in kept} == {("kept", 20), ("removed", 10)}
    assert found.where("doc_id = 10 and ver = 2 and no = 1").first()["old_no"] == 1

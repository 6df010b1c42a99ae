"""F10 of the third round: texts are dealt out before they are cut into words, on rows made here."""

import corpusloom.session as session
from corpusloom.operators import link


def test_f10_texts_are_dealt_and_not_sorted(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "PER_TASK", 1 << 10)
    texts = spark.range(300).selectExpr("id % 250 doc_id", "concat('a set ', id % 3, ' a set a set ', id % 3) text")
    texts.coalesce(1).write.parquet(f"{tmp_path}/d")
    names = spark.createDataFrame([(1, "set 1"), (2, "a"), (3, "a set a")], "name_id long, name string")
    found = link.mentions(spark.read.parquet(f"{tmp_path}/d"), names)
    plan = found._jdf.queryExecution().toString()
    assert "sort_array" not in plan and "RoundRobinPartitioning" in plan
    got = found.collect()
    assert len(got) == 700 and {tuple(r)[1:] for r in got} == {(1, 2, 1), (2, 3, 0), (3, 1, 3)}

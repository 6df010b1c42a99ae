"""F3 of the third round, on rows made here."""

from pyspark.sql import functions as F

from corpusloom.operators import rank
from corpusloom.session import PER_TASK, dealt


def test_f3_tasks_grow_in_number_with_the_input(spark, tmp_path, monkeypatch):
    import corpusloom.session as session

    spark.range(20000).withColumn("text", F.uuid()).coalesce(1).write.parquet(f"{tmp_path}/t")
    frame = spark.read.parquet(f"{tmp_path}/t")
    assert PER_TASK == 16 << 20 and dealt(frame).rdd.getNumPartitions() == 16
    monkeypatch.setattr(session, "PER_TASK", 1 << 13)
    assert dealt(frame).rdd.getNumPartitions() > 50
    assert dealt(frame).distinct().count() == 20000


def test_f3_documents_of_a_batch_do_not_mix(spark, rows):
    """Many documents are ranked together as each of them alone."""
    texts = ["alpha beta the gamma alpha", "alpha", "", None, "beta beta", "x y z the x y of z q " * 30]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    together = rows(rank.textrank(frame, k=None))
    alone = [r for i in range(len(texts)) for r in rows(rank.textrank(frame.where(F.col("doc_id") == i), k=None))]
    assert together == sorted(alone, key=repr) and len({r[0] for r in together}) == 4

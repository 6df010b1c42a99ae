"""Memory of Python workers: one worker a task, and few rows of a batch at a time."""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm import exact, language


def test_filters_are_merged_and_read_by_one_worker(spark):
    fps = spark.range(0, 3000, 1, 5).select(F.xxhash64(F.col("id") % 1000).alias("fp"))
    fps = fps.union(spark.range(2).select(F.lit(-7).cast("long").alias("fp"))).union(spark.range(50).select(F.col("id").alias("fp")))
    found = exact.repeated_fingerprints(fps, fps.count())
    want = fps.groupBy("fp").count().where("count > 1")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and want.count() == 1001
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    steps = re.findall(r"Exchange|\w*InArrow\b", plan)
    assert steps and not any(a != "Exchange" and b != "Exchange" for a, b in zip(steps, steps[1:]))
    assert exact.repeated_fingerprints(fps.limit(0), 0).count() == 0


def test_batches_are_cut(spark):
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("text"))

    def act(batch):
        n = [batch.num_rows] * batch.num_rows
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "text", "n"])

    rows = language.by_batches(docs, act, "doc_id long, text string, n long").collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == [(i, str(i) if i % 7 else None) for i in range(2000)]
    assert max(r["n"] for r in rows) <= 256

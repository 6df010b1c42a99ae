"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the operators count on. All are ordinary Spark settings; a cluster sets
#: its own number of shuffle partitions and lets AQE merge the small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", memory: str = "12g", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only a local session that names none gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read on from there."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new name for a written table in the shared checkpoint folder."""
    return f"{_checkpoint_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a compressed table in the shared checkpoint folder and read on from there."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Inputs up to this size per core may be spread by a shuffle.
SMALL_PER_CORE = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """Spread an input that is small for the cluster over all its cores.

    A small file is one partition, and work inside rows would keep one core busy.
    Spark's own size estimate decides: a large input already has more partitions
    than there are cores and is not shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(4 * cores) if size <= cores * SMALL_PER_CORE else df


#: Bytes of input files whose rows make one task of work inside rows.
PER_TASK = 16 << 20


def tasks_for(df: DataFrame) -> int | None:
    """Tasks of about ``PER_TASK`` bytes of the tables that ``df`` reads, at least four a core; None if Spark knows no size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = [size for size in sizes if size < 1 << 50]  # rows from the driver or of a stream have no size
    return max(4 * df.sparkSession.sparkContext.defaultParallelism, sum(known) // PER_TASK) if known else None


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows out, by the columns ``by`` if there are any, to tasks of about ``PER_TASK`` bytes of input,
    at least four a core.

    Files may have few and large row groups, and work inside rows takes much longer than a shuffle of them.
    The sizes of the tables that ``df`` reads decide; if Spark knows none of them, rows stay where they are.
    """
    tasks = tasks_for(df)
    return df.repartition(tasks, *by) if tasks else df


def evened(df: DataFrame) -> DataFrame:
    """``dealt``, but rows stay where they are, without a shuffle, if no task has more of them than a core's share.

    Rows are counted by task first, which reads none of their columns if ``df`` reads a table.
    """
    counts = df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"))
    most, total = counts.first()
    return dealt(df) if most and most * df.sparkSession.sparkContext.defaultParallelism > total else df

"""Running totals and look-ahead that do not put a hot key into one task.

Keys are counted first. A key with more than its share of all rows (at most as many keys
as there are shares) is cut into ranges of its order at values drawn from a sample by
hash, so each range holds about one share whatever the values are. Windows run inside a range; what
a range needs of the ranges before or after it is one sum or one value each, a table
no larger than the number of ranges, which is sent to every task. So all rows are
shuffled once, by key and range, and keys of ordinary size are one range.

``order`` is of any type that can be compared, unique per key; a null comes first. The
input is read for the counts, for the hot keys' sample and sums, and for the result: give it
as a table or a checkpoint, not as a plan that is dear to run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows of a range.
PER_RANGE = 32


def range_of(cuts: Column, value: Column) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, by halving."""

    def halved(s: Column, _) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = (s["low"] < s["high"]) & (F.get(cuts, middle) < value)
        return F.struct(
            F.when(below, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(below, s["high"]).otherwise(F.least(s["high"], middle)).alias("high"),
        )

    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(cuts))))
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.aggregate(rounds, start, halved, lambda s: s["low"])


class Ranges:
    """The rows of ``df`` with a column ``_range``; hot keys have several."""

    def __init__(self, df: DataFrame, keys: list[str], order: str, shares: int | None = None):
        spark = df.sparkSession
        shares = shares or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.columns, self.order = df.columns, order
        self.keys = keys or ["_all"]
        df = df if keys else df.withColumn("_all", F.lit(0))
        total = df.count()
        hot = df.groupBy(*self.keys).agg(F.count("*").alias("_n")).where(F.col("_n") * shares > total)
        every = max(1, total // (shares * PER_RANGE))
        drawn = F.pmod(F.xxhash64(order, *self.keys), F.lit(every)) == 0
        sample = self._joined(df.select(*self.keys, order).where(drawn), hot.drop("_n"), "left_semi")
        values = F.sort_array(F.collect_list(order))
        cuts = sample.groupBy(*self.keys).agg(
            F.filter(values, lambda _, i: (i + 1) % PER_RANGE == 0).alias("_cuts")
        )
        fields = [df.schema[k] for k in self.keys]
        schema = T.StructType([*fields, T.StructField("_cuts", T.ArrayType(df.schema[order].dataType))])
        found = [tuple(r) for r in cuts.collect()]  # at most as many keys and values as shares
        placed = self._joined(df, spark.createDataFrame(found, schema), "left")
        place = F.coalesce(range_of(F.col("_cuts"), F.col(order)), F.lit(0))
        self.rows = placed.withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(place))

    def _joined(self, df: DataFrame, table: DataFrame, how: str) -> DataFrame:
        """An equi join with a table of hot keys, at most one row a share; null keys are keys."""
        other = table.select(*[F.col(k).alias(f"_of_{k}") if k in self.keys else F.col(k) for k in table.columns])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        if "_range" in table.columns:
            other = other.withColumnRenamed("_range", "_of_range")
            same = same & (F.col("_range") == F.col("_of_range"))
        joined = df.join(F.broadcast(other), same, how)
        return joined.drop(*[c for c in other.columns if c.startswith("_of_")])

    def window(self):
        return Window.partitionBy(*self.keys, "_range").orderBy(F.asc_nulls_first(self.order))

    def with_neighbours(self, value: Column, kind: T.DataType, fold: Callable[[list], list], out: str) -> DataFrame:
        """``rows`` and a column ``out``: ``fold`` of the aggregates of a hot key's ranges in order, one value a range."""
        hot = self.rows.where(F.col("_cuts").isNotNull())
        by_key: dict[tuple, list] = {}
        for r in hot.groupBy(*self.keys, "_range").agg(value.alias("_v")).collect():  # the ranges of hot keys
            by_key.setdefault(tuple(r)[:-2], []).append((r["_range"], r["_v"]))
        found = []
        for key, parts in by_key.items():
            parts.sort()
            found += [(*key, at, v) for (at, _), v in zip(parts, fold([v for _, v in parts]))]
        fields = [self.rows.schema[k] for k in self.keys]
        schema = T.StructType([*fields, T.StructField("_range", T.IntegerType()), T.StructField(out, kind)])
        return self._joined(self.rows, self.rows.sparkSession.createDataFrame(found, schema), "left")


def _sums_before(sums: list) -> list:
    before, total = [], 0
    for s in sums:
        before.append(total)
        total += s or 0
    return before


def running_total(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, shares: int | None = None
) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this row."""
    ranges = Ranges(df, keys, order, shares)
    rows = ranges.with_neighbours(F.sum(F.col(value).cast("long")), T.LongType(), _sums_before, "_before")
    local = F.sum(value).over(ranges.window().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.coalesce(local, F.lit(0)) + F.coalesce("_before", F.lit(0))
    return rows.select(*ranges.columns, whole.alias(out))


def next_order(
    df: DataFrame, keys: list[str], order: str, out: str, shares: int | None = None
) -> DataFrame:
    """The next larger ``order`` of the same key, null for the last row."""
    ranges = Ranges(df, keys, order, shares)
    kind = df.schema[order].dataType
    rows = ranges.with_neighbours(F.min(order), kind, lambda firsts: [*firsts[1:], None], "_following")
    following = F.coalesce(F.lead(order).over(ranges.window()), "_following")
    return rows.select(*ranges.columns, following.alias(out))


def overlapping_ranges(df: DataFrame, keys: list[str], order: str, again: str, shares: int | None = None) -> DataFrame:
    """The rows of ``df`` with the column ``_range``; neighbours in the order of a key meet in one range.

    Rows with the smallest order of a hot key's range come once more in the range before, with ``again`` true.
    """
    ranges = Ranges(df, keys, order, shares)
    kind = T.StructType([T.StructField("first", df.schema[order].dataType), T.StructField("before", T.IntegerType())])

    def edges(found: list) -> list:
        return [(edge["first"], before) for edge, before in zip(found, [None, *(edge["at"] for edge in found)])]

    rows = ranges.with_neighbours(F.struct(F.min(order).alias("first"), F.min("_range").alias("at")), kind, edges, "_edge")
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("again"))
    before = F.struct(F.col("_edge.before").alias("range"), F.lit(True).alias("again"))
    twice = F.col("_edge.before").isNotNull() & (F.col(order) == F.col("_edge.first"))
    places = F.when(twice, F.array(own, before)).otherwise(F.array(own))
    return rows.select(*ranges.columns, F.inline(places).alias("_range", again))

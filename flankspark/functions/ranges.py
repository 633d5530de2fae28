"""Running aggregates over keys in an order, also where one key holds most rows.

A window puts all rows of a key into one task. Where a key has more than ROWS of them, rows are dealt to ranges of keys and order instead:
each range is scanned by itself, one row of sums a range and key is carried into the ranges behind it, and a join adds the two. So a key of
any size is spread over as many tasks as there are ranges, and the only window over a whole key has a row for each of its ranges.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flankspark.functions.graph import cut_lineage

#: Rows of a key that one task scans.
ROWS = 1_000_000
#: Ranges, at most; beyond, they hold more than ROWS.
MOST_RANGES = 20_000
_FIRST = Window.unboundedPreceding


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of columns, in which nulls are equal."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


class Ordered:
    """Rows by keys and order. An order that leaves rows tied leaves it open which of them is first.

    scan(name, kind, value) adds the sum, max or last value that isn't null of all rows of the key up to the row itself, or with upto=-1
    up to the one before it.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], rows: int | None = None):
        self.keys, self.order = keys, order
        most = ROWS if rows is None else rows
        hottest, total = df.groupBy(*keys).count().agg(F.coalesce(F.max("count"), F.lit(0)), F.sum("count")).first()
        self.split = hottest > most
        if self.split:
            dealt = df.repartitionByRange(min(MOST_RANGES, -(-total // most)), *keys, *order).sortWithinPartitions(*keys, *order)
            df = cut_lineage(dealt.withColumns({"__range": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}))
        self.df = df

    def scan(self, name: str, kind: str, value: str | Column, upto: int = 0) -> Ordered:
        value = F.col(value) if isinstance(value, str) else value
        of = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[kind]
        if not self.split:
            self.df = self.df.withColumn(name, of(value).over(Window.partitionBy(*self.keys).orderBy(*self.order).rowsBetween(_FIRST, upto)))
            return self
        df = self.df.withColumn("__v", value)
        inside = Window.partitionBy("__range", *self.keys).orderBy("__row").rowsBetween(_FIRST, upto)
        whole = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__row"))) if kind == "last" else of("__v")
        sums = df.groupBy("__range", *self.keys).agg(whole.alias("__whole"))
        before = Window.partitionBy(*self.keys).orderBy("__range").rowsBetween(_FIRST, -1)
        carry = sums.withColumn("__carry", of("__whole").over(before)).drop("__whole")
        carry = carry.select(F.col("__range").alias("__r"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], "__carry")
        at = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)], F.col("__range") == F.col("__r"))
        own, carried = F.col("__own"), F.col("__carry")
        both = {"sum": F.when(carried.isNull(), own).otherwise(carried + F.coalesce(own, F.lit(0))), "max": F.greatest(carried, own), "last": F.coalesce(own, carried)}[kind]
        joined = df.withColumn("__own", of("__v").over(inside)).join(carry, at, "left")
        self.df = joined.withColumn(name, both).drop("__r", "__carry", "__own", "__v", *[f"__k{i}" for i in range(len(self.keys))])
        return self

    def done(self) -> DataFrame:
        return self.df.drop("__range", "__row")


def numbered(df: DataFrame, column: str, by: list[str | Column] | None = None) -> DataFrame:
    """df with numbers from 0 without gaps, in the order of by if it is given; written to the checkpoint folder."""
    if by:
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    at = cut_lineage(df.withColumn("__at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("__at", 33).cast("int"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    held = {r[0]: r[1] for r in at.groupBy(part.alias("p")).count().collect()}
    before = np.concatenate([[0], np.cumsum([held.get(p, 0) for p in range(max(held, default=0) + 1)])]).astype("int64")
    return at.withColumn(column, F.get(F.lit(before), part) + inside).drop("__at")

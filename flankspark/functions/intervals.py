"""Joins of points and intervals by bins, and unions of intervals.

A range condition alone would be a nested loop. Each interval is dealt to the bins that it touches, each point to its one bin, and the
equality of key and bin shuffles them together; a point meets an interval in one bin only, so no pair is doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flankspark.functions.ranges import Ordered


def binned(df: DataFrame, first: Column, last: Column, width: int) -> DataFrame:
    """df with a row for each bin from that of first to that of last."""
    return df.withColumn("__bin", F.explode(F.sequence(F.floor(first / width), F.greatest(F.floor(first / width), F.floor(last / width)))))


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str, width: int = 1024) -> DataFrame:
    """Inner join of each point with the intervals of its keys that hold it: start <= point < end."""
    p = points.withColumn("__bin", F.floor(F.col(point) / width))
    i = binned(intervals.where(F.col(start) < F.col(end)), F.col(start), F.col(end) - 1, width)
    joined = p.join(i, [*keys, "__bin"])
    return joined.where((F.col(start) <= F.col(point)) & (F.col(point) < F.col(end))).drop("__bin")


def band_join(left: DataFrame, right: DataFrame, keys: list[str], x: str, y: str, reach: int, closed: bool) -> DataFrame:
    """Inner join on keys where x and y are less than reach apart, or as far where closed. The right side is dealt to three bins."""
    width = max(1, reach)
    r = right.withColumn("__bin", F.explode(F.array(*[F.floor(F.col(y) / width) + d for d in (-1, 0, 1)])))
    far = F.abs(F.col(x) - F.col(y))
    return left.withColumn("__bin", F.floor(F.col(x) / width)).join(r, [*keys, "__bin"]).where(far <= reach if closed else far < reach).drop("__bin")


def union_intervals(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Intervals that overlap or touch become one. Of those with one start only the longest counts."""
    longest = intervals.groupBy(*keys, start).agg(F.max(end).alias(end))
    rows = Ordered(longest, keys, [start]).scan("__before", "max", end, -1)
    rows = rows.scan("__group", "sum", F.when(F.col(start) <= F.col("__before"), 0).otherwise(1))
    return rows.done().groupBy(*keys, "__group").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__group")


def site_counts(sites: DataFrame, keys: list[str], pos: str, tolerance: int) -> DataFrame:
    """How many sites each key has: one, and one more for each gap above the tolerance."""
    places = sites.where(F.col(pos).isNotNull()).select(*keys, pos).distinct()
    rows = Ordered(places, keys, [pos]).scan("__before", "last", pos, -1).done()
    return rows.groupBy(*keys).agg((F.lit(1) + F.count_if(F.col(pos) - F.col("__before") > tolerance)).alias("n_sites"))


def remap_features(features: DataFrame, masks: DataFrame, keys: list[str], width: int = 1024) -> DataFrame:
    """Features(keys, feature_id, start, end) after the masks(keys, start, end), which don't overlap, are cut out.

    A feature with an end strictly inside a mask is dropped; the others move by what was cut before each end. Cut lengths are running sums
    over masks; each end looks up the last mask that ends at or before it.
    """
    own = masks.select(*keys, F.col("start").alias("mask_start"), F.col("end").alias("mask_end"))
    ends = features.select(*keys, "feature_id", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("start").alias("pos")), F.struct(F.lit(1).alias("which"), F.col("end").alias("pos")))).alias("x")).select(*keys, "feature_id", "x.which", "x.pos")
    # Masks and ends in one order: the sum of what was cut so far is the shift.
    events = ends.select(*keys, "pos", F.lit(1).alias("after"), F.lit(0).alias("cut"), "feature_id", "which").unionByName(own.select(*keys, F.col("mask_end").alias("pos"), F.lit(0).alias("after"), (F.col("mask_end") - F.col("mask_start")).alias("cut"), F.lit(None).cast(features.schema["feature_id"].dataType).alias("feature_id"), F.lit(None).cast("int").alias("which")))
    shifted = Ordered(events, keys, ["pos", "after"]).scan("shift", "sum", "cut").done().where("after = 1")
    inside = points_in_intervals(ends.withColumn("probe", F.col("pos")), own.withColumn("from", F.col("mask_start") + 1), keys, "probe", "from", "mask_end", width).select(*keys, "feature_id").distinct()
    moved = shifted.groupBy(*keys, "feature_id").agg(F.max(F.when(F.col("which") == 0, F.col("pos") - F.col("shift"))).alias("new_start"), F.max(F.when(F.col("which") == 1, F.col("pos") - F.col("shift"))).alias("new_end"))
    return moved.join(inside, [*keys, "feature_id"], "left_anti")


def mask_features(features: DataFrame, hits: DataFrame, keys: list[str], min_pident: float = 90.0, min_length: int = 100) -> DataFrame:
    """features(keys, feature_id, start, end) moved by what is cut out of their sequences: the union of good hits(keys, start, end, pident, length).

    Without any good hit on a sequence its features stay as they are.
    """
    good = hits.where((F.col("pident") >= min_pident) & (F.col("length") >= min_length))
    return remap_features(features, union_intervals(good.select(*keys, "start", "end"), keys, "start", "end"), keys)


def excise(seq: Column, masks: Column) -> Column:
    """seq without the masked stretches; masks is an ordered array of structs (start, end) that don't overlap."""
    size = F.length(seq)
    starts = F.concat(F.array(F.lit(0)), F.transform(masks, lambda m: m["end"]))
    ends = F.concat(F.transform(masks, lambda m: m["start"]), F.array(size))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(seq, a + 1, F.greatest(F.lit(0), b - a)))
    return F.array_join(kept, "")

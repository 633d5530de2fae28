"""Coverage depth by sweeps over block ends: no row for each base, and no array for each element."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def depth_segments(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, end, depth) with depth above 0 from blocks (keys, start, end), half open.

    Ends are summed for each position before the running sum, so a hot position is one row.
    """
    ends = blocks.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("d")))).alias("x"))
    steps = ends.groupBy(*keys, F.col("x.pos").alias("start")).agg(F.sum("x.d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("start")
    out = steps.select(*keys, "start", F.lead("start").over(order).alias("end"), F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return out.where("depth > 0 and end is not null")


def breadth(segments: DataFrame, lengths: DataFrame, keys: list[str], depth: int = 10, fraction: float = 0.9) -> DataFrame:
    """(keys, length, covered, frac, keep) for each key with a positive length: the part of its positions with at least depth."""
    deep = segments.where(F.col("depth") >= depth).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    out = lengths.where("length > 0").join(deep, keys, "left").withColumn("covered", F.coalesce("covered", F.lit(0)).cast("long"))
    return out.withColumn("frac", F.col("covered") / F.col("length")).withColumn("keep", F.col("frac") >= fraction)


def coverage_stats(segments: DataFrame, lengths: DataFrame, keys: list[str], window: int = 200) -> DataFrame:
    """Mean and population variance of depth over the whole element, and over its first and last window positions; bases without reads count as 0."""
    s = segments.join(lengths, keys)
    size = F.least(F.lit(window), F.col("length"))

    def within(low, high):
        return F.greatest(F.lit(0), F.least("end", high) - F.greatest("start", low))

    parts = {"": (F.lit(0), F.col("length")), "_first": (F.lit(0), size), "_last": (F.col("length") - size, F.col("length"))}
    sums = s.groupBy(*keys, "length").agg(*[F.sum(f * within(*span)).alias(f"{n}{k}") for k, span in parts.items() for n, f in (("s", F.col("depth")), ("q", F.col("depth") * F.col("depth")))])
    out = lengths.where("length > 0").join(sums, [*keys, "length"], "left").na.fill(0)
    cols = []
    for k in parts:
        over = F.col("length") if not k else size
        mean = F.col(f"s{k}") / over
        cols += [mean.alias(f"mean{k}"), F.greatest(F.lit(0.0), F.col(f"q{k}") / over - mean * mean).alias(f"var{k}")]
    return out.select(*keys, "length", *cols)


def read_stats(reads: DataFrame, keys: list[str], length: str) -> DataFrame:
    return reads.groupBy(*keys).agg(F.count("*").alias("n_reads"), F.sum(length).cast("long").alias("total_bases"), F.bround(F.avg(length), 2).alias("mean_read_length"))

"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Has Spark remove the shuffle files of a run once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share.

    Where that is unset, a local master gets a temporary folder; on a cluster a folder of the driver's own wouldn't do, so that is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in checkpoint_folder. The shuffle files that it was made from go once it is written, not when the driver next collects garbage."""
    spark = df.sparkSession
    checkpoint_folder(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        # The setting holds for frames that are made under it.
        return df.select("*").checkpoint()
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """links(u, v): each v is tied to the least of u and its neighbours; with larger_only, the v above u alone."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = links.join(least, "u")
    if larger_only:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u != v")


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node that has an edge to another; component is the least node of its component.

    Each round ties every node to the least node that it or its neighbours know; the number of rounds grows with the logarithm of the
    longest path, and they end when one changes nothing. Rounds write their edges to the checkpoint folder, so a lost executor costs one round at most.
    """
    now = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u != v").distinct()
    now = cut_lineage(now)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).distinct()
        # Of each edge the larger end is u already.
        now = cut_lineage(_star(large, False).distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()

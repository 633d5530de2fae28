"""Checkpoints leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from flankspark.functions import graph


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_cut_removes_its_shuffle_files(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(graph.CLEANUP, None)
    # The frame is held, so no collection of garbage in the driver can be what removes them.
    dealt = spark.range(1000).selectExpr("id % 7 AS k", "id AS k").toDF("k", "v").repartition("v").groupBy("k").agg(F.sum("v").alias("s"))
    out = graph.cut_lineage(dealt)
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(graph.CLEANUP, None) == setting
    # Both frames can be read afterwards.
    want = {k: sum(range(k, 1000, 7)) for k in range(7)}
    assert {r.k: r.s for r in out.collect()} == want
    assert {r.k: r.s for r in dealt.collect()} == want

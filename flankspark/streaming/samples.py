"""Incremental runs: each run works on the samples that have new files, and leaves the results of all others as they are.

Files of samples lie in one folder, in Parquet. A streaming query over it remembers in its checkpoint which files it has seen, takes all
new ones as one batch and ends. A sample with a new file is worked on as a whole, from all its files, so a sample that comes in several
pieces ends up as in a batch run. Results are partitioned by sample and a batch overwrites the partitions of its samples, so one that is
repeated after a failure leaves the same files. A sample without results has no partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def run_new_samples(spark: SparkSession, inbox: str, out: str, checkpoint: str, schema: str | StructType, work: Callable[[DataFrame], DataFrame], sample: str = "sample") -> int:
    """Applies work to the samples of new files in inbox and writes the results to out; returns how many batches there were (0 or 1).

    work takes all rows of some samples and returns rows with the column sample, each made from rows of its own sample alone.
    """
    batches = []

    def batch(new: DataFrame, number: int) -> None:
        own = new.sparkSession
        changed = new.select(sample).distinct().persist()
        whole = own.read.schema(schema).parquet(inbox).join(changed, sample, "left_semi")
        results = work(whole)
        results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(sample).parquet(out)
        # Samples whose results went away; they are as few as the batch has samples.
        written = own.read.parquet(out).select(F.col(sample).cast("string").alias(sample)).distinct() if _has_files(own, out) else own.createDataFrame([], f"`{sample}` string")
        kept = results.select(F.col(sample).cast("string").alias(sample)).distinct()
        gone = changed.select(F.col(sample).cast("string").alias(sample)).join(written, sample, "left_semi").join(kept, sample, "left_anti")
        for row in gone.collect():
            _remove(own, f"{out}/{sample}={row[0]}")
        changed.unpersist()
        batches.append(number)

    stream = spark.readStream.schema(schema).parquet(inbox).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return len(batches)


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _has_files(spark: SparkSession, path: str) -> bool:
    at, system = _path(spark, path)
    return system.exists(at) and any(s.isDirectory() for s in system.listStatus(at))


def _remove(spark: SparkSession, path: str) -> None:
    at, system = _path(spark, path)
    system.delete(at, True)

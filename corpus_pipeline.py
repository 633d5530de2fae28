"""A corpus from documents to shards, in five stages.

quality rules -> near duplicates -> benchmark decontamination -> mixing to target weights -> sharding. Each stage takes the documents that
the one before has written and returns those it keeps, with the columns of documents; the last returns each document's shard.

Edge cases are those of the operators; a stage that keeps no rows hands on an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.llm import decontaminate, jaccard, mixing, quality, sharding
from flankspark.llm.common import drop_folder, shared_folder
from flankspark.tables import table

#: Parts of the mixture; sources that aren't named have mixing.DEFAULT_WEIGHT.
WEIGHTS = {"src0": 6, "src1": 3}
SHARDS = 8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col("text").alias("__text"))
    kept = quality.judge(own, "__text").where("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id."""
    return jaccard.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col("text").alias("__doc"))
    judged = decontaminate.judge(own, table(spark, sf_dir, "benchmark"), text="__doc", keep=[f"c{i}" for i in range(len(docs.columns))])
    return judged.where("not contaminated").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: files and the rows in them follow its slots."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    mixed = mixing.mix(own, WEIGHTS, source=names["source"], id_col=names["doc_id"], text=names["text"])
    return mixed.repartitionByRange("mix_slot", "mix_offset").sortWithinPartitions("mix_slot", "mix_offset").select(*[F.col(n).alias(c) for c, n in names.items()])


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document; the key is its place in the mixture, so a shard is a stretch of the mixture.

    The place follows from the documents alone, so it is computed again, from ids, sources and checksums, and not read off file names.
    """
    sized = sharding.measured(docs.select("doc_id", "source", "text"))
    placed = mixing.mix(sized, WEIGHTS, crc="text_crc32").withColumn("mix_place", F.col("mix_slot") * mixing.BLOCK_ROWS + F.col("mix_offset"))
    return sharding.place(placed.drop("source_block", "mix_slot", "mix_offset"), SHARDS, "mix_place").drop("__key")


STAGES = [("quality_rules", quality_stage), ("jaccard_join", duplicate_stage), ("decontamination", benchmark_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]
#: Components of links between texts, and the order of a schedule by deadlines, are out of SQL's reach; tests compare brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents; each stage is written to the shared folder and read again, and goes once the next is written."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if before:
            drop_folder(spark, before)
        before = out
    return docs

"""Importance resampling towards a target distribution: hashed word runs, array-scored weights, an exact cutoff by bisection.

1. Features (runs of 1 to max_run words) are counted in hashed buckets, in one pass over each corpus. Every task adds into one array of
   fixed length, so what is shuffled is an array a task, however long the texts are.
2. The gain of a bucket is the scaled logarithm of how much likelier it is in the target. The gains are an array as long as there are
   buckets; each task looks the features of its texts up in it and sums. Noise that follows from the id makes the draw a random one.
3. The draw is the floor(percent * N / 100) highest scores of the N documents with enough words. The score of the last one is found by
   halving an interval: each job counts the rows of the checkpointed scores at PROBES points exactly, so it does four halvings at once.
   Rows that tie at that score are cut by id, and equal ids by row, in the same way. Nothing is sorted or sent to the driver for that.
4. Only the drawn rows are dealt to ranges and sorted; the rows of the ranges before give each range its first rank.

Edge cases: a null text has no words, so no features and weight 0; a null id draws its noise from the empty text and comes last among
ties; repeated rows are drawn and ranked one by one; empty tables give an empty result. Other columns aren't carried.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flankspark.llm.common import ALNUM, LOWER, batched, cut

BUCKETS, SEED, PERCENT, MIN_WORDS, MAX_RUN = 10_000, 2024, 10, 20, 1
#: Points of an interval at which one job counts.
PROBES = 15
#: Lower-cases A-Z and makes a space of every byte that isn't part of a word.
_WORDS = bytes(int(LOWER[b]) if ALNUM[LOWER[b]] else 0x20 for b in range(256))
_NO_ID = 2**63 - 1


def _features(text: bytes | None, max_run: int, buckets: int) -> tuple[int, np.ndarray]:
    """How many words a text has, and the bucket of each of its features."""
    words = (text or b"").translate(_WORDS).split()
    runs = [np.fromiter(map(zlib.crc32, words), np.uint32, len(words))]
    for k in range(2, min(max_run, len(words)) + 1):
        n = len(words) - k + 1
        runs.append(np.fromiter((zlib.crc32(b" ".join(words[i : i + k])) for i in range(n)), np.uint32, n))
    return len(words), np.concatenate(runs) % np.uint32(buckets)


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each text, one at a time."""
    return (x.as_py() for x in batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()))


def count_buckets(texts: DataFrame, text: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; the driver gets one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in _texts(batch, "text"):
                held += np.bincount(_features(t, max_run, buckets)[1], minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["bucket", "n"])

    counts = texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) (S + B) / ((s + 1) (T + B)))) of each of B buckets."""
    all_s, all_t, b = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + b) / ((s + 1.0) * (all_t + b)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def score(docs: DataFrame, gain: np.ndarray, text: str = "text", id_col: str = "doc_id", max_run: int = MAX_RUN, seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of each row."""
    buckets, kind = len(gain), docs.schema[id_col].dataType

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in _texts(batch, "text"):
                n, found = _features(t, max_run, buckets)
                rows.append((n, len(found), int(gain[found].sum())))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]], names=["id", "n_words", "n_features", "weight"])

    schema = T.StructType([T.StructField("id", kind)] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])
    weighed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(weigh, schema)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("long"))


def smallest(rows: DataFrame, value: Column, k: int) -> tuple[int, int, int]:
    """(v, below, upto): the k-th smallest value of rows, and how many values are below v and at most v. k is 1 to the number of rows."""
    low, high, upto = rows.agg(F.min(value), F.max(value), F.count("*")).first()
    below = 0
    # Values up to low - 1 are fewer than k, those up to high aren't.
    while low < high:
        points = sorted({low + (high - low) * i // (PROBES + 1) for i in range(1, PROBES + 1)} | {low})
        counts = rows.agg(*[F.count_if(value <= p) for p in points]).first()
        first = next((i for i, n in enumerate(counts) if n >= k), len(points))
        if first < len(points):
            high, upto = points[first], counts[first]
        if first:
            low, below = points[first - 1] + 1, counts[first - 1]
    return low, below, upto


def draw(scored: DataFrame, k: int) -> DataFrame:
    """scored (id, row, score and others; a checkpoint) with rank: 1 to k of the k highest scores, ties to the smaller id, then row; else null."""
    if k <= 0:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    order = [-F.col("score"), F.coalesce(F.col("id").cast("long"), F.lit(_NO_ID)), F.col("row")]
    tied, left, drawn = scored, k, F.lit(False)
    same = F.lit(True)
    for i, value in enumerate(order):
        v, below, upto = smallest(tied, value, left)
        done = upto == left
        drawn = drawn | (same & (value <= v if done else value < v))
        if done:
            break
        same, tied, left = same & (value == v), tied.where(value == v), left - below
    chosen = scored.where(drawn).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    chosen = cut(chosen)
    held = {r[0]: r[1] for r in chosen.groupBy(F.shiftright("at", 33).alias("p")).count().collect()}
    before = np.concatenate([[0], np.cumsum([held.get(p, 0) for p in range(max(held) + 1)])]).astype("int64")
    rank = F.get(F.lit(before), F.shiftright("at", 33).cast("int")) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")).unionByName(chosen.withColumn("rank", rank.cast("long")).drop("at"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED, text: str = "text", target_text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """id, n_features, weight, score and rank of every document; rank is null for those that aren't drawn. Ids are whole numbers."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"{id_col}: ties go to the smaller id, so ids must be whole numbers")
    batched(docs.sparkSession)
    gain = gains(count_buckets(docs, text, max_run, buckets), count_buckets(target, target_text, max_run, buckets))
    scored = cut(score(docs, gain, text, id_col, max_run, seed).withColumn("row", F.monotonically_increasing_id()))
    enough = F.col("n_words") >= min_words
    n = scored.where(enough).count()
    out = draw(scored.where(enough), percent * n // 100).unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")

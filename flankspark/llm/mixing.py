"""Mixing sources to target weights by Pfair scheduling.

A source is cut into blocks of equal numbers of rows. Under an ideal fluid mixture every source that still has blocks runs at its
target weight. Block k of a source is released when the fluid has finished k of its blocks, and due when it has finished k + 1; the slot
goes to the released block with the earliest deadline. Each source then is never a whole block away from the fluid.

Weights are integers. After each sum of the weights of the running sources (a period), the fluid has finished whole blocks of every
source, so the schedule starts afresh: only one period for each set of running sources is simulated, and the few in which a source
ends. A block's slot follows from its period and its place in it, so slots are computed by a join, and no scheduler sees the blocks.

When a source is used up, the others share its time in proportion to their weights; every row is placed once.

Edge cases: null sources are one source; sources without a weight have DEFAULT_WEIGHT; a last block may be smaller; rows of a source are
dealt to blocks in order of a hash of id and text, equal ones in any order; an empty table gives an empty result. Columns of the
input pass through under any name, but for source_block, mix_slot and mix_offset, which give way. Any number of sources is mixed, as
long as their weights sum to MAX_PERIOD at most; all simulated periods together have no more blocks than there are.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16
DEFAULT_WEIGHT = 2
#: Rows that are numbered in one task, and buckets of rows whose offsets are summed in one.
BUCKET_ROWS, RUN = 20_000, 64
#: The largest sum of the weights, which are whole numbers from 1: a period is simulated in one task.
MAX_PERIOD = 1_000_000
#: Rows of a schedule that is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000


def finished(blocks: np.ndarray, weights: np.ndarray, period: int) -> np.ndarray:
    """Blocks of each source that the fluid has finished after a number of periods."""
    return np.minimum(blocks, weights * period)


def simulate(blocks: np.ndarray, weights: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """(source, block, slot) of the period from its start, by earliest deadline among the released; slots count from the period's start.

    Times of the fluid are exact: with t as the time within a period, in units in which a source that runs all along finishes its
    weight, source i finishes min(left, weight * t), and the slots used are the sum of that over the sources.
    """
    before = finished(blocks, weights, period)
    running = np.flatnonzero(before < blocks)
    rows = [(int(i), min(int(blocks[i] - before[i]), int(weights[i])), int(weights[i])) for i in running]
    # Sources that end at a time, and what those up to it hold and weigh; most periods have no end before their own.
    ending = sorted((Fraction(n, w), n, w) for _, n, w in rows if n < w)
    times, wholes, rates = [t for t, _, _ in ending], [0], [sum(w for _, _, w in rows)]
    for _, n, w in ending:
        wholes.append(wholes[-1] + n)
        rates.append(rates[-1] - w)

    def used(k: int, w: int, up: bool) -> int:
        """Slots that the fluid has used when t = k / w, rounded."""
        at = bisect.bisect_right(times, Fraction(k, w)) if times else 0
        part = rates[at] * k
        return wholes[at] + (-(-part // w) if up else part // w)

    waiting = sorted((used(k, w, False), used(k + 1, w, True), i, k) for i, n, w in rows for k in range(n))
    ready: list[tuple[int, int, int]] = []
    out, at = [], 0
    for slot in range(len(waiting)):
        while at < len(waiting) and waiting[at][0] <= slot:
            heapq.heappush(ready, waiting[at][1:])
            at += 1
        due, i, k = heapq.heappop(ready)
        if slot >= due:
            raise AssertionError("a block missed its deadline")
        out.append((i, int(before[i]) + k, slot))
    return out


def phases(blocks: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(first period, number of periods, slot at which it starts) of runs of equal periods, in order; one that holds an end stands alone."""
    ends = -(-blocks // weights)
    cuts = np.unique(np.concatenate([[0], blocks // weights, ends]))
    # Slots before a cut: all blocks of the sources that have ended by then, and whole periods of the others.
    order = np.argsort(ends)
    at = np.searchsorted(ends[order], cuts, side="right")
    over, going = (np.concatenate([[0], np.cumsum(x[order])])[at] for x in (blocks, weights))
    starts = over + (weights.sum() - going) * cuts
    return list(zip(cuts[:-1].tolist(), np.diff(cuts).tolist(), starts[:-1].tolist(), strict=True))


def numbered(df: DataFrame, group: str, order: Column, parts: DataFrame) -> DataFrame:
    """df with __n, a number from 0 without gaps in each group in order of a hash, then of __tie.

    parts(group, __parts) says into how many buckets of hashes a group is cut; their offsets are summed, so many tasks number a hot group.
    """
    # The hash as a part of all hashes: buckets follow its order.
    at = F.shiftrightunsigned(F.col("__order").bitwiseXOR(F.lit(-(2**63))), 11) / F.lit(float(1 << 53))
    dealt = df.withColumn("__order", order).join(parts, group).withColumn("__bucket", F.floor(at * F.col("__parts"))).drop("__parts")
    totals = dealt.groupBy(group, "__bucket").agg(F.count("*").alias("__held"))
    # Offsets of a group's buckets in two levels, so no task sums all buckets of a hot group.
    totals = totals.withColumn("__run", F.floor(F.col("__bucket") / RUN))
    runs = totals.groupBy(group, "__run").agg(F.sum("__held").alias("__whole"))
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(group, "__run", F.coalesce(F.sum("__whole").over(earlier(group, "__run")), F.lit(0)).alias("__base"))
    in_run = F.coalesce(F.sum("__held").over(earlier(group, "__run", "__bucket")), F.lit(0))
    starts = totals.withColumn("__start", in_run).join(runs, [group, "__run"]).select(group, "__bucket", (F.col("__start") + F.col("__base")).alias("__start"))
    inside = Window.partitionBy(group, "__bucket").orderBy("__order", "__tie")
    out = dealt.withColumn("__in", F.row_number().over(inside) - 1).join(starts, [group, "__bucket"])
    return out.withColumn("__n", F.col("__start") + F.col("__in")).drop("__order", "__bucket", "__start", "__in")


def start_of(starts: np.ndarray, period: Column) -> Column:
    """The last of the ascending starts that isn't above period, by halving; the first one isn't above any."""
    known = F.lit(starts.astype(np.int64))
    steps = F.lit(np.array([1 << k for k in reversed(range(len(starts).bit_length()))], np.int32))
    at = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step) <= period, at + step).otherwise(at))
    return F.get(known, at)


def mix(docs: DataFrame, weights: dict[str, int] | None = None, block_rows: int = BLOCK_ROWS, source: str = "source", id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None, crc: str | None = None) -> DataFrame:
    """Columns of docs named in keep (all if None) with source_block, mix_slot (of the block) and mix_offset (in the block).

    Only the text's checksum matters; where crc names a column that holds it, no text is read. Equal rows apart, the same documents get
    the same places in every run.
    """
    spark = docs.sparkSession
    new = ("source_block", "mix_slot", "mix_offset")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    # One string for each source; no source has the empty prefix of the null one.
    name = F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    # Columns go by number meanwhile, so none clashes with those that are made here.
    own = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    back = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    slim = docs.select(*own, name.alias("__source"), (F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")) if crc is None else F.col(crc)).alias("__crc"), F.col(id_col).cast("string").alias("__id"))
    slim = slim.withColumn("__tie", F.struct(F.col("__id"), F.col("__crc")))
    counts = slim.groupBy("__source").agg(F.count("*").alias("n")).orderBy("__source").limit(MAX_PERIOD + 1).collect()
    if not counts:
        return slim.select(*back, F.lit(0).cast("long").alias("source_block"), F.lit(0).cast("long").alias("mix_slot"), F.lit(0).alias("mix_offset"))
    weight = [(weights or {}).get(r[0][1:] if r[0][0] == "=" else None, DEFAULT_WEIGHT) for r in counts]
    if any(w < 1 for w in weight):
        raise ValueError("weights are positive integers")
    common = math.gcd(*weight)
    weight = [w // common for w in weight]
    if sum(weight) > MAX_PERIOD:
        raise ValueError(f"the weights of the sources sum to more than {MAX_PERIOD}")
    blocks = [math.ceil(r[1] / block_rows) for r in counts]

    names, rows = [r[0] for r in counts], sum(r[1] for r in counts)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = max(1, min(BUCKET_ROWS, rows // (4 * partitions)))
    # From Arrow tables, as rows of lists would need a further kind of Python worker on each executor.
    sources = spark.createDataFrame(pa.table({"__source": pa.array(names, pa.string()), "__parts": pa.array([math.ceil(r[1] / bucket) for r in counts], pa.int64()), "__weight": pa.array(weight, pa.int64())}))
    numbers = numbered(slim, "__source", F.xxhash64("__id", "__crc"), F.broadcast(sources) if len(names) <= BROADCAST_ROWS else sources)
    block = F.floor(F.col("__n") / block_rows)
    numbers = numbers.withColumns({"source_block": block, "mix_offset": (F.col("__n") % block_rows).cast("int"), "__period": F.floor(block / F.col("__weight")), "__place": block % F.col("__weight")})
    blocks, weight = np.array(blocks, np.int64), np.array(weight, np.int64)
    runs = phases(blocks, weight)
    starts = np.array([a for a, _, _ in runs], np.int64)

    numbers = numbers.withColumn("__first", start_of(starts, F.col("__period")))

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, start in batch.itertuples(index=False):
                found = simulate(blocks, weight, first)
                yield pd.DataFrame(
                    {"__source": [names[i] for i, _, _ in found], "__first": first, "__place": [b - first * int(weight[i]) for i, b, _ in found], "__slot": [start + s for _, _, s in found], "__step": len(found)}
                )

    # A row for each block of each simulated period; its size is known, so it is only broadcast where it is small.
    table = spark.createDataFrame(pa.table({"first": pa.array([a for a, _, _ in runs], pa.int64()), "start": pa.array([s for _, _, s in runs], pa.int64())}))
    schedule = table.mapInPandas(slots, "__source string, __first long, __place long, __slot long, __step long")
    size = min(int(blocks.sum()), len(runs) * int(weight.sum()))
    joined = numbers.join(F.broadcast(schedule) if size <= BROADCAST_ROWS else schedule, ["__source", "__first", "__place"])
    slot = F.col("__slot") + (F.col("__period") - F.col("__first")) * F.col("__step")
    return joined.withColumn("mix_slot", slot).select(*back, "source_block", "mix_slot", "mix_offset")

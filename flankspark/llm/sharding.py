"""Sharding by sampled splitters.

1. A sample of keys is drawn with a probability in proportion to each record's size, so its quantiles cut the records into ranges of
   about equal bytes.
2. Records are dealt to ranges by the splitters. Splitters hold a key and a hash of record and row, so a hot key, and equal records, are
   divided too. Ranges that still hold more than their share are subdivided at further sampled keys.
3. Bytes and rows of the pieces, of which there are at most a few for each range, give each piece its offset. A running sum inside a
   piece then places each record exactly, and the shard is the eighth (or n-th) of all bytes in which its middle lies.

So the law is ``bytes``: sizes of shards differ by less than two records. Slots count the rows of a shard without gaps, in key order.
Only sizes and keys are shuffled; of the text nothing but its size and checksum is kept unless the caller adds columns.

Edge cases: null texts have size 1 and checksum null-as-empty (0); null keys come first; repeated rows are split like any others; an
empty table gives an empty result. Columns of the input other than those asked for aren't carried; one asked for that has the name of a
new column raises an error, and write_shards renames it.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flankspark.llm.common import cut

#: Ranges for each shard, at least, and in all, at most; between, a range has about RANGE_BYTES.
RANGES_PER_SHARD, MAX_RANGES, RANGE_BYTES = 16, 8192, 256 << 20
#: Sampled keys for each range.
SAMPLED_KEYS = 16
NEW = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _lookup(values: list, index: Column, kind: str = "long") -> Column:
    """values[index] from a literal array; the values are as many as there are pieces, which is bounded."""
    return F.get(F.lit(np.array(values, dtype="float64" if kind == "double" else "int64")), index.cast("int"))


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """How many of the splitters (key, tie) aren't above a record's."""
    if not splitters:
        return F.lit(0)

    @F.pandas_udf("int")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        n = len(splitters)
        keys, ties = (np.array(x, dtype=np.int64) for x in zip(*splitters, strict=True))
        order = np.lexsort((np.arange(n + len(key)) >= n, np.concatenate([ties, tie.to_numpy(np.int64)]), np.concatenate([keys, key.to_numpy(np.int64)])))
        out = np.empty(n + len(key), np.int32)
        out[order] = np.cumsum(order < n)
        return pd.Series(out[n:])

    return place("__key", "__tie")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with size (UTF-8 bytes and 1) and text_crc32 in the place of the text."""
    clash = {"size", "text_crc32"} & ({*docs.columns} - {text})
    if clash:
        raise ValueError(f"columns have names of new ones: {sorted(clash)}")
    body = F.col(f"`{text}`").cast("string")
    new = [(F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32")]
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], *new)


def assign_shards(docs: DataFrame, n_shards: int = 8, key: Column | None = None, text: str = "text", id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row, in range order of key (default: the id); carry adds columns.

    A carried column with the name of a new one raises an error: it can't be told apart in the result.
    """
    carry = tuple(c for c in carry if c != id_col)
    clash = {*NEW} & {id_col, *carry}
    if clash:
        raise ValueError(f"columns have names of new ones: {sorted(clash)}")
    own = docs.select(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in carry], (F.col(f"`{id_col}`") if key is None else key).alias("__key"), F.col(f"`{text}`").alias("__text"))
    return place(measured(own, "__text"), n_shards, "__key").drop("__key")


def place(sized: DataFrame, n_shards: int, key: str) -> DataFrame:
    """sized, which has size and text_crc32, with law, shard, slot and grown_shard, in range order of key, a column of whole numbers."""
    slim = sized.withColumn("__key", F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))))
    slim = cut(slim.withColumn("__tie", F.xxhash64("__key", "text_crc32", F.monotonically_increasing_id())))
    total, rows = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()

    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * n_shards, math.ceil(total / RANGE_BYTES)))
    share = SAMPLED_KEYS * ranges / max(1, total)
    # A record is drawn if its hash, as a part of all hashes, is below its size's part.
    chance = (F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "__tie"), 11).cast("double")) / float(1 << 53)
    drawn = sorted(tuple(r) for r in slim.where(chance < F.col("size") * share).select("__key", "__tie").collect())
    splitters = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []
    held = {r[0]: (r[1], r[2]) for r in slim.withColumn("__range", _range_of(splitters)).groupBy("__range").agg(F.sum("size"), F.count("*")).collect()}

    # Overfull ranges are cut again, at quantiles of the keys that were drawn from them.
    target, most, more = total / ranges, rows / ranges, []
    for i, (size, n) in held.items():
        parts = max(math.ceil(size / target), math.ceil(n / (4 * most)))
        if size > 2 * target or n > 8 * most:
            low = bisect.bisect_left(drawn, splitters[i - 1]) if i else 0
            high = bisect.bisect_left(drawn, splitters[i]) if i < len(splitters) else len(drawn)
            more += [drawn[low + (high - low) * k // parts] for k in range(1, parts) if high > low]
    splitters = sorted({*splitters, *more})
    count = len(splitters) + 1
    pieces = slim.withColumn("__piece", _range_of(splitters))

    sums = {r[0]: (r[1], r[2]) for r in pieces.groupBy("__piece").agg(F.sum("size"), F.count("*")).collect()}
    bytes_before = np.concatenate([[0], np.cumsum([sums.get(i, (0, 0))[0] for i in range(count)])]).tolist()
    rows_before = np.concatenate([[0], np.cumsum([sums.get(i, (0, 0))[1] for i in range(count)])]).tolist()
    inside = Window.partitionBy("__piece").orderBy("__key", "__tie")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + _lookup(bytes_before[:-1], F.col("__piece"))
    middle = 2 * upto - F.col("size")
    shard = F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(2 * max(1, total)))).cast("int")
    placed = pieces.withColumns({"shard": shard, "__row": F.row_number().over(inside) - 1 + _lookup(rows_before[:-1], F.col("__piece"))})

    # A shard's first row lies in the piece that holds its lower bound, or in the next one with rows; only those are looked at.
    full = [i for i in range(count) if sums.get(i, (0, 0))[1]]
    ends = [bytes_before[i + 1] for i in full]
    at = [bisect.bisect_right(ends, total * s / n_shards) for s in range(n_shards)]
    cutting = sorted({full[min(len(full) - 1, i + d)] for i in at for d in (0, 1)}) if full else []
    near = placed.where(F.col("__piece").isin(cutting)).groupBy("shard").agg(F.min("__row")).collect()
    begin = {r[0]: r[1] for r in near}
    for s in range(n_shards):
        begin.setdefault(s, 0)
    begin[0] = 0
    slot = F.col("__row") - _lookup([begin[s] for s in range(n_shards)], F.col("shard"))
    return placed.withColumns({"slot": slot.cast("long"), "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).drop("__tie", "__piece", "__row")


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, id_col: str = "doc_id", **options) -> None:
    """Writes docs as files in a folder for each shard, in slot order within a file; input columns with a new one's name get ``in_`` before it."""
    own = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns if c in NEW})
    placed = assign_shards(own, n_shards, id_col=id_col, carry=tuple(c for c in own.columns if c != id_col), **options)
    placed.drop("law", "grown_shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

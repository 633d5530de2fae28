"""What the operators of this subpackage share: checkpoints, batch sizes and word hashing over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.functions.graph import checkpoint_folder, cut_lineage

U64 = np.uint64
#: Rows and bytes of an Arrow batch, at most; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
#: Bytes of text that are tokenised at once; a longer text forms a block of its own.
BLOCK_BYTES = 1 << 19


def shared_folder(spark: SparkSession) -> str:
    return checkpoint_folder(spark)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared file system that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Writes df into the checkpoint folder of the session and returns what was written."""
    return cut_lineage(df)


def batched(spark: SparkSession) -> None:
    """Keeps Arrow batches small enough for long texts. Plans run later, so these are values for the session, the same for all operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def most_frequent(counts: DataFrame, key: str, n: str, most: int) -> list[tuple[int, int]]:
    """(key, n) of the most frequent keys, at most so many, in order of n and key.

    A histogram of eighths of octaves, of some hundred rows, says from which count on there are no more than that; only those keys are sent
    to the driver. A sort with a limit would send as many from every partition.
    """
    step = F.floor(F.log2(F.col(n).cast("double")) * 8).cast("int")
    held, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*")).collect(), reverse=True):
        held += r[1]
        if held > most:
            break
        least = r[0]
    if least is None:
        return []
    return sorted((tuple(r) for r in counts.where(step >= least).select(key, n).collect()), key=lambda r: (-r[1], r[0]))


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser that spreads every input bit over the result."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants that follow from the seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


BYTE_CODES = seeds(256, 11)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words between white space: everything but 0x20 and 0x09 to 0x0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words of letters and digits: all bytes but 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F, after lower-casing.
ALNUM = np.ones(256, dtype=bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False


class Words:
    """Hashes of the words of some documents: those of document i are hashes[offsets[i]:offsets[i + 1]].

    starts and ends are byte positions in the block, whose lower-cased bytes are in data.
    """

    __slots__ = ("data", "ends", "hashes", "offsets", "starts")

    def __init__(self, data, starts, ends, hashes, offsets):
        self.data, self.starts, self.ends, self.hashes, self.offsets = data, starts, ends, hashes, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.offsets))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its values; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about size bytes; no text is cut."""
    data, offsets = utf8(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        end = min(end, len(column))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Lower-cases A-Z and hashes the words made of the bytes for which inside holds."""
    data = LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, U64), np.zeros(len(offsets), np.int64))
    word = inside[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = word[heads]
    starts = np.flatnonzero(first)
    places = np.flatnonzero(word)
    begin = np.searchsorted(places, starts)
    sizes = np.diff(np.append(begin, len(places)))
    if len(starts):
        at = np.arange(len(places)) - np.repeat(begin, sizes)
        powers = seeds(max(64, int(sizes.max())), 23)
        hashes = mix(np.add.reduceat(BYTE_CODES[data[places]] * powers[at], begin) + sizes.astype(U64))
    else:
        hashes = np.zeros(0, U64)
    return Words(data, starts, starts + sizes, hashes, np.searchsorted(starts, offsets))


def times(a: int, b: int) -> np.uint64:
    """a * b of single numbers, in 64 bits."""
    return U64(int(a) * int(b) & 0xFFFFFFFFFFFFFFFF)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

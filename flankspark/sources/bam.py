"""BAM files as a Spark data source: read in splits, written one file a sample.

A BAM is a chain of gzip blocks of at most 64 kB, each of which states its compressed size. A split begins with the first block at or behind
its first byte: four magic bytes and the size field, if a block follows where the size says. A record may begin in one block and end in
the next, so the first record of a split is the first place from which on all of a run of blocks parses as records: sizes that add up,
references that exist, names that end, known operations. A split holds the records that begin in its blocks, so each record is one
split's, and memory goes with one block and one record. Records are decoded into Arrow batches.

Writing packs records into blocks without cutting them where they fit, with the tags RG, NM, ZI, ZL, ZR and ZA of those that have them.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from flankspark.sources.archives import _system
from flankspark.sources.bam_batches import decode_all, encode_all

SPLIT_BYTES = 32 << 20
#: Splits of all files from which on they are larger than asked for.
MANY_SPLITS = 256
#: Records and bytes from which on a batch is full.
BATCH, BATCH_BYTES = 8192, 8 << 20
#: Of compression: files are about as small as at the usual 6, for a part of its time.
LEVEL = 1
#: Bytes of a record's tags, at most, where its start is searched.
TAG_BYTES = 1 << 20
#: Blocks that have to parse before a place counts as the start of a record.
PROVEN = 3
SCHEMA = (
    "sample string, query_name string, reference string, ref_length int, ref_start int, ref_end int, mapq int, flag int, nm int, cigar array<struct<op: int, len: int>>, query_sequence string, zi float, zl boolean, zr boolean, za boolean"
)
# Fixed values of the format.
MAGIC, BASES = b"\x1f\x8b\x08\x04", "=ACMGRSVTWYHKDBN"
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
CODES = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
COVERS = frozenset((0, 2, 3, 7, 8))
_PAIRS = [BASES[i >> 4] + BASES[i & 15] for i in range(256)]
_NUMBER = {c: i for i, c in enumerate(BASES)}
_FIELDS = struct.Struct("<iiBBHHHiiii")
_INT = struct.Struct("<i")
_ARROW = pa.schema(
    [(n, pa.string()) for n in ("sample", "query_name", "reference")]
    + [(n, pa.int32()) for n in ("ref_length", "ref_start", "ref_end", "mapq", "flag", "nm")]
    + [("cigar", pa.list_(pa.struct([("op", pa.int32()), ("len", pa.int32())]))), ("query_sequence", pa.string()), ("zi", pa.float32()), *[(n, pa.bool_()) for n in ("zl", "zr", "za")]]
)


# ---------------------------------------------------------------- blocks


def block_size(head: bytes) -> int | None:
    """Bytes of the compressed block that head is the start of, or None if it isn't one."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    extra = struct.unpack_from("<H", head, 10)[0]
    at, end = 12, min(len(head), 12 + extra)
    while at + 4 <= end:
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and size == 2 and at + 6 <= end:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def first_block(file, at: int, size: int) -> int:
    """The place of the first block at or behind a byte; the size of the file if there is none."""
    window = 1 << 17
    file.seek(at)
    data = file.read(window + 18)
    found = data.find(MAGIC)
    while found >= 0:
        n = block_size(data[found : found + 64])
        if n:
            file.seek(at + found + n)
            after = file.read(18)
            if not after or block_size(after + bytes(64)):
                return at + found
        found = data.find(MAGIC, found + 1)
    return size


def blocks(file, at: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the blocks from a place on."""
    while True:
        file.seek(at)
        head = file.read(18)
        if not head:
            return
        n = block_size(head + file.read(64))
        if n is None:
            raise ValueError(f"no compressed block at byte {at}")
        file.seek(at)
        data = file.read(n)
        extra = struct.unpack_from("<H", data, 10)[0]
        yield at, zlib.decompress(data[12 + extra : -8], -15)
        at += n


# ---------------------------------------------------------------- records


def read_header(file) -> tuple[list[tuple[str, int]], int, int]:
    """References with their lengths, and where the first record is: the place of a block and bytes into it."""
    data, ends = b"", []
    for at, content in blocks(file, 0):
        ends.append((at, len(data)))
        data += content
        try:
            if data[:4] != b"BAM\x01":
                raise ValueError("not a BAM file")
            at_ = 8 + struct.unpack_from("<i", data, 4)[0]
            n, at_ = struct.unpack_from("<i", data, at_)[0], at_ + 4
            references = []
            for _ in range(n):
                size = struct.unpack_from("<i", data, at_)[0]
                name = data[at_ + 4 : at_ + 3 + size].decode()
                references.append((name, struct.unpack_from("<i", data, at_ + 4 + size)[0]))
                at_ += 8 + size
        except struct.error:
            continue
        place, before = max((b for b in ends if b[1] <= at_), key=lambda b: b[1])
        return references, place, at_ - before
    raise ValueError("not a BAM file")


def record_size(data: bytes, at: int, lengths: list[int]) -> int | None:
    """Bytes of the record at a place with its size field, -1 if data ends before it can be told, None if no record can be there."""
    if at + 36 > len(data):
        return -1
    size = struct.unpack_from("<i", data, at)[0]
    ref, pos, n_name, _, _, n_ops, _, n_seq, next_ref, next_pos, _ = _FIELDS.unpack_from(data, at + 4)
    n = len(lengths)
    least = 32 + n_name + 4 * n_ops + (n_seq + 1) // 2 + n_seq
    if not (-1 <= ref < n and -1 <= next_ref < n and n_name > 0 and n_seq >= 0 and pos >= -1 and next_pos >= -1 and least <= size <= least + TAG_BYTES):
        return None
    if ref >= 0 and pos > lengths[ref]:
        return None
    name = data[at + 36 : at + 36 + n_name]
    if len(name) == n_name and (name[-1] != 0 or any(not 33 <= c <= 126 for c in name[:-1])):
        return None
    ops = data[at + 36 + n_name : at + 36 + n_name + 4 * n_ops]
    if any(c & 15 > 8 for c in ops[::4]):
        return None
    return 4 + size


def _parses(data: bytes, at: int, lengths: list[int]) -> bool:
    """Whether records follow each other from a place to the end of data."""
    while at < len(data):
        n = record_size(data, at, lengths)
        if n is None:
            return False
        if n < 0:
            return True
        at += n
    return True


def decode(data: bytes, references: list[tuple[str, int]]) -> dict:
    """The fields of one record, without its size."""
    ref, pos, n_name, mapq, _, n_ops, flag, n_seq, _, _, _ = _FIELDS.unpack_from(data, 0)
    at = 32 + n_name
    ops = [{"op": x & 15, "len": x >> 4} for x in struct.unpack_from(f"<{n_ops}I", data, at)]
    at += 4 * n_ops
    half = (n_seq + 1) // 2
    seq = "".join([_PAIRS[b] for b in data[at : at + half]])[:n_seq]
    tags = read_tags(data, at + half + n_seq)
    name, length = references[ref] if ref >= 0 else (None, None)
    flagged = lambda k: None if k not in tags else tags[k] == 1
    return {
        "sample": tags.get("RG"), "query_name": data[32 : 31 + n_name].decode(), "reference": name, "ref_length": length, "ref_start": pos if pos >= 0 or ref >= 0 else None,
        "ref_end": pos + sum(o["len"] for o in ops if o["op"] in COVERS) if ops else None, "mapq": mapq, "flag": flag, "nm": tags.get("NM"), "cigar": ops or None, "query_sequence": seq or None,
        "zi": tags.get("ZI"), "zl": flagged("ZL"), "zr": flagged("ZR"), "za": flagged("ZA"),
    }


def read_tags(data: bytes, at: int) -> dict:
    out = {}
    while at + 3 <= len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            out[name], at = data[at:end].decode(), end + 1
        elif kind == "B":
            n = struct.unpack_from("<i", data, at + 1)[0]
            at += 5 + n * SIZES[chr(data[at])]
        else:
            if kind in CODES:
                out[name] = struct.unpack_from(CODES[kind], data, at)[0]
            at += SIZES[kind]
    return out


def encode(row: dict, numbers: dict[str, int]) -> bytes:
    """A record with its size."""
    name, seq, ops = row["query_name"].encode() + b"\0", row["query_sequence"] or "", row["cigar"] or []
    codes = [_NUMBER.get(c, 15) for c in seq.upper()]
    packed = bytes((a << 4) | b for a, b in zip(codes[::2], [*codes[1::2], 0], strict=False))
    ref = numbers.get(row["reference"], -1)
    pos = -1 if row["ref_start"] is None else row["ref_start"]
    tags = b"".join(
        [
            *([b"RGZ" + row["sample"].encode() + b"\0"] if row.get("sample") is not None else []), *([b"NMi" + struct.pack("<i", row["nm"])] if row.get("nm") is not None else []),
            *([b"ZIf" + struct.pack("<f", row["zi"])] if row.get("zi") is not None else []), *([k.upper().encode() + b"C" + bytes([bool(row[k])]) for k in ("zl", "zr", "za") if row.get(k) is not None]),
        ]
    )
    body = _FIELDS.pack(ref, pos, len(name), row["mapq"] or 0, 4680, len(ops), row["flag"] or 0, len(seq), -1, -1, 0) + name + struct.pack(f"<{len(ops)}I", *[(o["len"] << 4) | o["op"] for o in ops]) + packed + b"\xff" * len(seq) + tags
    return struct.pack("<i", len(body)) + body


class Packer:
    """Compressed blocks of what is added; a record goes into one block if it fits."""

    FULL = 0xFF00

    def __init__(self, sink):
        self.sink, self.held = sink, bytearray()

    def add(self, data: bytes) -> None:
        if len(self.held) + len(data) > self.FULL:
            self.flush()
        self.held += data
        while len(self.held) > self.FULL:
            self._put(bytes(self.held[: self.FULL]))
            del self.held[: self.FULL]

    def add_all(self, data: bytes, ends: np.ndarray) -> None:
        """Records, one behind the other, that end at ends."""
        at = 0
        while at < len(data):
            # As many as fit into the block that is held.
            i = int(np.searchsorted(ends, at + self.FULL - len(self.held), side="right"))
            end = int(ends[i - 1]) if i else 0
            if end <= at:
                end = int(ends[np.searchsorted(ends, at, side="right")])
            self.add(data[at:end])
            at = end

    def _put(self, data: bytes) -> None:
        squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
        body = squeeze.compress(data) + squeeze.flush()
        self.sink.write(MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data)))

    def flush(self) -> None:
        if self.held:
            self._put(bytes(self.held))
            self.held.clear()

    def close(self) -> None:
        self.flush()
        self.sink.write(END_OF_FILE)


# ---------------------------------------------------------------- the source


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.bytes = options["path"], int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        system, at = _system(self.path)
        info = system.get_file_info(at)
        files = [info] if info.is_file else sorted((i for i in system.get_file_info(fs.FileSelector(at)) if i.is_file and i.path.endswith(".bam")), key=lambda i: i.path)
        # Where there are many, splits grow towards SPLIT_BYTES, so that a task's own costs stay small beside its records.
        step = max(self.bytes, min(SPLIT_BYTES, -(-sum(i.size for i in files) // MANY_SPLITS)))
        return [Split(i.path, a, min(i.size, a + step)) for i in files for a in range(0, i.size, step)] or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        references: list[tuple[str, int]] = []
        held, starts, sizes, size = [], [], [], 0
        for data, at, references in self._spans(partition):
            if at:
                # Records of a part of data lie one behind the other.
                first, end = at[0][0], at[-1][0] + at[-1][1]
                starts += [size + a - first for a, _ in at]
                sizes += [n - 4 for _, n in at]
                held.append(data[first:end])
                size += end - first
            if len(starts) >= BATCH or size >= BATCH_BYTES:
                yield decode_all(b"".join(held), np.array(starts), np.array(sizes), references, _ARROW)
                held, starts, sizes, size = [], [], [], 0
        if starts:
            yield decode_all(b"".join(held), np.array(starts), np.array(sizes), references, _ARROW)

    def records(self, split: Split) -> Iterator[dict]:
        for data, at, references in self._spans(split):
            for a, n in at:
                yield decode(data[a + 4 : a + n], references)

    def _spans(self, split: Split) -> Iterator[tuple[bytes, list[tuple[int, int]], list[tuple[str, int]]]]:
        """Parts of the content with the (place, bytes with the size field) of the split's records in each, and the references."""
        if not split.path:
            return
        system = _system(self.path)[0]
        with system.open_input_file(split.path) as file:
            size = file.size()
            references, head, skip = read_header(file)
            lengths = [n for _, n in references]
            # Records begin behind the header, so a split that lies inside of it begins there too.
            start = first_block(file, split.start, size)
            if start <= head:
                if split.end <= head:
                    return
                start = head
            else:
                skip = None
            # Bytes not yet decoded, and for each block in them where it ends and whether its records are the split's.
            data, ours = b"", 0
            for at, content in blocks(file, start):
                if skip is None:
                    skip = self._first(file, at, lengths)
                    if skip is None:
                        return
                if at < split.end:
                    ours = len(data) + len(content)
                data += content
                if at >= split.end and skip >= ours:
                    return
                own = []
                while skip + 4 <= len(data) and skip < ours:
                    n = 4 + _INT.unpack_from(data, skip)[0]
                    if skip + n > len(data):
                        break
                    own.append((skip, n))
                    skip += n
                yield data, own, references
                if skip >= len(data):
                    skip, ours, data = skip - len(data), 0, b""
                else:
                    data, ours, skip = data[skip:], ours - skip, 0
            if skip < ours and data:
                raise ValueError(f"{split.path}: the last record breaks off")

    def _first(self, file, at: int, lengths: list[int]) -> int | None:
        """Bytes from the start of a block to the first record that begins there or behind it; None without any."""
        data, wanted = b"", PROVEN
        for k, (_, content) in enumerate(blocks(file, at)):
            data += content
            if k + 1 < wanted:
                continue
            found = self._search(data, lengths)
            if found is not None and len(data) - found >= 36:
                return found
            # A record longer than what was looked at: look farther.
            wanted *= 2
        found = self._search(data, lengths)
        return found if found is not None and found < len(data) else None

    @staticmethod
    def _search(data: bytes, lengths: list[int]) -> int | None:
        return next((i for i in range(len(data)) if _parses(data, i, lengths)), None)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.references = options["path"], [tuple(x) for x in json.loads(options["references"])]

    def write(self, iterator) -> WriterCommitMessage:
        system, at = _system(self.path)
        system.create_dir(at, recursive=True)
        numbers = {n: i for i, (n, _) in enumerate(self.references)}
        now = None
        for batch in iterator:
            for sample, rows in self._by_sample(batch):
                if now is None or sample != now[0]:
                    self._finish(system, at, now)
                    name = f"{at}/_{uuid.uuid4().hex}"
                    sink = system.open_output_stream(name)
                    now = sample, name, sink, Packer(sink)
                    text = "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in self.references).encode() + f"@RG\tID:{sample}\n".encode()
                    now[3].add(b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.references)) + b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in self.references))
                found = encode_all(rows, numbers)
                if found:
                    now[3].add_all(*found)
                else:
                    for row in rows.to_pylist():
                        now[3].add(encode(row, numbers))
        self._finish(system, at, now)
        return WriterCommitMessage()

    @staticmethod
    def _by_sample(batch: pa.RecordBatch) -> Iterator[tuple[str | None, pa.RecordBatch]]:
        codes = batch.column("sample").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else []
        for a, b in zip(new, [*new[1:], len(codes)], strict=True) if len(codes) else []:
            yield batch.column("sample")[int(a)].as_py(), batch.slice(a, b - a)

    @staticmethod
    def _finish(system: fs.FileSystem, at: str, now: tuple | None) -> None:
        if now:
            now[3].close()
            now[2].close()
            system.move(now[1], f"{at}/{now[0]}.bam")


class Bam(DataSource):
    @classmethod
    def name(cls) -> str:
        return "alignments_bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


def read_bam(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignments of a BAM file or of all in a folder, with the columns of SCHEMA; sample is the read group."""
    spark.dataSource.register(Bam)
    return spark.read.format("alignments_bam").option("split_bytes", str(split_bytes)).load(path)


def write_bam(rows: DataFrame, references: DataFrame, path: str) -> None:
    """A BAM for each sample, sorted by place; references(reference, length) of all of them go into each header, so they are as few as elements are.

    rows have the columns of read_bam; those of tags may be missing. Qualities aren't kept.
    """
    rows.sparkSession.dataSource.register(Bam)
    known = sorted((r[0], r[1]) for r in references.select("reference", "length").collect())
    # A number that is given isn't lowered, so samples aren't brought together in few tasks.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__no", F.col("reference").isNull()).repartition(n, "sample").sortWithinPartitions("sample", "__no", "reference", "ref_start", "query_name").drop("__no")
    dealt.write.format("alignments_bam").option("references", json.dumps(known)).mode("append").save(path)

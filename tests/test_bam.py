"""BAM files: written, read in splits of any size, and against a file packed without regard to records."""

import random
import struct

from flankspark.sources import bam

REFERENCES = [("E1", 600), ("E2", 900), ("E/3", 50)]


def reads(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        ref = r.choice(["E1", "E2", None])
        ops = [(4, r.randrange(1, 30)), (0, r.randrange(20, 90))] if ref and i % 5 else []
        start = r.randrange(500) if ref else None
        size = sum(k for _, k in ops) or 40
        tags = (r.choice([97.5, None]), r.choice([True, False, None]), i % 2 == 0, None)
        rows.append((f"S{i % 3}", f"read{i}" + "x" * r.randrange(20), ref, dict(REFERENCES).get(ref), start, start + ops[1][1] if ops else None, r.randrange(61), r.choice([0, 16, 4]), r.choice([None, 3]), ops or None, "".join(r.choice("ACGTN") for _ in range(size)) if i % 11 else None, *tags))
    return rows


def test_written_and_read_in_splits(spark, tmp_path):
    rows = reads(4000)
    df = spark.createDataFrame(rows, bam.SCHEMA)
    bam.write_bam(df, spark.createDataFrame(REFERENCES, "reference string, length int"), str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").iterdir()) == ["S0.bam", "S1.bam", "S2.bam"]
    want = sorted(map(tuple, df.collect()), key=repr)
    for size in (3000, 40_000, bam.SPLIT_BYTES):
        got = bam.read_bam(spark, str(tmp_path / "b"), size)
        assert sorted(map(tuple, got.collect()), key=repr) == want
        assert size == bam.SPLIT_BYTES or got.rdd.getNumPartitions() > 3
    one = bam.read_bam(spark, str(tmp_path / "b" / "S1.bam"))
    assert one.select("sample").distinct().collect()[0][0] == "S1"
    bam.write_bam(df.where("false"), spark.createDataFrame(REFERENCES, "reference string, length int"), str(tmp_path / "none"))
    assert bam.read_bam(spark, str(tmp_path / "none")).count() == 0


def test_records_cut_by_blocks(tmp_path):
    """Records that blocks cut anywhere, one of which is longer than several blocks; every split finds its own."""
    rows = [dict(zip([f.split(" ")[0] for f in "sample query_name reference ref_length ref_start ref_end mapq flag nm cigar query_sequence zi zl zr za".split()], x, strict=True)) for x in reads(900, 5)]
    rows[400]["query_sequence"] = "ACGT" * 9000
    for x in rows:
        x["cigar"] = [{"op": a, "len": b} for a, b in x["cigar"] or []]
    numbers = {n: i for i, (n, _) in enumerate(REFERENCES)}
    head = b"BAM\x01" + struct.pack("<ii", 0, len(REFERENCES)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in REFERENCES)
    data = head + b"".join(bam.encode(x, numbers) for x in rows)
    with open(tmp_path / "a.bam", "wb") as sink:
        packer = bam.Packer(sink)
        for at in range(0, len(data), 5000):
            packer._put(data[at : at + 5000])
        packer.close()
    for size in (1, 700, 2500, 10_000, 10**9):
        reader = bam._Reader({"path": str(tmp_path / "a.bam"), "split_bytes": str(max(size, 500))})
        parts = [[x["query_name"] for x in reader.records(p)] for p in reader.partitions()]
        assert [n for p in parts for n in p] == [x["query_name"] for x in rows]


def test_batches_are_as_single_records(tmp_path):
    import numpy as np
    import pyarrow as pa
    import pytest

    from flankspark.sources import bam_batches

    names = [f.split(" ")[0] for f in "sample query_name reference ref_length ref_start ref_end mapq flag nm cigar query_sequence zi zl zr za".split()]
    rows = [dict(zip(names, x, strict=True)) for x in reads(500, 7)]
    for i, x in enumerate(rows):
        x["cigar"] = [{"op": a, "len": b} for a, b in x["cigar"]] if x["cigar"] else None
        x["sample"] = None if i % 7 == 0 else x["sample"]
        x["query_sequence"] = None if i % 11 == 0 else (x["query_sequence"] or "") + "acgtNnRx="[: i % 9]
        x["nm"] = (None, 3, -1, 70000)[i % 4]
    numbers = {n: i for i, (n, _) in enumerate(REFERENCES)}
    batch = pa.RecordBatch.from_pylist(rows, bam._ARROW)
    own = [bam.encode(x, numbers) for x in rows]
    for part in (batch, batch.slice(13, 200), batch.slice(0, 0)):
        got, ends = bam_batches.encode_all(part, numbers)
        at = 13 if part.num_rows == 200 else 0
        assert got == b"".join(own[at : at + part.num_rows]) and list(ends) == list(np.cumsum([len(x) for x in own[at : at + part.num_rows]]))
    # Tags of all kinds, in other orders, some of them twice.
    more = b"XAAxXBBS\x02\0\0\0\1\0\2\0XHH1AE3\0NMc\xfeXZZa text\0XFf\0\0\0\0ZLC\x02NMS\x05\0ZRC\0"
    own += [struct.pack("<i", len(x) - 4 + len(more)) + x[4:] + more for x in own[:60]]
    data, sizes = b"".join(own), np.array([len(x) for x in own])
    want = pa.RecordBatch.from_pylist([bam.decode(x[4:], REFERENCES) for x in own], bam._ARROW)
    found = bam_batches.decode_all(data, np.cumsum(sizes) - sizes, sizes - 4, REFERENCES, bam._ARROW)
    assert found.to_pylist() == want.to_pylist()
    assert bam_batches.encode_all(pa.RecordBatch.from_pylist([rows[1] | {"query_sequence": "AÄ"}], bam._ARROW), numbers) is None
    with pytest.raises(ValueError):
        bam_batches.encode_all(pa.RecordBatch.from_pylist([rows[1] | {"query_name": "x" * 300}], bam._ARROW), numbers)


def test_splits_grow_with_files(tmp_path, monkeypatch):
    (tmp_path / "a.bam").write_bytes(bytes(10_000))
    monkeypatch.setattr(bam, "MANY_SPLITS", 10)
    parts = bam._Reader({"path": str(tmp_path), "split_bytes": "100"}).partitions()
    assert len(parts) == 10 and parts[-1].end == 10_000 and all(a.end == b.start for a, b in zip(parts, parts[1:], strict=False))

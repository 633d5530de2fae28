"""Records of BAM files to and from Arrow batches, a field of all records at a time in numpy; bam.encode and bam.decode do the same for one."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = "=ACMGRSVTWYHKDBN"
_CODE = np.full(256, 15, np.uint8)
for _i, _c in enumerate(LETTERS):
    _CODE[[ord(_c), ord(_c.lower())]] = _i
_PAIRS = np.array([[ord(LETTERS[i >> 4]), ord(LETTERS[i & 15])] for i in range(256)], np.uint8)
_HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("n_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_ops", "<u2"), ("flag", "<u2"), ("n_seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("span", "<i4")])
_KINDS = {"c": "<i1", "C": "<u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4", "f": "<f4"}
_SIZE = np.zeros(256, np.int64)
for _c, _n in {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}.items():
    _SIZE[ord(_c)] = _n
_COVERS = np.isin(np.arange(16), (0, 2, 3, 7, 8))
_FLAGS = ("zl", "zr", "za")


def _each(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all bytes of pieces, one piece behind the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts, where each begins and its length; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8), offsets[:-1], np.diff(offsets)


def _within(values: np.ndarray, low: int, high: int, what: str) -> np.ndarray:
    if len(values) and (values.min() < low or values.max() > high):
        raise ValueError(f"{what} doesn't fit into a record")
    return values


def encode_all(rows: pa.RecordBatch, numbers: dict[str, int]) -> tuple[bytes, np.ndarray] | None:
    """All records with their sizes, and where each ends; None where sequences aren't plain letters."""
    n, column = rows.num_rows, lambda c: rows.column(c) if c in rows.schema.names else None
    if not n:
        return b"", np.zeros(0, np.int64)
    if rows.column("query_name").null_count:
        raise ValueError("a record without a name")
    names, name_at, name_n = _bytes(rows.column("query_name"))
    seqs, seq_at, seq_n = _bytes(rows.column("query_sequence"))
    letters = seqs[_each(seq_at, seq_n)]
    if letters.size and letters.max() >= 128:
        return None
    samples, sample_at, sample_n = _bytes(rows.column("sample"))
    has_sample = rows.column("sample").is_valid().to_numpy(zero_copy_only=False)
    cigar = rows.column("cigar")
    ops_n = pc.fill_null(pc.list_value_length(cigar), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ops = cigar.flatten()
    packed_ops = (ops.field("len").to_numpy(zero_copy_only=False).astype("<u4") << 4) | ops.field("op").to_numpy(zero_copy_only=False).astype("<u4") if len(ops) else np.zeros(0, "<u4")
    if ops.null_count or any(ops.field(c).null_count for c in ("op", "len")):
        raise ValueError("an operation without a length")
    half = (seq_n + 1) // 2
    sized = []
    nm, zi = column("nm"), column("zi")
    valid = lambda c: np.zeros(n, bool) if c is None else c.is_valid().to_numpy(zero_copy_only=False)
    number = lambda c, kind: np.zeros(n, kind) if c is None or pa.types.is_null(c.type) else c.fill_null(pa.scalar(0).cast(c.type)).to_numpy(zero_copy_only=False).astype(kind)
    for name, kind, c, t in [(b"NM", b"i", nm, "<i4"), (b"ZI", b"f", zi, "<f4"), *[(k.upper().encode(), b"C", column(k), "u1") for k in _FLAGS]]:
        values = np.ascontiguousarray(number(c, t)).view("u1").reshape(n, -1)
        sized.append((valid(c), np.concatenate([np.tile(np.frombuffer(name + kind, "u1"), (n, 1)), values], axis=1)))
    rg_n = np.where(has_sample, sample_n + 4, 0)
    name_end = 36 + name_n + 1
    size = name_end + 4 * ops_n + half + seq_n + rg_n + sum(h * v.shape[1] for h, v in sized)
    ends = np.cumsum(size)
    start = ends - size
    out = np.zeros(int(ends[-1]), np.uint8)
    head = np.zeros(n, _HEAD)
    known = pc.index_in(rows.column("reference").cast(pa.string()), value_set=pa.array(list(numbers), pa.string()), skip_nulls=True)
    order = np.array([*numbers.values(), -1], np.int64)
    head["ref"] = order[pc.fill_null(known, len(numbers)).to_numpy(zero_copy_only=False)]
    head["pos"] = rows.column("ref_start").cast(pa.int32()).fill_null(-1).to_numpy(zero_copy_only=False)
    head["size"], head["n_name"], head["bin"], head["next_ref"], head["next_pos"] = _within(size - 4, 0, (1 << 31) - 1, "a record"), _within(name_n + 1, 1, 255, "a name"), 4680, -1, -1
    head["mapq"], head["flag"] = _within(number(rows.column("mapq"), np.int64), 0, 255, "mapq"), _within(number(rows.column("flag"), np.int64), 0, 65535, "flag")
    head["n_ops"], head["n_seq"] = _within(ops_n, 0, 65535, "a cigar"), seq_n
    out[start[:, None] + np.arange(36)] = head.view("u1").reshape(n, 36)
    out[_each(start + 36, name_n)] = names[_each(name_at, name_n)]
    at = start + name_end
    out[_each(at, 4 * ops_n)] = packed_ops.view("u1")
    at = at + 4 * ops_n
    # Two letters a byte; a record of an odd length has a zero behind its last.
    codes = np.zeros(int((2 * half).sum()), np.uint8)
    codes[_each(np.cumsum(2 * half) - 2 * half, seq_n)] = _CODE[letters]
    out[_each(at, half)] = codes[::2] << 4 | codes[1::2]
    at = at + half
    out[_each(at, seq_n)] = 255
    at = at + seq_n
    with_rg = np.flatnonzero(has_sample)
    out[at[with_rg][:, None] + np.arange(3)] = np.frombuffer(b"RGZ", "u1")
    out[_each(at[with_rg] + 3, sample_n[with_rg])] = samples[_each(sample_at[with_rg], sample_n[with_rg])]
    at = at + rg_n
    for has, values in sized:
        i = np.flatnonzero(has)
        out[at[i][:, None] + np.arange(values.shape[1])] = values[i]
        at = at + has * values.shape[1]
    return out.tobytes(), ends


def _texts(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    valid = None if null is None else pa.array(~null).buffers()[1]
    out = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[_each(starts, lengths)])), valid)
    out.validate(full=True)
    return out.cast(pa.string())


def decode_all(data: bytes, starts: np.ndarray, sizes: np.ndarray, references: list[tuple[str, int]], schema: pa.Schema) -> pa.RecordBatch:
    """The records that begin, with their size fields, at starts of data; sizes are without these fields."""
    buf, n = np.frombuffer(data, np.uint8), len(starts)
    head = np.ascontiguousarray(buf[starts[:, None] + np.arange(36)]).view(_HEAD).reshape(n)
    n_name, n_ops, n_seq = (head[c].astype(np.int64) for c in ("n_name", "n_ops", "n_seq"))
    at = starts + 36
    name = _texts(buf, at, n_name - 1)
    at = at + n_name
    ops = np.ascontiguousarray(buf[_each(at, 4 * n_ops)]).view("<u4")
    at = at + 4 * n_ops
    half = (n_seq + 1) // 2
    # Letters of all bytes, from which those of odd lengths leave the last out.
    letters = _PAIRS[buf[_each(at, half)]].reshape(-1)
    seq = _texts(letters, np.cumsum(2 * half) - 2 * half, n_seq, n_seq == 0)
    tags = _tags(buf, at + half + n_seq, starts + 4 + sizes)
    ref, pos = head["ref"].astype(np.int64), head["pos"].astype(np.int64)
    known, placed = pa.array(ref, pa.int64(), mask=ref < 0), (pos >= 0) | (ref >= 0)
    names, lengths = pa.array([r[0] for r in references], pa.string()), pa.array([r[1] for r in references], pa.int32())
    covers = np.concatenate([[0], np.cumsum(np.where(_COVERS[ops & 15], ops >> 4, 0).astype(np.int64))])
    last = np.cumsum(n_ops)
    covered = covers[last] - covers[last - n_ops]
    offsets = pa.array(np.concatenate([[0], last]), pa.int32(), mask=np.concatenate([n_ops == 0, [False]]))
    cigar = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array((ops & 15).astype(np.int32)), pa.array((ops >> 4).astype(np.int32))], ["op", "len"]))
    value = lambda k, kind: pa.array(tags[k][1].astype(kind), mask=~tags[k][0])
    rg_has, rg_at, rg_n = tags["RG"]
    columns = {
        "sample": _texts(buf, rg_at, rg_n, ~rg_has), "query_name": name, "reference": names.take(known), "ref_length": lengths.take(known), "ref_start": pa.array(pos, pa.int32(), mask=~placed),
        "ref_end": pa.array(pos + covered, pa.int32(), mask=n_ops == 0), "mapq": pa.array(head["mapq"].astype(np.int32)), "flag": pa.array(head["flag"].astype(np.int32)), "nm": value("NM", np.int32), "cigar": cigar,
        "query_sequence": seq, "zi": value("ZI", np.float32), **{k: pa.array(tags[k.upper()][1] == 1, mask=~tags[k.upper()][0]) for k in _FLAGS},
    }
    return pa.RecordBatch.from_arrays([columns[c.name].cast(c.type) for c in schema], schema=schema)


def _tags(buf: np.ndarray, at: np.ndarray, end: np.ndarray) -> dict[str, tuple]:
    """(has it, value) of the numbers, (has it, start, length) of the read group; the last of equal tags counts. A step takes the next tag of all records."""
    n, at = len(at), at.copy()
    out: dict[str, tuple] = {k: (np.zeros(n, bool), np.zeros(n)) for k in ("NM", "ZI", *[f.upper() for f in _FLAGS])}
    group = out["RG"] = (np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64))
    zeros = np.flatnonzero(buf == 0)
    rows = np.flatnonzero(at + 3 <= end)
    while len(rows):
        here = at[rows]
        name, kind, here = buf[here].astype(np.int64) << 8 | buf[here + 1], buf[here + 2], here + 3
        size = _SIZE[kind]
        text, array = np.isin(kind, (ord("Z"), ord("H"))), np.flatnonzero(kind == ord("B"))
        if (~text & (size == 0) & (kind != ord("B"))).any():
            raise ValueError("a tag of an unknown kind")
        i = np.flatnonzero(text)
        if len(i):
            stop = np.searchsorted(zeros, here[i])
            if (stop == len(zeros)).any() or (zeros[stop] >= end[rows[i]]).any():
                raise ValueError("a text of a tag doesn't end")
            size[i] = zeros[stop] + 1 - here[i]
            own = i[name[i] == struct.unpack(">H", b"RG")[0]]
            group[0][rows[own]], group[1][rows[own]], group[2][rows[own]] = True, here[own], size[own] - 1
        if len(array):
            count = np.ascontiguousarray(buf[here[array][:, None] + np.arange(1, 5)]).view("<i4")[:, 0].astype(np.int64)
            size[array] = 5 + count * _SIZE[buf[here[array]]]
        for tag in out:
            own = np.flatnonzero((name == struct.unpack(">H", tag.encode())[0]) & ~text) if tag != "RG" else []
            for k in np.unique(kind[own]) if len(own) else []:
                if chr(k) in _KINDS:
                    j = own[kind[own] == k]
                    values = np.ascontiguousarray(buf[here[j][:, None] + np.arange(_SIZE[k])]).view(_KINDS[chr(k)])[:, 0]
                    out[tag][0][rows[j]], out[tag][1][rows[j]] = True, values
        at[rows] = here + size
        rows = rows[at[rows] + 3 <= end[rows]]
    return out

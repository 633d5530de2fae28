"""N-gram Jaccard join by universe partition and pigeonhole, exact.

Words of a text become distinct 5-word shingles, as 64-bit hashes. Two sets with sizes s <= r and similarity 0.75 or more differ in at
most H(s, r) = s + r - 2 * ceil(3 (s + r) / 7) elements. Sizes fall into bands; the band of the smaller set says into how many segments the
hashes are dealt:

* segment subsets: with m segments, at least m - H are equal in both sets. A set may leave out m - H - 1 of its signatures. It leaves out
  the costliest, in an order that is the same for all sets: empty segments, then those whose rarest shingle is frequent, then those of few
  shingles. The cheapest signature that two sets share is left out by neither, so no link is lost.
* one-deletion neighbourhoods, for small sets: with H // 2 + 1 segments one differs by at most one element, so the segment and all that
  remains of it after a deletion are signatures.

A band takes what its signatures and the sets expected to share them by chance cost less (see plan). Frequencies for the order are
gathered from all documents: each batch reports shingles that several of its texts share, and the sums rank them.

Equal sets are one class. Signatures meet by a shuffle; the least class of a bucket leads it. Where a task meets a signature many times,
only rows below its least one so far go to the bucket, and the others to SALTS parts of it, which learn the leader by a join; so a
signature that a third of all texts have isn't put together in one task. A leader and its members are compared in
blocks of bounded size, in two steps. First by parities: the universe is dealt to about twice as many segments as a set has elements, and
one bit a segment says whether the set has an odd number of elements there. Sets that differ in H elements differ in at most H of these
bits, so a block drops every member without a possible partner, and loses no link. Then by the overlaps of the sets, exactly: only
texts that are left travel. Of a leader with several blocks, the members that then are still outside of the component that most of them
are in are compared with all others, in blocks too, once for all leaders with that component. No pair is a row: a block gives at most as
many links as it has members.

Edge cases: a text with 1 to 4 words has its word sequence as one shingle; null texts and texts without words have an empty set and link
with nothing; repeated rows and ties fall into one class; documents that repeat an id are judged by row; an empty table gives an empty
result. Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flankspark.functions.graph import connected_components
from flankspark.llm.common import SPACED, U64, Words, batched, blocks, cut, mix, most_frequent, seeds, signed, times, words_of

WIDTH = 5
#: A batch reports shingles that at least so many of its distinct texts share; so many of all are kept to rank signatures.
LOCAL_SHARED, RANKED = 3, 200_000
#: Sizes from which bands double; each smaller size is a band of its own.
DOUBLING = 16
#: Bits of a filter of document ids: so many for each id, between bounds; a fuller one lets more rows through, and a join decides.
ID_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 27
#: Numbers that a block of parities compares at once.
AT_ONCE = 1 << 20
#: Members of a leader that are compared in one block, and columns of its incidence at once; of open links, a block has BROAD times CHUNK strays and BROAD times PART members.
CHUNK, PART, COLUMNS, BROAD = 256, 512, 4096, 4
#: Shingles of the members of a block, about; so blocks of long texts hold fewer. Two texts are compared at any length.
HELD = 1 << 22
#: A signature that a task has met so many times is dealt to so many parts.
HOT, SALTS = 8, 64
#: Counters of a task, a power of two.
COUNTERS = 1 << 20
PARTS = seeds(WIDTH, 41)
SHORT, BAND, SEGMENT = seeds(3, 43)
EMPTY = np.iinfo(np.int64).max


# ---------------------------------------------------------------- sets


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each document, one after another, and their offsets."""
    h, offsets = words.hashes, words.offsets
    counts = np.diff(offsets)
    n = len(h)
    if n >= WIDTH:
        rolled = sum((h[k : n - WIDTH + 1 + k] * PARTS[k] for k in range(1, WIDTH)), h[: n - WIDTH + 1] * PARTS[0])
        rolled = mix(rolled)
    else:
        rolled = np.zeros(0, U64)
    sets, sizes = [], np.zeros(len(counts), np.int64)
    for i, c in enumerate(counts.tolist()):
        a = offsets[i]
        if c >= WIDTH:
            found = np.sort(rolled[a : a + c - WIDTH + 1])
            if len(found) > 1:
                new = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=new[1:])
                found = found[new]
        elif c:
            found = mix((h[a : a + c] * PARTS[:c]).sum(keepdims=True) + times(SHORT, c))
        else:
            continue
        sizes[i] = len(found)
        sets.append(found)
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), np.concatenate([[0], np.cumsum(sizes)])


def parities(found: np.ndarray) -> bytes:
    """Of each segment, whether a set has an odd number of elements there; segments are a power of two, from twice the set's size up.

    The high half of an element picks the segment, so half as many segments come from folding one half onto the other.
    """
    bits = max(64, 1 << (2 * len(found) - 1).bit_length())
    held = np.bincount(((found >> U64(32)) & U64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


def set_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, from its elements and size; 0 for empty ones."""
    sizes = np.diff(offsets)
    full = sizes > 0
    out = np.zeros(len(sizes), U64)
    if full.any():
        out[full] = mix(np.add.reduceat(mix(values ^ BAND), offsets[:-1][full]) + sizes[full].astype(U64) * SHORT)
    return out


# ---------------------------------------------------------------- signatures


def differ(s: int, r: int) -> int:
    """The most elements in which sets of these sizes may differ."""
    return s + r - 2 * -(-3 * (s + r) // 7)


def most(s_low: int, s_high: int, r_low: int, r_high: int) -> int:
    """The largest difference over ranges of sizes; it rises with the sum but for its rounding, so the last sums decide."""
    top = s_high + r_high
    return max(0, *(differ(t // 2, t - t // 2) for t in range(max(s_low + r_low, top - 7), top + 1)))


def band_of(n: int) -> int:
    return n if n < DOUBLING else DOUBLING + (n // DOUBLING).bit_length() - 1


def sizes_of(band: int) -> tuple[int, int]:
    return (band, band) if band < DOUBLING else (DOUBLING << (band - DOUBLING), (DOUBLING << (band - DOUBLING + 1)) - 1)


@lru_cache(None)
def plan(band: int) -> tuple[int, int]:
    """(elements of deletion neighbourhoods: 0 or 1, segments) of a band, by cost.

    A signature costs one row. Signatures of few elements also meet by chance: with a part P of elements that are common, a signature
    of k elements meets another with a chance of P to the power k, and CLASSES sets stand in the band. The cheaper way is taken.
    """
    common, classes = 0.25, 4096
    low, high = sizes_of(band)
    h = most(low, high, low, 4 * high // 3)
    subsets = h + 1 + -(-h // 3)
    halves = h // 2 + 1
    chance = lambda k: classes * common ** max(k, 0.0)
    by_subsets = (h + 1) * (1 + chance(high / subsets))
    by_deletion = (halves + high) * (1 + chance(high / halves - 1))
    return (1, halves) if band < DOUBLING and by_deletion <= by_subsets else (0, subsets)


@lru_cache(None)
def duties(n: int) -> tuple[tuple[int, int, int, int], ...]:
    """(band, way, segments, H) of every band in which a set of n elements has signatures: its own, and those of smaller partners."""
    own = band_of(n)
    out = [(own, *plan(own), most(n, n, n, 4 * n // 3))]
    least = -(-3 * n // 4)
    for band in range(own - 1, 0, -1):
        low, high = sizes_of(band)
        if high < least:
            break
        out.append((band, *plan(band), most(max(low, least), high, n, n)))
    return tuple(out)


def signatures(values: np.ndarray, mixed: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """All signatures of a set; mixed are its elements mixed once more, rank their frequencies."""
    out = []
    n = len(values)
    for band, way, segments, h in duties(n):
        base = times(BAND, band)
        place = (values % U64(segments)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        at = place[order]
        heads = np.flatnonzero(np.diff(at, prepend=-1))
        sums = np.add.reduceat(mixed[order], heads)
        seg = at[heads]
        if way:
            whole = np.zeros(segments, U64)
            whole[seg] = sums
            less = whole[place] - mixed
            every = np.arange(segments)
            out.append(np.unique(np.concatenate([mix(whole + SEGMENT * every.astype(U64) + base), mix(less + SEGMENT * place.astype(U64) + base)])))
            continue
        sig = mix(sums + SEGMENT * seg.astype(U64) + base)
        if len(sig) > h + 1:
            held = np.diff(heads, append=n)
            sig = sig[np.lexsort((sig, -held, np.minimum.reduceat(rank[order], heads)))[: h + 1]]
        elif len(sig) < h + 1:
            bare = np.setdiff1d(np.arange(segments), seg)
            empty = np.sort(mix(SEGMENT * bare.astype(U64) + base))
            sig = np.concatenate([sig, empty[: h + 1 - len(sig)]])
        out.append(sig)
    return np.concatenate(out)


class Filter:
    """A Bloom filter of 64-bit keys; its bits are a power of two."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(keys: np.ndarray, size: int) -> list[np.ndarray]:
        h = mix(keys.view(U64) ^ SEGMENT)
        return [(h >> U64(k)) & U64(size - 1) for k in (0, 18, 36)]

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for p in self.places(keys, 8 * len(self.bits)):
            out &= (self.bits[p >> U64(3)] >> (p & U64(7)).astype(np.uint8)) & 1 == 1
        return out

    @classmethod
    def of(cls, ids: DataFrame) -> Filter:
        """The filter of a column of ids, of a size that fits their number; each of a few tasks sends its bits."""
        size = min(MOST_BITS, max(LEAST_BITS, 1 << (ID_BITS * ids.count()).bit_length()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flags = np.zeros(size, bool)
            for batch in batches:
                for p in cls.places(as_keys(batch.column(0)), size):
                    flags[p] = True
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], names=["bits"])

        bits = np.zeros(size // 8, np.uint8)
        for row in ids.coalesce(4).mapInArrow(run, "bits binary").toLocalIterator():
            bits |= np.frombuffer(row[0], np.uint8)
        return cls(bits)


def as_keys(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(-(2**63)).to_numpy(zero_copy_only=False).astype(np.int64)


# ---------------------------------------------------------------- passes over the texts


def _set_batches(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for first, _, data, offsets in blocks(column):
        values, places = shingle_sets(words_of(data, offsets, SPACED))
        yield first, values, places, set_ids(values, places)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_shingles, node, shared, odd): shared holds, once a batch, the shingles that several of its distinct texts have; odd the parities of a class, at its first row of a batch."""
    kind = pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64())]))
    for batch in batches:
        sizes, nodes, firsts, odd = [], [], [], []
        known: set[int] = set()
        for _, values, places, ids in _set_batches(batch.column(1)):
            sizes.append(np.diff(places))
            nodes.append(ids)
            for i, node in enumerate(ids.tolist()):
                new = node not in known and node != 0
                if new:
                    known.add(node)
                    firsts.append(values[places[i] : places[i + 1]])
                odd.append(parities(firsts[-1]) if new else None)
        sizes, nodes = np.concatenate(sizes or [np.zeros(0, np.int64)]), np.concatenate(nodes or [np.zeros(0, U64)])
        every = np.sort(np.concatenate(firsts or [np.zeros(0, U64)]))
        heads = np.flatnonzero(np.diff(every, prepend=every[:1] + U64(1))) if len(every) else np.zeros(0, np.int64)
        counts = np.diff(np.append(heads, len(every)))
        shared = counts >= LOCAL_SHARED
        rows: list = [None] * batch.num_rows
        if batch.num_rows:
            rows[0] = [{"h": a, "c": b} for a, b in zip(signed(every[heads[shared]]).tolist(), counts[shared].tolist(), strict=True)]
        node = pa.array(signed(nodes), pa.int64(), mask=sizes == 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), node, pa.array(rows, kind), pa.array(odd, pa.binary())], names=["id", "n_shingles", "node", "shared", "odd"])


def _sign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = shared.value
        seen = Seen()
        for batch in batches:
            known: set[int] = set()
            for _, values, places, ids in _set_batches(batch.column(1)):
                mixed = mix(values)
                rank = np.zeros(len(values), np.int64)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
                    hit = hashes[at] == values
                    rank[hit] = counts[at[hit]]
                found, owners = [], []
                for i, node in enumerate(ids.tolist()):
                    a, b = places[i], places[i + 1]
                    if a == b or node in known:
                        continue
                    known.add(node)
                    found.append(signatures(values[a:b], mixed[a:b], rank[a:b]))
                    owners.append(np.full(len(found[-1]), node, U64))
                if found:
                    sig, node = signed(np.concatenate(found)), signed(np.concatenate(owners))
                    yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node), pa.array(salted(sig, node, seen))], names=["sig", "node", "salt"])

    return run


class Seen:
    """How often a task has met each signature of late, and of hot ones the least node that it has sent to the bucket.

    A signature has a counter in each of two rows and several may share one, so the lesser counts. Counters are halved whenever as many rows
    as there are counters have come, so how many are shared doesn't grow with the task.
    """

    def __init__(self):
        self.counts: np.ndarray = np.zeros((2, COUNTERS), np.int32)
        self.met = 0
        self.sent: dict[int, int] = {}

    def add(self, keys: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Counts distinct keys as often as they are held; how often each has been met."""
        h = mix(keys.view(U64))
        slots = [((h >> U64(k)) & U64(COUNTERS - 1)).astype(np.int64) for k in (0, 32)]
        for row, slot in zip(self.counts, slots, strict=True):
            np.add.at(row, slot, held.astype(np.int32))
        out = np.minimum(self.counts[0][slots[0]], self.counts[1][slots[1]])
        self.met += int(held.sum())
        while self.met >= COUNTERS:
            self.counts >>= 1
            self.met //= 2
        return out


def salted(sig: np.ndarray, node: np.ndarray, seen: Seen | None = None) -> np.ndarray:
    """0 for rows of signatures that the task has met few times of late; of the others -1 for a node below all that it has sent before, which goes to the bucket, and 1 to SALTS for the rest.

    So a task sends some rows for a hot signature, however many texts it has, and the least node of all is among those that meet in the
    bucket. A counter may say a little more than there are; a signature that is dealt early for that loses nothing.
    """
    seen = seen or Seen()
    order = np.lexsort((node, sig))
    heads = np.flatnonzero(np.diff(sig[order], prepend=~sig[order[:1]]))
    held, keys = np.diff(heads, append=len(sig)), sig[order[heads]]
    hot = seen.add(keys, held) >= HOT
    out = np.zeros(len(sig), np.int32)
    parts = np.repeat(hot, held)
    out[order[parts]] = 1 + (mix(node[order[parts]].view(U64) ^ BAND) % U64(SALTS)).astype(np.int32)
    new, least = [], node[order[heads]]
    for i, k, n in zip(np.flatnonzero(hot).tolist(), keys[hot].tolist(), least[hot].tolist(), strict=True):
        if n < seen.sent.get(k, EMPTY) or k not in seen.sent:
            seen.sent[k] = n
            new.append(i)
    out[order[heads[new]]] = -1
    return out


PAIR, LED, LED_BY = 0, 1, 2


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, node, salt) sorted by sig, part and node: (PAIR, leader, member) for each class of a bucket after the first.

    Of signatures that are dealt to parts also (LED_BY, signature, leader), and (LED, signature, member) for the members in parts.
    """
    last_sig = last_node = leader = None
    for batch in batches:
        sig, node, salt = (batch.column(k).to_numpy() for k in range(3))
        parts = salt > 0
        if parts.any():
            yield _found(LED, sig[parts], node[parts])
            sig, node, salt = sig[~parts], node[~parts], salt[~parts]
        if not len(sig):
            continue
        same = np.zeros(len(sig), bool)
        same[1:] = sig[1:] == sig[:-1]
        same[0] = last_sig is not None and sig[0] == last_sig
        repeat = same.copy()
        repeat[1:] &= node[1:] == node[:-1]
        repeat[0] = same[0] and node[0] == last_node
        heads = np.maximum.accumulate(np.where(same, -1, np.arange(len(sig))))
        leaders = np.where(heads >= 0, node[np.maximum(heads, 0)], leader if leader is not None else 0)
        keep, hot = same & ~repeat, salt < 0
        if keep.any():
            yield _found(PAIR, leaders[keep], node[keep])
        if hot.any():
            yield _found(LED_BY, sig[hot], leaders[hot])
        last_sig, last_node, leader = sig[-1], node[-1], leaders[-1]


def _found(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])


def leader_pairs(rows: DataFrame) -> DataFrame:
    """(leader, member) as a, b for each class of a bucket of rows(sig, node, salt) after the first."""
    part = F.greatest("salt", F.lit(0))
    dealt = rows.repartition("sig", part).sortWithinPartitions("sig", part, "node")
    found = cut(dealt.mapInArrow(_meet, "kind int, a long, b long").distinct())
    pairs, led = found.where(F.col("kind") == PAIR).select("a", "b"), found.where(F.col("kind") == LED).select(F.col("a").alias("sig"), "b")
    if led.isEmpty():
        return pairs
    of = F.pmod(F.xxhash64("b"), F.lit(SALTS))
    every = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    # Most signatures that are hot in one task have no row in any part; only leaders that a part asks for are sent to all parts.
    asked = found.where(F.col("kind") == LED_BY).select(F.col("a").alias("sig"), F.col("b").alias("leader")).join(led.select("sig").distinct(), "sig", "left_semi")
    by = asked.withColumn("part", F.explode(every))
    more = led.withColumn("part", of).join(by, ["sig", "part"]).where("leader != b").select(F.col("leader").alias("a"), "b")
    return cut(pairs.unionByName(more).distinct())


def _collect_texts(shared):
    """(node, text) of the documents that the filter lets through; texts are shorter than their sets once shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Filter(shared.value)
        for batch in batches:
            batch = batch.filter(pa.array(wanted.has(as_keys(batch.column(0)))))
            if batch.num_rows:
                nodes = np.concatenate([ids for _, _, _, ids in _set_batches(batch.column(1))])
                full = pa.array(nodes != 0)
                yield pa.RecordBatch.from_arrays([pa.array(signed(nodes)).filter(full), batch.column(1).filter(full)], names=["node", "text"])

    return run


def overlaps(values: np.ndarray, places: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each set of left has in common with each of right, by products of their incidence with shared elements."""
    owner = np.repeat(np.arange(len(places) - 1), np.diff(places))
    _, column, held = np.unique(values, return_inverse=True, return_counts=True)
    # An element of one set only is in no overlap.
    shared = np.flatnonzero(held > 1)
    number = np.full(len(held), -1, np.int64)
    number[shared] = np.arange(len(shared))
    column, owner = number[column], owner
    keep = column >= 0
    column, owner = column[keep], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    counts = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, len(shared), COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        block = np.zeros((len(places) - 1, min(COLUMNS, len(shared) - low)), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        counts += (block[left] @ block[right].T).astype(np.int64)
    return counts


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most n - 1 of the links i - j between n members, which tie the same members together."""
    own, out = list(range(n)), []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = x, y
        while own[a] != a:
            own[a] = a = own[own[a]]
        while own[b] != b:
            own[b] = b = own[own[b]]
        if a != b:
            own[a] = b
            out.append((x, y))
    kept = np.array(out, np.int64).reshape(-1, 2)
    return kept[:, 0], kept[:, 1]


def may_link(odd: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which sets of a block differ in no more parities from another than links allow; a pair needs a left and a right member."""
    out = np.zeros(len(odd), bool)
    level = np.array([len(x) for x in odd])
    for w in np.unique(level):
        own, above = np.flatnonzero(level == w), np.flatnonzero(level == 2 * w)
        low = np.stack([odd[i] for i in own])
        folded = np.stack([odd[i][:w] ^ odd[i][w:] for i in above]) if len(above) else low[:0]
        for others, high in ((own, low), (above, folded)):
            if not len(others):
                continue
            rows = max(1, AT_ONCE // len(others))
            for at in range(0, len(own), rows):
                some, bits = own[at : at + rows], low[at : at + rows]
                step = max(1, AT_ONCE // (len(some) * len(others)))
                far = np.zeros((len(some), len(others)), np.int64)
                for k in range(0, w, step):
                    far += np.bitwise_count(bits[:, None, k : k + step] ^ high[None, :, k : k + step]).sum(2, dtype=np.int64)
                total = sizes[some][:, None] + sizes[others][None, :]
                near = far <= total - 2 * -(-3 * total // 7)
                near &= (some[:, None] != others[None, :]) & (left[some][:, None] & right[others][None, :] | right[some][:, None] & left[others][None, :])
                out[some] |= near.any(1)
                out[others] |= near.any(0)
    return out


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, chunk, part, node, is_left, is_right, n, odd) sorted by a, chunk and part: those that may have a partner in their block."""
    names = ["a", "chunk", "part", "node", "is_left", "is_right"]

    def kept(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        block = pa.Table.from_batches(held).combine_chunks()
        if len(block) < 2:
            return None
        sizes, left, right = (block[k].to_numpy() for k in ("n", "is_left", "is_right"))
        keep = may_link([np.frombuffer(x, U64) for x in block["odd"].to_pylist()], sizes, left, right)
        return block.select(names).filter(pa.array(keep)).combine_chunks().to_batches()[0] if keep.any() else None

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
        new = np.append(last is None or bool((keys[:, 0] != last).any()), (keys[:, 1:] != keys[:, :-1]).any(0))
        bounds = np.flatnonzero(new | (np.arange(len(new)) == 0)).tolist()
        for at, end in zip(bounds, [*bounds[1:], len(new)], strict=True):
            if new[at]:
                if held and (out := kept(held)) is not None:
                    yield out
                held = []
            held.append(batch.slice(at, end - at))
        last = keys[:, -1]
    if held and (out := kept(held)) is not None:
        yield out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a, chunk and part, of which each block is held at a time: (u, v) of links between its left and right members."""
    key, held = None, []

    def links() -> pa.RecordBatch | None:
        node, is_left, is_right, texts = zip(*held, strict=True)
        left, right = np.flatnonzero(is_left), np.flatnonzero(is_right)
        if len(held) < 2 or not len(left) or not len(right):
            return None
        parts = [(v, np.diff(p)) for _, v, p, _ in _set_batches(pa.array(texts, pa.string()))]
        values, sizes = np.concatenate([v for v, _ in parts]), np.concatenate([n for _, n in parts])
        common = overlaps(values, np.concatenate([[0], np.cumsum(sizes)]), left, right)
        near = 100 * common >= 75 * (sizes[left][:, None] + sizes[right][None, :] - common)
        i, j = np.nonzero(near & (left[:, None] != right[None, :]))
        if not len(i):
            return None
        i, j = forest(len(held), left[i], right[j])
        node = np.array(node)
        return pa.RecordBatch.from_arrays([pa.array(node[i], pa.int64()), pa.array(node[j], pa.int64())], names=["u", "v"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *now, node, is_left, is_right, text in zip(*columns, strict=True):
            if now != key:
                if held and (out := links()) is not None:
                    yield out
                key, held = now, []
            held.append((node, is_left, is_right, text))
    if held and (out := links()) is not None:
        yield out


# ---------------------------------------------------------------- the join


def compare_blocks(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v) of the links in each block of members(a, chunk, part, node, is_left, is_right).

    classes(node, id, n, odd) has the parities of each class, docs(id, text) the texts. Parities travel once for each block of a member;
    texts only where they left a possible partner.
    """
    block = ["a", "chunk", "part"]
    columns = "a long, chunk long, part long, node long, is_left boolean, is_right boolean"
    rows = members.join(classes.select("node", "n", "odd"), "node").select(*block, "node", "is_left", "is_right", "n", "odd")
    left = cut(rows.repartition(*block).sortWithinPartitions(*block).mapInArrow(_screen, columns))
    asked = classes.select("node", "id").join(left.select("node").distinct(), "node", "left_semi").select("id")
    wanted = docs.sparkSession.sparkContext.broadcast(Filter.of(asked).bits)
    texts = docs.mapInArrow(_collect_texts(wanted), "node long, text string")
    rows = left.join(texts, "node").select(*block, "node", "is_left", "is_right", "text")
    return rows.repartition(*block).sortWithinPartitions(*block).mapInArrow(_compare, "u long, v long")


def blocks_of(rows: Column, shingles: Column, most: int) -> Column:
    """Into how many blocks members are dealt that are so many and have so many shingles together."""
    return F.greatest(F.ceil(rows / most), F.ceil(shingles / HELD))


def leader_blocks(pairs: DataFrame, degree: DataFrame) -> DataFrame:
    """Each leader a with its members in as many blocks as degree(a, parts) says, the leader in each of them; all in a block are compared with each other."""
    others = pairs.join(degree, "a").select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), F.col("b").alias("node"))
    leaders = degree.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"))
    return others.unionByName(leaders).select("a", F.lit(0).cast("long").alias("chunk"), "part", "node", F.lit(True).alias("is_left"), F.lit(True).alias("is_right"))


def _place(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, n_shingles, node) of each row of docs, and (node, id, group) of each class: its least id, and the component it lies in."""
    spark = docs.sparkSession
    batched(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    about = cut(slim.mapInArrow(_describe, "id long, n_shingles long, node long, shared array<struct<h:long,c:long>>, odd binary"))
    shared = about.where(F.size("shared") > 0).select(F.explode("shared").alias("x")).groupBy("x.h").agg(F.sum("x.c").alias("c"))
    top = most_frequent(cut(shared), "h", "c", RANKED)
    hashes = np.array([h for h, _ in top], np.int64).view(U64)
    order = np.argsort(hashes)
    ranking = spark.sparkContext.broadcast((hashes[order], np.array([c for _, c in top], np.int64)[order]))

    pairs = leader_pairs(slim.mapInArrow(_sign(ranking), "sig long, node long, salt int"))

    # A class has its parities in one row of each batch that it is in.
    classes = cut(about.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.min("n_shingles").alias("n"), F.min("odd").alias("odd")))
    sizes = classes.select(F.col("node").alias("b"), "n")
    degree = cut(pairs.join(sizes, "b").groupBy("a").agg(blocks_of(F.count("*"), F.sum("n"), CHUNK).alias("parts")))
    edges = cut(compare_blocks(leader_blocks(pairs, degree), classes, slim))
    labels = connected_components(edges)
    more = _open_links(pairs, degree, labels, classes, slim)
    if more is not None:
        labels = connected_components(edges.unionByName(more))

    return about.drop("shared", "odd"), classes.select("node", "id").join(labels, "node", "left").withColumn("group", F.coalesce("component", "node"))


def find_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles and component_id (the least id that links reach) of each row of docs."""
    about, grouped = _place(docs, id_col, text)
    least = grouped.groupBy("group").agg(F.min("id").alias("component_id"))
    of = grouped.join(least, "group").select("node", "component_id")
    out = about.join(of, "node", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def _open_links(pairs: DataFrame, degree: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Links between classes of a leader that weren't in one block, as it has several, and that still are in different components."""
    rows = stray_blocks(pairs.join(degree.where("parts > 1").select("a"), "a"), labels, classes)
    return None if rows is None else cut(compare_blocks(rows, classes, docs))


def stray_blocks(pairs: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Blocks (a, chunk, part, node, is_left, is_right) in which all classes of a leader of pairs(a, b), itself included, meet that labels(node, component) has in different components; None if there are none.

    The component that most classes of a leader are in is its home; of two classes in different components, one at least is a stray, outside
    of it. A large group of near copies has many leaders with much the same members, so leaders of one home, which is a in the result, are
    taken together: each stray meets each of their members once.
    """
    members = pairs.unionByName(pairs.select("a", F.col("a").alias("b")).distinct())
    placed = cut(members.join(labels.select(F.col("node").alias("b"), "component"), "b", "left").select("a", "b", F.coalesce("component", "b").alias("c")))
    homes = placed.groupBy("a", "c").agg(F.count("*").alias("n")).groupBy("a").agg(F.max(F.struct("n", "c")).alias("most"), F.count("*").alias("components")).where("components > 1")
    known = placed.join(homes.select("a", F.col("most.c").alias("home")), "a").select(F.col("home").alias("a"), "b", (F.col("c") != F.col("home")).alias("stray")).distinct()
    known = cut(known.join(classes.select(F.col("node").alias("b"), "n"), "b"))
    strays = blocks_of(F.count_if("stray"), F.coalesce(F.sum(F.when(F.col("stray"), F.col("n"))), F.lit(0)), BROAD * CHUNK)
    held = known.groupBy("a").agg(strays.alias("chunks"), blocks_of(F.count("*"), F.sum("n"), BROAD * PART).alias("parts"))
    if held.isEmpty():
        return None
    own = known.join(held, "a").withColumns({"c": F.pmod(F.xxhash64("b"), "chunks"), "p": F.pmod(F.xxhash64("b", F.lit(1)), "parts")})
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    down = F.transform(every(F.col("chunks")), lambda c: F.struct(c.alias("chunk"), F.col("p").alias("part")))
    across = F.when(F.col("stray"), F.transform(every(F.col("parts")), lambda p: F.struct(F.col("c").alias("chunk"), p.alias("part")))).otherwise(F.array().cast("array<struct<chunk:bigint,part:bigint>>"))
    rows = own.withColumn("at", F.explode(F.array_union(down, across)))
    return rows.select("a", "at.chunk", "at.part", F.col("b").alias("node"), (F.col("stray") & (F.col("at.chunk") == F.col("c"))).alias("is_left"), (F.col("at.part") == F.col("p")).alias("is_right"))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the class of the last column's texts in its place."""
    for batch in batches:
        found = [(np.diff(places), ids) for _, _, places, ids in _set_batches(batch.columns[-1])]
        sizes, ids = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, U64))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(signed(ids), pa.int64(), mask=sizes == 0)], names=batch.schema.names)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: that with the least id, and of several with that id one of the least class.

    Rows are judged by id and class, so different texts under one id, or without an id, are judged apart. Rows that a filter of the ids
    in question lets pass don't move.
    """
    # Columns go by number meanwhile, so none clashes with those that are made here.
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    back = [F.col(n).alias(c) for c, n in names.items()]
    docs = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    id_col, text = names[id_col], names[text]
    about, grouped = _place(docs, id_col, text)
    grouped = cut(grouped)
    first = grouped.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first"))
    firsts = grouped.join(first, "group").select("node", F.col("first.id").alias("first_id"), F.col("first.node").alias("first_node"))
    rows = cut(about.select("id", "node"))
    found = rows.where("node is not null").distinct().join(firsts, "node")
    gone = cut(found.where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node")))).select(F.col("id").alias("__id"), F.col("node").alias("__of")))
    twice = cut(rows.groupBy("id").count().where("count > 1").select(F.col("id").alias("__id")))
    repeats = not twice.isEmpty()
    asked = gone.select("__id").unionByName(twice).distinct() if repeats else gone.select("__id")
    bits = docs.sparkSession.sparkContext.broadcast(Filter.of(asked).bits)

    @F.pandas_udf("boolean")
    def maybe(ids):
        import pandas as pd

        return pd.Series(Filter(bits.value).has(ids.fillna(-(2**63)).to_numpy(np.int64)))

    flagged = docs.withColumn("__gone", maybe(F.col(id_col).cast("long")))
    sure = flagged.where("not __gone").drop("__gone")
    # A filter for rows that may go; the join decides.
    open_ = flagged.where("__gone").drop("__gone")
    same_id = F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
    if not repeats:
        return sure.unionByName(open_.join(gone, same_id, "left_anti")).select(*back)
    # An id alone doesn't name a row, so each of these gets its class.
    own = open_.withColumn("__node", F.col(text).cast("string"))
    own = own.mapInArrow(_nodes, T.StructType([*open_.schema, T.StructField("__node", T.LongType())]))
    kept = own.join(gone, same_id & (F.col("__node") == F.col("__of")), "left_anti")
    once = kept.where("__node is null").unionByName(kept.where("__node is not null").dropDuplicates([id_col, "__node"]))
    return sure.unionByName(once.drop("__node")).select(*back)

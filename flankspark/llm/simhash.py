"""SimHash near-duplicates by BK-trees.

1. A task hashes the 3-word shingles of each whole text (XXH64) and adds up their bits; a fingerprint's bit is 1 where over half have it.
   Equal fingerprints become one row before anything is compared.
2. Fingerprints are routed to shards so that no link is lost: of m blocks of bits, two that differ in at most r bits agree in m - r or
   more, so each fingerprint goes to one shard for every choice of m - r blocks, keyed by its bits there. m grows with the number of
   fingerprints, which keeps shards small at any size; a shard with more than TREE fingerprints is dealt to several trees.
3. Each tree is a BK-tree: a node's children are keyed by their whole-number distance to it, and a search follows only the edges within
   the radius of its own distance. A tree meets the fingerprints of its own shard only: those of its part while it is built, those of the
   parts before it, in a stream, once it is. Each task keeps one tree and the forest of its links, never a group's pairs.
4. The links of the forests are joined to components; the least id of each is the class of all documents with one of its fingerprints.

Trees of all fingerprints would grow with the corpus, so none is sent through the driver: a shuffle brings the queries of a shard, and
copies of them for each of its trees, to where the tree is. That is the broadcast of a tree to its queries, bounded by the shard.

Edge cases: null and empty texts have the fingerprint zero and are linked like any other; a text of one or two words is one shingle;
repeated rows and equal texts share a component; a component whose ids are all null has none; no rows give none. Other columns aren't
carried. Ids are whole numbers below 2**62.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flankspark.functions.graph import connected_components
from flankspark.llm.common import batched, cut

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Fingerprints of one tree, about; a shard with more has several.
TREE = 2048
#: Fingerprints that a shard has on average, at most, if bits are spread evenly.
SHARD = 64
#: Shingles whose bits are added up at once.
_CHUNK = 1 << 15
_NO_ID = 1 << 62


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(SHINGLE, len(words))
    ends = list(accumulate(map(len, words)))
    n, hashed = len(words) - size + 1, xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        # Word i ends after the words up to it and i spaces.
        part = range(at, min(n, at + _CHUNK))
        hashes = np.fromiter((hashed(joined[ends[i - 1] + i if i else 0 : ends[i + size - 1] + i + size - 1], SEED) for i in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fp) of each row; fp is the fingerprint as a signed number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py()) for x in batch.column(1).cast(pa.large_binary())), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(work, schema)


# ---------------------------------------------------------------- trees


class BKTree:
    """Whole numbers by their Hamming distances: children of a node are keyed by their distance to it."""

    __slots__ = ("children", "values")

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def __len__(self) -> int:
        return len(self.values)

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all values within the radius; only edges that can lead to one are followed."""
        if not self.values:
            return []
        out, left, values, children = [], [0], self.values, self.children
        while left:
            at = left.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                out.append(at)
            own = children[at]
            if len(own) > 2 * radius + 1:
                left += [own[k] for k in range(d - radius, d + radius + 1) if k in own]
            else:
                left += [c for k, c in own.items() if -radius <= k - d <= radius]
        return out

    def add(self, value: int) -> int:
        """The place of value, which is new unless the tree has it."""
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return 0
        at = 0
        while True:
            d = (self.values[at] ^ value).bit_count()
            if not d:
                return at
            down = self.children[at].get(d)
            if down is None:
                self.children[at][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return len(self.values) - 1
            at = down


class _Part:
    """One tree with the forest of the links that it has found; nodes are those of the tree."""

    __slots__ = ("nodes", "parent", "tree")

    def __init__(self):
        self.tree, self.nodes, self.parent = BKTree(), [], []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def tie(self, found: list[int]) -> int:
        """Joins what belongs together; gives its root."""
        first = self.root(found[0])
        for i in found[1:]:
            self.parent[self.root(i)] = first
        return first

    def plant(self, value: int, node: int, radius: int) -> None:
        found = self.tree.near(value, radius)
        at = self.tree.add(value)
        self.nodes.append(node)
        self.parent.append(at)
        if found:
            self.tie([*found, at])

    def ask(self, value: int, radius: int) -> int | None:
        found = self.tree.near(value, radius)
        return self.nodes[self.tie(found)] if found else None

    def links(self) -> Iterator[tuple[int, int]]:
        return ((self.nodes[i], self.nodes[self.root(i)]) for i in range(len(self.nodes)) if self.parent[i] != i)


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """How many blocks the bits are cut into: the least number over the radius that leaves shards of SHARD fingerprints or fewer."""
    m = radius + 1
    while m < 2 * radius + 3 and n >> _keyed_bits(m, radius) > SHARD:
        m += 1
    return m


def _keyed_bits(m: int, radius: int) -> int:
    """Bits in the smallest key of m - radius of m blocks."""
    return sum(sorted(BITS * (i + 1) // m - BITS * i // m for i in range(m))[: m - radius])


def _routes(fp: Column, m: int, radius: int) -> Column:
    """The keys of the shards of a fingerprint: one for each choice of m - radius blocks, of the choice and the bits there."""
    masks = [sum(((1 << BITS * (i + 1) // m) - (1 << BITS * i // m)) for i in chosen) for chosen in combinations(range(m), m - radius)]
    masks = [x - (1 << 64) if x >> 63 else x for x in masks]
    return F.array(*[F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(x)).alias("bits")) for k, x in enumerate(masks)])


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): a forest of the links within each tree, over points(fp, node) with distinct fingerprints; its components are those of all links."""
    m = blocks_for(points.count(), radius)
    routed = points.withColumn("key", F.explode(_routes(F.col("fp"), m, radius))).select("fp", "node", "key.choice", "key.bits")
    # Shards of one fingerprint have no links; full ones are dealt to parts.
    sizes = routed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1").select("choice", "bits", F.ceil(F.col("n") / TREE).cast("int").alias("parts"))
    dealt = routed.join(sizes, ["choice", "bits"]).withColumn("own", F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int"))
    # A fingerprint is planted in its own part's tree and asks those of all later parts.
    rows = dealt.withColumn("part", F.explode(F.sequence(F.col("own"), F.col("parts") - 1))).select("choice", "bits", "part", (F.col("part") != F.col("own")).alias("asks"), "fp", "node")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["u", "v"]
        now, held = None, _Part()
        for batch in batches:
            u, v = [], []
            for choice, bits, part, asks, fp, node in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now != (choice, bits, part):
                    for a, b in held.links():
                        u.append(a)
                        v.append(b)
                    now, held = (choice, bits, part), _Part()
                fp &= (1 << 64) - 1
                if not asks:
                    held.plant(fp, node, radius)
                elif (other := held.ask(fp, radius)) is not None:
                    u.append(node)
                    v.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=names)
        rest = list(held.links())
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in rest], pa.int64()), pa.array([b for _, b in rest], pa.int64())], names=names)

    shards = rows.repartition("choice", "bits", "part").sortWithinPartitions("choice", "bits", "part", "asks", "fp")
    return shards.mapInArrow(search, "u long, v long")


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) of each distinct fingerprint of prints(id, fp)."""
    own = F.coalesce(F.col("id"), F.lit(_NO_ID) + F.col("fp").bitwiseAND(F.lit(_NO_ID - 1)))
    # Fingerprints without any id that share a node differ in their first two bits at most, so they are linked.
    points = cut(prints.groupBy("fp").agg(F.min("id").alias("id")).select("fp", own.alias("node")))
    tied = connected_components(links(points, radius))
    least = F.coalesce("component", points["node"])
    return points.join(tied, "node", "left").select("fp", F.when(least < _NO_ID, least).alias("component_id"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of each row."""
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"{id_col}: a component is named by its least id, so ids must be whole numbers")
    batched(docs.sparkSession)
    prints = cut(fingerprints(docs, text, id_col).withColumn("id", F.col("id").cast("long")))
    out = prints.join(components(prints, radius), "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

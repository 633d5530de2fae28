"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of an Arrow batch, of at most SHARD_BYTES (a longer text is one by itself). Its words become symbols of the benchmark's vocabulary, all other words one further symbol that
no phrase holds. The Burrows-Wheeler transform of that sequence is kept in a wavelet tree of rank tables; all test phrases are searched
backward through it at once, occurrences are located by walking to sampled suffix positions, and the spans of a document are merged.

The index covers every word that can lie in a match: a phrase holds only vocabulary words, so stretches of them that are shorter than
the shortest phrase are left out, exactly. Only the benchmark is sent to the tasks, in blocks of bounded size, one pass for each.
Documents never move: there is no shuffle.

Edge cases: null or empty texts have no words and no hits; items without words form no phrase; repeated items are one phrase with
several ids; items without an id are searched too, only not listed; repeated documents are judged one by one; empty tables give an empty result, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flankspark.llm.common import ALNUM, U64, batched, blocks, mix, seeds, words_of

WINDOW = 13
#: Bytes of benchmark text whose phrases are sent to the tasks at once; a phrase takes some 30 bytes, and a word begins one phrase at most.
BENCHMARK_BYTES = 16 << 20
#: Bytes of text of a shard; its index takes some 30 times as many for a while.
SHARD_BYTES = 2 << 20
LENGTH = seeds(1, 67)[0]
#: Every so many suffix positions are kept.
SAMPLED = 8


class Wavelet:
    """Ranks of symbols in a sequence, by a wavelet matrix: one bit of the symbols a level, the zeros of each level first."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        at = sequence
        for k in range(bits - 1, -1, -1):
            bit = (at >> k) & 1
            ones = np.zeros(len(at) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append(ones)
            self.zeros.append(len(at) - int(ones[-1]))
            at = np.concatenate([at[bit == 0], at[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        low, high = np.zeros_like(places), places
        for ones, zeros, k in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1), strict=True):
            bit = (symbols >> k) & 1 == 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def symbol(self, places: np.ndarray) -> np.ndarray:
        out, at = np.zeros_like(places), places
        for ones, zeros in zip(self.levels, self.zeros, strict=True):
            bit = ones[at + 1] - ones[at]
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return out


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling: only those whose order is still open are sorted again."""
    n = len(sequence)
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    first = np.ones(n, bool)
    sorted_rank = rank[order]
    first[1:] = sorted_rank[1:] != sorted_rank[:-1]
    heads = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = heads
    while step < n:
        # Groups of equal rank that hold more than one suffix.
        single = first & np.append(first[1:], True)
        places = np.flatnonzero(~single)
        if not len(places):
            break
        suffixes = order[places]
        behind = suffixes + step
        key = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        again = np.lexsort((key, heads[places]))
        suffixes, key, head = suffixes[again], key[again], heads[places][again]
        order[places] = suffixes
        fresh = np.ones(len(places), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (head[1:] != head[:-1])
        first[places] = fresh
        heads = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[order[places]] = heads[places]
        step *= 2
    return order


class FmIndex:
    """Counts and positions of phrases in a sequence of symbols from 1 up."""

    def __init__(self, sequence: np.ndarray):
        text = np.append(sequence, 0)
        order = suffix_array(text)
        self.bits = max(1, int(text.max()).bit_length())
        self.tree = Wavelet(text[order - 1].astype(np.int64), self.bits)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.bits))]).astype(np.int64)
        kept = order % SAMPLED == 0
        self.marks = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]
        self.size = len(text)

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each phrase."""
        n = len(phrases.starts)
        low, high = np.zeros(n, np.int64), np.full(n, self.size, np.int64)
        # A phrase with a word that isn't in the shard needs no search.
        counts = np.zeros(int(phrases.flat.max(initial=0)) + 1, np.int64)
        here = np.diff(self.before)[: len(counts)]
        counts[: len(here)] = here
        absent = np.concatenate([[0], np.cumsum(counts[phrases.flat] == 0)])
        ends = phrases.starts + phrases.lengths
        open_ = absent[ends] == absent[phrases.starts]
        high[~open_] = 0
        live = np.flatnonzero(open_)
        for k in range(1, int(phrases.lengths.max(initial=0)) + 1):
            live = live[(phrases.lengths[live] >= k) & (low[live] < high[live])]
            if not len(live):
                break
            symbols = phrases.flat[ends[live] - k].astype(np.int64)
            low[live] = self.before[symbols] + self.tree.rank(symbols, low[live])
            high[live] = self.before[symbols] + self.tree.rank(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: each walks left until it meets a sampled one."""
        out, walked, open_ = np.full(len(rows), -1, np.int64), 0, np.arange(len(rows))
        at = rows.astype(np.int64)
        while len(open_):
            hit = self.marks[at + 1] > self.marks[at]
            out[open_[hit]] = self.positions[self.marks[at[hit]]] + walked
            open_, at = open_[~hit], at[~hit]
            symbols = self.tree.symbol(at)
            at = self.before[symbols] + self.tree.rank(symbols, at)
            walked += 1
        return out


class Phrases:
    """Distinct windows of benchmark items, and the items that each belongs to.

    All items' words are one array of symbols, flat; a window is a stretch of it, so it takes a start and a length.
    """

    def __init__(self, ids: list[str | None], texts: pa.Array, window: int = WINDOW):
        whole = [words_of(data, offsets, ALNUM) for _, _, data, offsets in blocks(texts)]
        hashes = np.concatenate([*(w.hashes for w in whole), np.zeros(0, U64)])
        counts = np.concatenate([*(np.diff(w.offsets) for w in whole), np.zeros(0, np.int64)])
        del whole
        self.ids = ids
        self.vocabulary, flat = np.unique(hashes, return_inverse=True)
        self.flat = (flat + 1).astype(np.int32)
        held = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(counts), dtype=np.int32), held)
        starts = np.repeat(np.cumsum(counts) - counts - (np.cumsum(held) - held), held) + np.arange(int(held.sum()))
        lengths = np.minimum(counts, window)[item].astype(np.int64)
        places = seeds(window, 61)
        keys = lengths.astype(U64) * LENGTH
        for k in range(min(window, int(lengths.max(initial=0)))):
            inside = np.flatnonzero(lengths > k)
            keys[inside] += mix(hashes[starts[inside] + k]) * places[k]
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        self.starts, self.lengths = starts[first], lengths[first]
        pairs = np.unique(which * max(1, len(counts)) + item)
        self.owners = (pairs % max(1, len(counts))).astype(np.int32)
        self.owned = np.searchsorted(pairs // max(1, len(counts)), np.arange(len(first) + 1))
        self.shortest = int(self.lengths.min()) if len(first) else 0
        size = 1 << max(10, int(len(self.vocabulary) * 8).bit_length())
        self.filter = np.zeros(size, bool)
        self.filter[self.vocabulary & U64(size - 1)] = True

    def items_of(self, phrases: np.ndarray) -> set[str]:
        """Ids of the items that hold any of the phrases; items without an id have none to list."""
        found = {i for p in phrases.tolist() for i in self.owners[self.owned[p] : self.owned[p + 1]].tolist()}
        return {self.ids[i] for i in found if self.ids[i] is not None}

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word, 0 for words outside the vocabulary."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.filter[hashes & U64(len(self.filter) - 1)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        out[maybe] = np.where(self.vocabulary[at] == hashes[maybe], at + 1, 0)
        return out


def shard_hits(symbols: np.ndarray, document: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(start word, phrase) of every occurrence in a shard; no occurrence crosses a document."""
    none = np.zeros(0, np.int64)
    if not len(phrases.starts) or not len(symbols):
        return none, none
    known = symbols > 0
    new = np.ones(len(symbols), bool)
    new[1:] = ~known[:-1] | ~known[1:] | (document[1:] != document[:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(symbols)))
    long = known[heads] & (sizes >= phrases.shortest)
    if not long.any():
        return none, none
    # The stretches one after another, each followed by the symbol of all other words.
    heads, sizes = heads[long], sizes[long]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    source = np.repeat(heads - starts, sizes + 1) + np.arange(int((sizes + 1).sum()))
    other = len(phrases.vocabulary) + 1
    sequence = symbols[np.minimum(source, len(symbols) - 1)]
    sequence[starts + sizes] = other
    index = FmIndex(sequence)
    low, high = index.search(phrases)
    counts = high - low
    hit = np.flatnonzero(counts)
    if not len(hit):
        return none, none
    rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(counts[hit])[:-1]]), counts[hit]) + np.arange(int(counts[hit].sum()))
    return source[index.locate(rows)], np.repeat(hit, counts[hit])


def merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    heads = np.flatnonzero(new)
    return list(zip(starts[heads].tolist(), ends[np.append(heads[1:], len(starts)) - 1].tolist(), strict=True))


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, size: int = BENCHMARK_BYTES) -> Iterator[pa.Table]:
    """The items (i, t) in blocks of at most about size bytes, which one driver can hold and send."""
    slim = benchmark.select(F.col(item).cast("string").alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    total = slim.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-total // size))
    for k in range(parts):
        part = slim if parts == 1 else slim.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k)
        yield part.distinct().toArrow()


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """Columns of docs named in keep (all if None), with n_words, spans (merged, in words, end exclusive) and items (ids of items that occur).

    Columns of docs that have one of the new names give way to it.
    """
    batched(docs.sparkSession)
    new = ("n_words", "spans", "items")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("__text"))
    out = out.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<array<long>>"), "items": F.array().cast("array<string>")})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    places = {c: i for i, c in enumerate(out.columns)}
    for items in benchmark_blocks(benchmark, item, item_text):
        out = out.mapInArrow(_pass(docs.sparkSession.sparkContext.broadcast(Phrases(items["i"].to_pylist(), items["t"].combine_chunks(), window)), places), schema)
    return out.drop("__text")


def _pass(shared, places: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in (b.slice(first, end - first) for b in batches for first, end, _, _ in blocks(b.column(places["__text"]), SHARD_BYTES)):
            counts = np.zeros(batch.num_rows, np.int64)
            found: dict[int, tuple[list, list, set]] = {}
            shard: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for first, end, data, offsets in blocks(batch.column(places["__text"])):
                words = words_of(data, offsets, ALNUM)
                counts[first:end] = np.diff(words.offsets)
                owner = words.owner()
                shard.append((phrases.symbols(words.hashes), owner + first, np.arange(len(owner)) - words.offsets[owner]))
            symbols, document, place = (np.concatenate(x) for x in zip(*shard, strict=True)) if shard else (np.zeros(0, np.int64),) * 3
            starts, which = shard_hits(symbols, document, phrases)
            order = np.argsort(document[starts], kind="stable")
            starts, which = starts[order], which[order]
            heads = np.flatnonzero(np.diff(document[starts], prepend=-1))
            for a, b in zip(heads, np.append(heads, len(starts))[1:], strict=True):
                row, at, phrase = int(document[starts[a]]), place[starts[a:b]], which[a:b]
                found[row] = at, at + phrases.lengths[phrase], phrases.items_of(np.unique(phrase))
            columns = list(batch.columns)
            columns[places["n_words"]] = pa.array(counts)
            spans, items = batch.column(places["spans"]).to_pylist(), batch.column(places["items"]).to_pylist()
            for row, (a, b, ids) in found.items():
                old = np.array(spans[row], np.int64).reshape(-1, 2)
                spans[row] = [list(x) for x in merge(np.concatenate([old[:, 0], a]), np.concatenate([old[:, 1], b]))]
                items[row] = sorted({*items[row], *ids})
            columns[places["spans"]] = pa.array(spans, pa.list_(pa.list_(pa.int64())))
            columns[places["items"]] = pa.array(items, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=list(places))

    return run


def judge(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """find_overlaps with n_hit, n_items, items_sha256 and contaminated: at least a twentieth of the words lie in an occurrence."""
    out = find_overlaps(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + F.get(x, 1) - F.get(x, 0))
    out = out.withColumns({"n_hit": hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ",").cast("binary"), 256)})
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))

"""Functions of sequences, as expressions that Spark compiles or evaluates in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flankspark.functions.expressions import let


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def compared(seq: Column, side: Column) -> Column:
    """The sequence read away from the junction: a left flank is reversed."""
    return F.when(side == "left", F.reverse(seq)).otherwise(seq)


def other_side(side: Column) -> Column:
    return F.when(side == "left", F.lit("right")).otherwise(F.lit("left"))


def file_stem(path: Column) -> Column:
    """The name of a file without folders and its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^/.]*)?$", 1)


def edit_budget(length: Column, fraction: float) -> Column:
    """max(1, length * fraction rounded half to even)."""
    return F.greatest(F.lit(1), F.bround(length * F.lit(fraction), 0).cast("int"))


def anchored_distance(query: Column, target: Column, budget: Column) -> Column:
    """The least edit distance of the query to a prefix of the target, null above the budget.

    Only prefixes whose length is within the budget of the query's can be that near, and only distances within it are worked out.
    """
    def near(k: Column) -> Column:
        low, high = F.greatest(F.lit(0), F.length(query) - k), F.least(F.length(target), F.length(query) + k)
        found = F.transform(F.sequence(low, F.greatest(low, high)), lambda j: F.call_function("levenshtein", query, F.substring(target, F.lit(1), j), k))
        return F.when(low <= high, F.array_min(F.filter(found, lambda d: d >= 0)))

    return let(budget, near)


def matches_prefix(query: Column, target: Column, budget: Column) -> Column:
    """Whether the query is within the budget of a prefix of the target; likely lengths come first, and the first that fits ends the search."""
    n = F.length(query)
    sizes = F.flatten(F.transform(F.sequence(F.lit(0), budget), lambda d: F.when(d == 0, F.array(n)).otherwise(F.array(n - d, n + d))))
    return F.exists(sizes, lambda j: F.when((j >= 0) & (j <= F.length(target)), F.call_function("levenshtein", query, F.substring(target, F.lit(1), j), budget) >= 0).otherwise(False))


#: Bases of an indexed word, at most.
WORD = 12


def word_size(length: Column, budget: Column) -> Column:
    """Bases of the words by which a query of this length is looked up: a piece of it, of budget + 1 equal ones, or WORD. 0 where pieces are empty."""
    return F.least(F.lit(WORD), F.floor(length / (budget + 1)).cast("int"))


def probes(query: Column, budget: Column, place: list[Column]) -> Column:
    """Buckets of which a target's words have at least one, if a prefix of it is within the budget of the query.

    Of budget + 1 pieces, some piece number j has no edit, and the pieces before it have j in all: as pieces are counted off against edits, the
    sum first falls below zero there. So it lies in the target within j bases of its own place.
    """
    piece, size = F.floor(F.length(query) / (budget + 1)).cast("int"), word_size(F.length(query), budget)
    ways = F.flatten(F.transform(F.sequence(F.lit(0), budget), lambda j: F.transform(F.sequence(-j, j), lambda d: F.struct((j * piece).alias("own"), (j * piece + d).alias("at")))))
    bucket = lambda x: F.xxhash64(*place, size, x["at"], F.substring(query, x["own"] + 1, size))
    return F.when(size == 0, F.array(F.xxhash64(*place, F.lit(0), F.lit(0), F.lit("")))).otherwise(F.transform(F.filter(ways, lambda x: x["at"] >= 0), bucket))


def words(target: Column, sizes: list[int], place: list[Column]) -> Column:
    """Buckets of all words of a target, of the sizes that queries use."""
    def own(n: int) -> Column:
        if n == 0:
            return F.array(F.xxhash64(*place, F.lit(0), F.lit(0), F.lit("")))
        every = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(target) - n))
        return F.when(F.length(target) >= n, F.transform(every, lambda at: F.xxhash64(*place, F.lit(n), at, F.substring(target, at + 1, F.lit(n))))).otherwise(F.array().cast("array<bigint>"))

    return F.flatten(F.array(*[own(n) for n in sizes])) if sizes else F.array().cast("array<bigint>")

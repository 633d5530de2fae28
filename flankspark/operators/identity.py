"""Clusters of sequences by identity, longest first.

A sequence joins the first longer one that stands for a cluster and holds it with an identity of at least the threshold, over the whole of
the shorter sequence and on either strand; otherwise it stands for a new cluster. Identity is one less the edits of the best place of the
shorter sequence in the longer, for each of its bases.

Candidates come from an inverted index of short words. The query is cut into words that don't overlap, and an edit spoils one of them at
most, so a match shares all but that many of its distinct words; candidates with fewer are left out before a sequence is touched. What is
left, the first TRIED of each query, is aligned. As in clustering._indexed_leaders, rounds settle sequences of all places at once: the
first match decides, unless something before it was left out, and then the next round looks at twice as many.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flankspark.functions.graph import cut_lineage
from flankspark.functions.ranges import numbered
from flankspark.functions.sequences import reverse_complement

#: First sequences of a word's bucket, and first candidates of a query, that a first round looks at.
HEAD, TRIED = 64, 8


def edits_inside(query: str, target: str, budget: int) -> int | None:
    """The least edit distance of query to any part of target, None above the budget; one step a base of the target, all rows of it at once as bits."""
    m = len(query)
    if not m:
        return 0
    full, top = (1 << m) - 1, 1 << m - 1
    at: dict[str, int] = {}
    for i, c in enumerate(query):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, now, least = full, 0, m, m
    for c in target:
        same = at.get(c, 0)
        x = same | minus
        d = (((x & plus) + plus) ^ plus) | x
        up, down = minus | ~(d | plus) & full, d & plus
        if up & top:
            now += 1
        elif down & top:
            now -= 1
            least = min(least, now)
        # A place may begin anywhere, so nothing is carried into the first row.
        up = up << 1 & full
        minus = up & d
        plus = (down << 1 | ~(d | up)) & full
    return least if least <= budget else None


@F.pandas_udf(T.IntegerType())
def _edits(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for query, target, budget in parts:
        yield pd.Series([edits_inside(q, t, k) for q, t, k in zip(query, target, budget, strict=True)], dtype="Int32")


def _words(seq: Column, sizes: list[int]) -> Column:
    """Distinct buckets of all words of a sequence, of the sizes that are asked for."""
    every = lambda n: F.when(F.length(seq) >= n, F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(seq) - n)), lambda i: F.xxhash64(F.lit(n), F.substring(seq, i + 1, F.lit(n))))).otherwise(F.array().cast("array<bigint>"))
    return F.array_distinct(F.flatten(F.array(*[every(n) for n in sizes])))


def _pieces(seq: Column, size: Column) -> Column:
    """Distinct buckets of the words into which a query is cut."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.floor(F.length(seq) / size) - 1), lambda i: F.xxhash64(size, F.substring(seq, (i * size + 1).cast("int"), size))))


def _first_held(rest: DataFrame, known: DataFrame, sizes: list[int], head: int, tried: int, strands: list[int]) -> DataFrame:
    """(pos, first, edits, strand, beyond) of each sequence of rest, as in clustering._first_matches."""
    entries = known.select("pos", F.explode(_words(F.col("seq"), sizes)).alias("bucket"))
    ranked = entries.withColumn("r", F.row_number().over(Window.partitionBy("bucket").orderBy("pos"))).where(F.col("r") <= head + 1)
    held = ranked.groupBy("bucket").agg(F.array_sort(F.collect_list("pos")).alias("held"))
    turned = rest.withColumn("strand", F.explode(F.array(*map(F.lit, strands)))).withColumn("own", F.when(F.col("strand") == 1, F.col("seq")).otherwise(reverse_complement(F.col("seq"))))
    turned = turned.withColumn("pieces", _pieces(F.col("own"), F.col("w")))
    asked = turned.select("pos", "strand", (F.size("pieces") - F.col("k")).alias("bound"), F.explode("pieces").alias("bucket"))
    met = asked.join(held, "bucket").where(F.col("held")[0] < F.col("pos"))
    over = F.get("held", F.lit(head))
    met = met.withColumn("over", F.when(over < F.col("pos"), over))
    cut = met.groupBy("pos", "strand").agg(F.count("over").alias("cut"), F.min("over").alias("beyond"))
    pairs = met.select("pos", "strand", "bound", F.explode(F.filter(F.slice("held", 1, head), lambda h: h < F.col("pos"))).alias("first"))
    shared = pairs.groupBy("pos", "strand", "bound", "first").agg(F.count("*").alias("shared")).join(cut, ["pos", "strand"])
    # A word whose bucket was cut off may be shared without being counted.
    near = shared.where(F.col("shared") >= F.greatest(F.lit(1), F.col("bound") - F.col("cut"))).select("pos", "strand", "first")
    order = Window.partitionBy("pos").orderBy("first", F.desc("strand"))
    near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= tried + 1)
    later = near.where(F.col("r") > tried).select("pos", F.col("first").alias("beyond")).unionByName(cut.select("pos", "beyond")).groupBy("pos").agg(F.min("beyond").alias("beyond"))
    some = near.where(F.col("r") <= tried).join(known.select(F.col("pos").alias("first"), F.col("seq").alias("target")), "first").join(turned.select("pos", "strand", "own", "k"), ["pos", "strand"])
    found = some.withColumn("edits", _edits("own", "target", "k")).where("edits is not null")
    best = found.groupBy("pos").agg(F.min(F.struct("first", "edits", "strand")).alias("x")).select("pos", "x.*")
    return later.join(best, "pos", "left").select("pos", "first", "edits", "strand", "beyond")


def identity_clusters(records: DataFrame, identity: float = 0.95, word: int = 10, both_strands: bool = True, name: str = "name", seq: str = "seq") -> DataFrame:
    """(cluster, name, length, is_rep, identity, strand) of each record with a sequence; clusters are numbered from 0 in the order of their representatives.

    Longer sequences come first, then those with the lesser name. identity of a member is that to its representative, rounded down to 4 digits.
    """
    # Copies of a sequence join the cluster that the first of them joins or stands for, so only distinct sequences are compared.
    named = records.select(F.col(name).alias("name"), F.col(seq).alias("seq")).where("length(seq) > 0").groupBy("seq", "name").agg(F.count("*").alias("copies"))
    named = cut_lineage(named)
    distinct = named.groupBy("seq").agg(F.min(F.struct("name"))["name"].alias("lead")).withColumn("__size", -F.length("seq"))
    items = numbered(distinct, "pos", ["__size", "lead", "seq"]).drop("__size")
    # Thousandths of a base, so that a budget like 0.1 * 30 is whole.
    budget = F.floor(F.round((1 - F.lit(identity)) * F.length("seq"), 6)).cast("int")
    items = items.withColumn("k", budget).withColumn("w", F.least(F.lit(word), F.floor(F.length("seq") / (F.col("k") + 1)).cast("int")))
    sizes = sorted(r[0] for r in items.select("w").distinct().collect() if r[0] > 0)
    items = items.withColumn("w", F.greatest(F.lit(1), F.col("w")))
    rest, heads, members = items, items.where("false"), items.where("false").select("pos", F.col("pos").alias("first"), F.col("k").alias("edits"), F.col("k").alias("strand"))
    head, tried = HEAD, TRIED
    while not rest.isEmpty():
        found = _first_held(rest, rest.unionByName(heads), sizes or [1], head, tried, [1, -1] if both_strands else [1])
        judged = cut_lineage(rest.join(found, "pos", "left"))
        alone = F.col("first").isNull() & F.col("beyond").isNull()
        # Written anew in each round, so that plans don't grow with rounds.
        heads = cut_lineage(heads.unionByName(judged.where(alone).select(*items.columns)))
        sure = F.col("first").isNotNull() & (F.col("beyond").isNull() | (F.col("first") < F.col("beyond")))
        led = judged.where(~alone).join(heads.select(F.col("pos").alias("first"), F.lit(True).alias("led")), "first", "left").withColumn("led", F.coalesce("led", F.lit(False)) & sure)
        led = cut_lineage(led)
        members = members.unionByName(led.where("led").select("pos", "first", "edits", "strand"))
        rest = led.where("not led").select(*items.columns)
        head, tried = 2 * head, 2 * tried
    own = numbered(heads.select("pos"), "cluster", ["pos"])
    placed = members.unionByName(heads.select("pos", F.col("pos").alias("first"), F.lit(0).alias("edits"), F.lit(1).alias("strand")))
    placed = placed.join(own.withColumnRenamed("pos", "first"), "first").join(items, "pos")
    copies = named.select("seq", "name", F.posexplode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy", "__t")).drop("__t")
    # Of the copies of a representative one stands for the cluster; the others are members on the strand that a member would be.
    is_rep = (F.col("pos") == F.col("first")) & F.col("name").eqNullSafe(F.col("lead")) & (F.col("copy") == 0)
    turned = F.lit(both_strands) & (F.col("pos") == F.col("first")) & (F.col("seq") == reverse_complement(F.col("seq")))
    out = placed.join(copies, "seq").withColumn("is_rep", is_rep).withColumn("strand", F.when(turned & ~F.col("is_rep"), -1).otherwise(F.col("strand")))
    part = F.floor((1 - F.col("edits") / F.length("seq")) * 10_000 + 1e-6) / 10_000
    return out.select(F.col("cluster").cast("int").alias("cluster"), "name", F.length("seq").alias("length"), "is_rep", part.alias("identity"), F.when(F.col("strand") == 1, "+").otherwise("-").alias("strand"))

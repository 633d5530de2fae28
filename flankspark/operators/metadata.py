"""Filters and comparisons of metadata, names and sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable_runs(sra: DataFrame, atb: DataFrame, low: float = 50e6, high: float = 500e6) -> DataFrame:
    """Runs with a known number of bases in [low, high) and a sample among atb's; "-" is missing, and what isn't a number is dropped."""
    known = sra.where((F.col("Bases") != "-") & (F.col("BioSample") != "-")).join(atb.select(F.col("sample_accession").alias("BioSample")), "BioSample", "left_semi")
    return known.withColumn("n_bases", F.expr("try_cast(Bases as double)")).where((F.col("n_bases") >= low) & (F.col("n_bases") < high))


def passing_samples(atb: DataFrame, runs: DataFrame) -> DataFrame:
    return atb.join(runs.select(F.col("Accession").alias("run_accession")), "run_accession", "left_semi")


def genome_sizes(atb: DataFrame, order: list[str | Column]) -> DataFrame:
    """(run_accession, genome_size): a positive whole number read from text; the first row of a run, in the order given, decides."""
    size = F.expr("cast(floor(try_cast(Genome_Size as double)) as bigint)")
    valid = atb.withColumn("genome_size", size).where("genome_size > 0")
    first = Window.partitionBy("run_accession").orderBy(*order)
    return valid.withColumn("__r", F.row_number().over(first)).where("__r = 1").select("run_accession", "genome_size")


def only_once(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key has exactly one row."""
    return rows.join(rows.groupBy(key).count().where("count = 1").select(key), key, "left_semi")


def compare_ids(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, state): only in the first or second, or in both with the same or another value. Keys are unique in each."""
    x, y = a.select(key, F.col(value).alias("x"), F.lit(True).alias("in_a")), b.select(key, F.col(value).alias("y"), F.lit(True).alias("in_b"))
    state = F.when(F.col("in_b").isNull(), "only_first").when(F.col("in_a").isNull(), "only_second").when(F.col("x").eqNullSafe(F.col("y")), "same").otherwise("different")
    return x.join(y, key, "full").select(key, state.alias("state"))


def best_members(members: DataFrame, key: str = "cluster") -> DataFrame:
    """The member with the highest identity, then length, then the first, of each cluster."""
    order = Window.partitionBy(key).orderBy(F.desc("identity"), F.desc("length"), "ordinal")
    return members.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def rename(rows: DataFrame, names: DataFrame, old: str = "name", new: str = "new_name") -> DataFrame:
    """rows with names replaced where there is a new one; a name in names that no row has raises an error when it is read."""
    both = rows.withColumn("__here", F.lit(True)).join(names.select(old, new), old, "full")
    left_over = F.raise_error(F.concat(F.lit("no row to rename: "), F.col(old))).cast("string")
    return both.withColumn(new, F.when(F.col("__here"), F.coalesce(new, old)).otherwise(left_over)).drop("__here")


def histogram(sizes: DataFrame, size: str) -> DataFrame:
    """(size, n): how many rows have each size."""
    return sizes.groupBy(size).agg(F.count("*").alias("n"))


def sweep_ratios(clusters: DataFrame, keys: list[str], size: str) -> DataFrame:
    """(keys, n_inputs, n_clusters, singletons and largest as parts of the inputs) of each clustering."""
    sums = clusters.groupBy(*keys).agg(F.sum(size).alias("n_inputs"), F.count("*").alias("n_clusters"), F.count_if(F.col(size) == 1).alias("single"), F.max(size).alias("most"))
    part = lambda c: F.bround(F.col(c) / F.col("n_inputs"), 6)
    return sums.select(*keys, "n_inputs", "n_clusters", part("single").alias("singleton_part"), part("most").alias("largest_part"))


def gene_support(rows: DataFrame) -> DataFrame:
    """(gene, n_clusters, n_samples) of coding hits."""
    hit = rows.where("hit_type = 'protein_coding'")
    return hit.groupBy("gene").agg(F.count("*").alias("n_clusters"), F.countDistinct("sample").alias("n_samples"))


def gap_text(gap: Column) -> Column:
    """A whole number without a point, another one as it is."""
    return F.when(gap == F.floor(gap), F.floor(gap).cast("string")).otherwise(gap.cast("string"))


def longest_prefix(texts: DataFrame, names: DataFrame, text: str = "body", name: str = "name") -> DataFrame:
    """Each row of texts with the longest name that its text starts with, null where there is none.

    Names are few lengths long: a distinct text meets them by equality of its prefix of each length, so there is no nested loop, and rows
    that are equal stay as many as they are.
    """
    lengths = names.select(F.length(name).alias("__n")).distinct()
    known = names.select(F.col(name).alias("__p")).distinct()
    cuts = texts.select(F.col(text).alias("__t")).distinct().join(F.broadcast(lengths.agg(F.collect_set("__n").alias("__all")))).withColumn("__n", F.explode(F.filter("__all", lambda n: n <= F.length("__t")))).drop("__all")
    found = cuts.withColumn("__p", F.substring(F.col("__t"), F.lit(1), F.col("__n"))).join(known, "__p").groupBy("__t").agg(F.max_by("__p", "__n").alias(name))
    return texts.join(found, F.col(text) == F.col("__t"), "left").drop("__t")


def elbow(curve: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """The x at which the second derivative of y is largest in size; differences are central, weighted by the gaps, and one-sided at the ends."""
    order = Window.partitionBy(*keys).orderBy(x)

    def slope(df: DataFrame, of: str, to: str) -> DataFrame:
        df = df.withColumns({"__a": F.col(x) - F.lag(x).over(order), "__b": F.lead(x).over(order) - F.col(x), "__p": F.lag(of).over(order), "__n": F.lead(of).over(order)})
        a, b, p, n, c = (F.col(k) for k in ("__a", "__b", "__p", "__n", of))
        middle = (a * a * n - b * b * p + (b * b - a * a) * c) / (a * b * (a + b))
        return df.withColumn(to, F.when(a.isNull(), (n - c) / b).when(b.isNull(), (c - p) / a).otherwise(middle)).drop("__a", "__b", "__p", "__n")

    bent = slope(slope(curve, y, "__d1"), "__d1", "__d2").withColumn("bend", F.bround(F.abs("__d2"), 9))
    first = Window.partitionBy(*keys).orderBy(F.desc("bend"), x)
    return bent.withColumn("__r", F.row_number().over(first)).where("__r = 1").select(*keys, x, "bend")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), " ", "_")


def top(rows: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first n rows in order, as Spark takes them: each task sends n at most."""
    return rows.orderBy(*order).limit(n)


def sampled(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows drawn at random; a row's draw follows from its key and the seed, so partitions don't matter."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def of_first_inputs(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the first n inputs by name."""
    return rows.join(F.broadcast(rows.select(key).distinct().orderBy(key).limit(n)), key, "left_semi")

"""Nested insertions: clusters without a place on a genome, aligned to mobile elements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flankspark.functions.intervals import band_join, site_counts
from flankspark.functions.ranges import numbered

#: Classes of clusters that lie in a target that isn't their own element.
PLACED = ("internal", "terminal")
CLASSES = ("too_short", "no_is_hit", "distal_only", "self", "terminal", "internal")


@dataclass(frozen=True)
class NestedLimits:
    min_len: int = 30
    min_pident: float = 90.0
    min_aln: int = 30
    junction_tol: int = 5
    terminal_tol: int = 20
    pair_tol: int = 20


def classify_nested(clusters: DataFrame, hsps: DataFrame, targets: DataFrame, limits: NestedLimits = NestedLimits()) -> DataFrame:
    """clusters(sample, is_element, side, cluster_id, rep_seq) with class, best target and what led to it.

    hsps(rep_seq, sseqid, pident, length, qstart, qend, qlen, sstart, send, sstrand, bitscore, slen) are searched once for each distinct
    sequence, and evalue is passed on where there is one; targets(target, target_db) names each target's database. Best: bit score, then identity, then name; ties in bit score are listed.
    """
    hits = hsps.where((F.col("pident") >= limits.min_pident) & (F.col("length") >= limits.min_aln))
    sides = clusters.where(F.length("rep_seq") >= limits.min_len).select("rep_seq", "side").distinct()
    tol = limits.junction_tol
    reach = F.when(F.col("side") == "left", F.col("qlen") - F.col("qend") <= tol).otherwise(F.col("qstart") - 1 <= tol)
    near = hits.join(sides, "rep_seq").where(reach).withColumn("junction_pos", F.when(F.col("side") == "left", F.col("send")).otherwise(F.col("sstart")))
    by = Window.partitionBy("rep_seq", "side")
    top = near.withColumn("most", F.max("bitscore").over(by)).where("bitscore = most")
    more = [F.col("evalue")] if "evalue" in hsps.columns else []
    # The longest of hits at one place; the rest of the order is there so that the choice doesn't depend on partitions.
    one = by.orderBy(F.desc("pident"), "sseqid", "junction_pos", "send", "sstrand", "qstart", "qend", F.desc("length"), "qlen", "slen", "sstart", *more)
    best = top.withColumns({"tied_targets": F.array_sort(F.collect_set("sseqid").over(by)), "__r": F.row_number().over(one)}).where("__r = 1")
    qcov = F.bround(F.col("length") / F.col("qlen"), 3).alias("qcov")
    best = best.select("rep_seq", "side", F.col("sseqid").alias("target"), F.col("slen").alias("target_len"), "junction_pos", "sstrand", "pident", "bitscore", F.size("tied_targets").alias("n_tied"), "tied_targets", F.col("length").alias("aln_len"), qcov, *more)
    any_hit = hits.select("rep_seq", F.lit(True).alias("any_hit")).distinct()
    out = clusters.join(best, ["rep_seq", "side"], "left").join(any_hit, "rep_seq", "left").join(targets, "target", "left")
    far = F.least(F.col("junction_pos") - 1, F.col("target_len") - F.col("junction_pos"))
    out = out.withColumn("dist_to_target_end", far)
    kind = (
        F.when(F.length("rep_seq") < limits.min_len, "too_short").when(F.col("any_hit").isNull(), "no_is_hit").when(F.col("target").isNull(), "distal_only")
        .when(F.array_contains("tied_targets", F.col("is_element")), "self").when(far <= limits.terminal_tol, "terminal").otherwise("internal")
    )
    return out.withColumn("class", kind).drop("any_hit")


def without_place(disruption: DataFrame) -> DataFrame:
    """The clusters (sample, is_element, side, cluster_id, rep_seq) that the search on genomes found nowhere: what the nested search starts from."""
    return disruption.where("hit_type = 'no_hit'").select("sample", "is_element", "side", "cluster_id", "rep_seq")


def as_output(nested: DataFrame) -> DataFrame:
    """nested as it is written: tied targets as one text, joined by commas."""
    return nested.withColumn("tied_targets", F.array_join("tied_targets", ","))


def paired_in_target(nested: DataFrame, pair_tol: int = 20) -> DataFrame:
    """nested with paired_in_target: of internal and terminal clusters, whether one of the other side of the same sample and element lies within pair_tol on the same target strand."""
    keys = ["sample", "is_element", "target", "sstrand"]
    placed = nested.where(F.col("class").isin(*PLACED))
    side = lambda s, x: placed.where(F.col("side") == s).select(*keys, F.col("cluster_id").alias(f"{x}_id"), F.col("junction_pos").alias(f"{x}_pos"))
    pairs = band_join(side("left", "l"), side("right", "r"), keys, "l_pos", "r_pos", pair_tol, True)
    ends = pairs.select("sample", "is_element", F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("l_id").alias("cluster_id")), F.struct(F.lit("right").alias("side"), F.col("r_id").alias("cluster_id")))).alias("e")).select("sample", "is_element", "e.*").distinct()
    return nested.join(ends.withColumn("__p", F.lit(True)), ["sample", "is_element", "side", "cluster_id"], "left").withColumn("paired_in_target", F.coalesce("__p", F.lit(False))).drop("__p")


def class_summary(nested: DataFrame) -> DataFrame:
    """Clusters and samples of each class, classes without any included; the part of all clusters to 4 digits."""
    spark = nested.sparkSession
    found = nested.groupBy("class").agg(F.count("*").alias("n_clusters"), F.countDistinct("sample").alias("n_samples"))
    every = spark.createDataFrame([(c,) for c in CLASSES], "class string")
    out = every.join(found, "class", "left").na.fill(0, ["n_clusters", "n_samples"])
    total = nested.agg(F.count("*").alias("__total"))
    return out.join(F.broadcast(total)).withColumn("frac_clusters", F.when(F.col("__total") > 0, F.bround(F.col("n_clusters") / F.col("__total"), 4)).otherwise(0.0)).drop("__total")


def host_target_summary(nested: DataFrame, site_tol: int = 20) -> DataFrame:
    """Counts, sites, the most frequent site (the least of ties) and median identity of each (element, target, database, class), internal and terminal ones; rows with a null key are left out."""
    keys = ["is_element", "target", "target_db", "class"]
    n = nested.where(F.col("class").isin(*PLACED)).dropna(subset=keys)
    sums = n.groupBy(*keys).agg(
        F.count("*").alias("n_clusters"), F.countDistinct("sample").alias("n_samples"), F.countDistinct(F.when(F.col("paired_in_target"), F.col("sample"))).alias("n_samples_paired"),
        F.count_if(F.col("side") == "left").alias("n_left"), F.count_if(F.col("side") == "right").alias("n_right"), F.max("target_len").alias("target_len"),
        F.expr("mode() within group (order by junction_pos)").alias("top_site"), F.bround(F.median("pident"), 3).alias("median_pident"),
    )
    return sums.join(site_counts(n, keys, "junction_pos", site_tol), keys, "left")


def in_order(summary: DataFrame) -> DataFrame:
    """host_target_summary with place, from 0: most samples with pairs first, then most samples, then by name."""
    return numbered(summary.withColumns({"__p": -F.col("n_samples_paired"), "__n": -F.col("n_samples")}), "place", ["__p", "__n", "is_element", "target", "target_db", "class"]).drop("__p", "__n")

"""Insertion events as connected components, and tallies of clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flankspark.functions.graph import connected_components


def insertion_events(clusters: DataFrame) -> DataFrame:
    """(sample, is_element, n_events): components of the (side, cluster) nodes of an element, tied by pairing.

    clusters has sample, is_element, side, cluster_id and pairing: "none", ``element:side:id``, or a bare id of the other side. Ties
    to another element are passed over, but the node stays; a partner that has no row of its own is a node too.
    """
    node = lambda side, i: F.concat_ws("\x1f", "sample", "is_element", side, i)
    own = clusters.withColumn("cid", F.col("cluster_id").cast("string"))
    part = F.split("pairing", ":", 3)
    full = F.col("pairing").contains(":")
    other = F.when(F.col("side") == "left", "right").otherwise("left")
    tied = own.withColumns({"p_e": F.when(full, F.get(part, F.lit(0))).otherwise(F.col("is_element")), "p_side": F.when(full, F.get(part, F.lit(1))).otherwise(other), "p_id": F.when(full, F.get(part, F.lit(2))).otherwise(F.col("pairing"))})
    tied = tied.where((F.coalesce("pairing", F.lit("none")) != "none") & (F.col("pairing") != "") & (F.col("p_e") == F.col("is_element")))
    edges = tied.select(node("side", "cid").alias("u"), node("p_side", "p_id").alias("v"))
    nodes = own.select("sample", "is_element", node("side", "cid").alias("node")).unionByName(tied.select("sample", "is_element", node("p_side", "p_id").alias("node"))).distinct()
    found = nodes.join(connected_components(edges), "node", "left")
    return found.groupBy("sample", "is_element").agg(F.countDistinct(F.coalesce("component", "node")).alias("n_events"))


def element_totals(events: DataFrame) -> DataFrame:
    return events.where("n_events > 0").groupBy("is_element").agg(F.sum("n_events").alias("n_insertion_events"), F.count("*").alias("n_samples_with_element"))


def hit_type_tally(rows: DataFrame) -> DataFrame:
    """Clusters of each hit type, the strongest of a cluster's rows counting; paired only by its protein_coding rows."""
    order = F.when(F.col("hit_type") == "protein_coding", 2).when(F.col("hit_type") == "intergenic", 1).otherwise(0)
    best = rows.groupBy("sample", "is_element", "side", "cluster_id").agg(F.max(order).alias("p"), F.bool_or((F.col("hit_type") == "protein_coding") & (F.col("pairing") != "none")).alias("paired"))
    name = F.when(F.col("p") == 2, "protein_coding").when(F.col("p") == 1, "intergenic").otherwise("no_hit")
    return best.groupBy(name.alias("hit_type")).agg(F.count("*").alias("n_clusters"), F.count_if("paired").alias("n_paired"))


def side_pivot(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Sums of a value by side, in columns left and right, 0 where a side is missing."""
    return rows.groupBy(key).pivot("side", ["left", "right"]).agg(F.sum(value)).na.fill(0, ["left", "right"])


def large_clusters(rows: DataFrame, group: str, size: str, part: float = 0.01, least: int = 30) -> DataFrame:
    """Clusters with at least a part of their group's largest size, and whether the group's total is below least."""
    by = Window.partitionBy(group)
    out = rows.withColumns({"share": F.col(size) / F.max(size).over(by), "few": F.sum(size).over(by) < least})
    return out.where(F.col("share") >= part)


def at_least(rows: DataFrame, size: str, limit: int, inclusive: bool = True) -> DataFrame:
    """Rows whose size is at least, or above, a limit."""
    return rows.where(F.col(size) >= limit if inclusive else F.col(size) > limit)


def identity_components(hits: DataFrame, min_pident: float = 99.0) -> DataFrame:
    """(node, component, n_members, min_identity) of the graph of near-identical sequences, isolated ones included; the least name stands for its component."""
    edges = hits.where((F.col("pident") >= min_pident) & (F.col("q") != F.col("s")))
    comp = connected_components(edges.select(F.col("q").alias("u"), F.col("s").alias("v")))
    nodes = hits.select(F.col("q").alias("node")).unionByName(hits.select(F.col("s").alias("node"))).distinct().join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = edges.join(comp.withColumnRenamed("node", "q"), "q").groupBy("component").agg(F.min("pident").alias("min_identity"))
    sizes = nodes.groupBy("component").agg(F.count("*").alias("n_members"))
    return nodes.join(sizes, "component").join(least, "component", "left")

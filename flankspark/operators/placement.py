"""Placing cluster representatives on reference genomes, and classifying each locus against genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flankspark.functions.intervals import band_join, points_in_intervals


def junction(side: Column, sstart: Column, send: Column, qstart: Column, qend: Column, qlen: Column, tolerance: int = 0) -> tuple[Column, Column]:
    """(0-based junction position, whether the alignment reaches it); a side that is neither left nor right is an error."""
    wrong = F.raise_error(F.concat(F.lit("not a side: "), F.coalesce(side, F.lit("null"))))
    at = F.when(side == "left", send - 1).when(side == "right", sstart - 1).otherwise(wrong.cast("int"))
    reach = F.when(side == "left", qlen - qend <= tolerance).when(side == "right", qstart - 1 <= tolerance).otherwise(F.lit(False))
    return at, reach


def candidates(hsps: DataFrame, min_pident: float = 95.0, min_qcov: float = 0.90, min_score: float = 0.90, most: int = 10) -> DataFrame:
    """Up to most loci for each (query, genome): filtered hits, one for each contig and junction, with score_frac, their part of the best score.

    hsps has one row for a hit, with the query's side; rows of no side are left out. Both windows run in one partitioning by query and genome.
    """
    h = hsps.where((F.col("pident") >= min_pident) & (F.col("length") / F.col("qlen") >= min_qcov) & F.col("side").isin("left", "right"))
    name = F.split("sseqid", "__", 2)
    at, reach = junction(F.col("side"), F.col("sstart"), F.col("send"), F.col("qstart"), F.col("qend"), F.col("qlen"))
    h = h.withColumns({"ref_genome": name[0], "contig": name[1], "junction_pos0": at, "reach_ok": reach, "strand": F.when(F.col("sstrand") == "plus", "+").otherwise("-")})
    order = [F.desc("bitscore"), "evalue", "sstart", "contig", "send", "sstrand"]
    # Hits at one place may still differ in what of the query they hold: the whole order, so that the choice doesn't depend on partitions.
    one = Window.partitionBy("qseqid", "ref_genome", "contig", "junction_pos0").orderBy(*order, F.desc("reach_ok"), F.desc("length"), F.desc("pident"), "qstart", "qend", "qlen")
    by = Window.partitionBy("qseqid", "ref_genome")
    h = h.repartition("qseqid", "ref_genome").withColumn("__r", F.row_number().over(one)).where("__r = 1")
    h = h.withColumn("score_frac", F.col("bitscore") / F.max("bitscore").over(by)).where(F.col("score_frac") >= min_score)
    return h.withColumn("rank", F.row_number().over(by.orderBy(*order)).cast("int")).where(F.col("rank") <= most).drop("__r")


def rank_genes(points: DataFrame, cds: DataFrame, keys: list[str], ident: list[str], point: str) -> DataFrame:
    """The coding sequences that hold each point, ranked by offset from their start, length and name."""
    joined = points_in_intervals(points, cds.select(*keys, F.col("start").alias("cds_start"), F.col("end").alias("cds_end"), F.col("strand").alias("cds_strand"), "gene"), keys, point, "cds_start", "cds_end")
    offset = F.when(F.col("cds_strand") == "+", F.col(point) - F.col("cds_start")).otherwise(F.col("cds_end") - 1 - F.col(point))
    found = joined.withColumns({"gene_offset": offset, "gene_length": F.col("cds_end") - F.col("cds_start")})
    order = Window.partitionBy(*ident).orderBy("gene_offset", "gene_length", "gene")
    return found.withColumn("gene_rank", F.row_number().over(order).cast("int")).drop("cds_start", "cds_end", "cds_strand")


def first_gene_closed(points: DataFrame, genes: DataFrame, keys: list[str], ident: list[str], point: str) -> DataFrame:
    """The first gene whose closed interval holds each point, in order of start, end and name."""
    joined = points_in_intervals(points, genes.select(*keys, F.col("start").alias("g_start"), F.col("end").alias("g_end"), (F.col("end") + 1).alias("g_stop"), "gene"), keys, point, "g_start", "g_stop")
    order = Window.partitionBy(*ident).orderBy("g_start", "g_end", "gene")
    return joined.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r", "g_start", "g_end", "g_stop")


#: Pairs of a group that are gone through in one task; larger groups take rounds.
FOLDED = 4096


def _fold_matches(pairs: DataFrame, group: list[str]) -> DataFrame:
    """(group, __l, __r): pairs(group, __o, __l, __r) of each group in order, each taken if neither end is used."""
    kind = {c: pairs.schema[c].dataType.simpleString() for c in ("__l", "__r")}
    every = pairs.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("__o", "__l", "__r"))).alias("x"))

    def step(used: Column, p: Column) -> Column:
        more = F.struct(*[F.concat(used[c], F.array(p[c])).alias(c) for c in kind])
        return F.when(F.array_contains(used["__l"], p["__l"]) | F.array_contains(used["__r"], p["__r"]), used).otherwise(more)

    used = F.aggregate("x", F.struct(*[F.array().cast(f"array<{k}>").alias(c) for c, k in kind.items()]), step)
    # The used ends of both sides are in the order of the pairs taken.
    return every.select(*group, used.alias("u")).select(*group, F.explode(F.arrays_zip("u.__l", "u.__r")).alias("t")).select(*group, "t.__l", "t.__r")


def greedy_matches(pairs: DataFrame, group: list[str], order: list[Column], left: str, right: str) -> DataFrame:
    """(group, left, right) of a one-to-one matching: pairs in order, each taken if neither end is used.

    Groups of at most FOLDED pairs are folded, each in a task. In a larger one a pair that is the first in order at both of its ends is
    taken whatever comes before it elsewhere, so whole rounds of such pairs are taken at once; then pairs with a used end go. It needs as
    many rounds as its longest chain of pairs that wait for each other; each round is a pair of windows, and no such group is gathered.
    """
    from flankspark.functions.graph import cut_lineage

    every = cut_lineage(pairs.select(*group, F.struct(*order).alias("__o"), F.col(left).alias("__l"), F.col(right).alias("__r")))
    large = every.groupBy(*group).count().where(F.col("count") > FOLDED).drop("count")
    rest = cut_lineage(every.join(large, group, "left_semi"))
    taken = _fold_matches(every.join(large, group, "left_anti"), group)
    while not rest.isEmpty():
        l, r = Window.partitionBy(*group, "__l"), Window.partitionBy(*group, "__r")
        now = cut_lineage(rest.withColumns({"__a": F.min("__o").over(l), "__b": F.min("__o").over(r)}))
        win = now.where((F.col("__o") == F.col("__a")) & (F.col("__o") == F.col("__b"))).select(*group, "__l", "__r")
        taken = taken.unionByName(win)
        rest = now.drop("__a", "__b").join(win.select(*group, "__l"), [*group, "__l"], "left_anti").join(win.select(*group, "__r"), [*group, "__r"], "left_anti")
        rest = cut_lineage(rest.select(*group, "__o", "__l", "__r"))
    return taken.select(*group, F.col("__l").alias(left), F.col("__r").alias(right))


def locus_pairs(found: DataFrame, max_gap: int = 50) -> DataFrame:
    """Left and right candidates of an element that meet at one junction: same genome, contig and strand, less than max_gap apart."""
    keys = ["sample", "is_element", "ref_genome", "contig", "strand"]
    side = lambda s, p: found.where((F.col("side") == s) & F.col("reach_ok")).select(*keys, F.col("cluster_id").alias(f"{p}_id"), F.col("junction_pos0").alias(f"{p}_pos"), F.col("score_frac").alias(f"{p}_score"))
    return band_join(side("left", "l"), side("right", "r"), keys, "l_pos", "r_pos", max_gap, False)


def select_loci(found: DataFrame, max_gap: int = 50) -> DataFrame:
    """At most one locus for each (cluster, genome): both ends of the matched pairs, by the sum of their score_frac and gap, else the best hit."""
    pairs = locus_pairs(found, max_gap).withColumns({"score": F.col("l_score") + F.col("r_score"), "gap": F.abs(F.col("l_pos") - F.col("r_pos"))})
    group = ["sample", "is_element", "ref_genome"]
    pairs = pairs.withColumns({"l": F.struct("l_id").cast("struct<id:int>"), "r": F.struct("r_id").cast("struct<id:int>")})
    order = [(-F.col("score")).alias("o1"), F.col("gap").alias("o2"), F.col("l_id").alias("o3"), F.col("r_id").alias("o4"), F.col("contig").alias("o5"), F.col("strand").alias("o6"), F.col("l_pos").alias("o7"), F.col("r_pos").alias("o8")]
    best = Window.partitionBy(*group, "l_id", "r_id").orderBy(*[F.col(f"x.{o}") for o in ("o1", "o2", "o3", "o4", "o5", "o6", "o7", "o8")])
    # Of the loci at which two clusters meet, only the best can be taken.
    lean = pairs.withColumn("x", F.struct(*order)).withColumn("__k", F.row_number().over(best)).where("__k = 1")
    won = greedy_matches(lean, group, [F.col("x")], "l_id", "r_id").join(lean.select(*group, "l_id", "r_id", "contig", "strand", "l_pos", "r_pos"), [*group, "l_id", "r_id"])
    ends = won.select(*group, F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("l_id").alias("cluster_id"), F.col("l_pos").alias("junction_pos0")), F.struct(F.lit("right").alias("side"), F.col("r_id").alias("cluster_id"), F.col("r_pos").alias("junction_pos0")))).alias("e"), "contig", "strand")
    ends = ends.select(*group, "e.side", "e.cluster_id", "contig", "strand", "e.junction_pos0", F.lit(True).alias("matched"))
    top = found.where("rank = 1").select(*group, "side", "cluster_id", "contig", "strand", "junction_pos0", F.lit(False).alias("matched"))
    return ends.unionByName(top.join(ends, [*group, "side", "cluster_id"], "left_anti"))


def classify(clusters: DataFrame, loci: DataFrame, cds: DataFrame) -> DataFrame:
    """A row for each cluster, genome and gene hit: protein_coding with ranked genes, intergenic where none holds the junction or it isn't reached, no_hit without a locus."""
    keys = ["sample", "is_element", "side", "cluster_id"]
    hit = loci.where("reach_ok")
    genes = rank_genes(hit.select(*keys, "ref_genome", "contig", "junction_pos0"), cds, ["ref_genome", "contig"], [*keys, "ref_genome"], "junction_pos0").drop("contig", "junction_pos0")
    placed = loci.join(genes, [*keys, "ref_genome"], "left")
    out = clusters.join(placed, keys, "left")
    kind = F.when(F.col("ref_genome").isNull(), "no_hit").when(F.col("gene").isNull(), "intergenic").otherwise("protein_coding")
    return out.withColumns({"hit_type": kind, "junction_pos": F.col("junction_pos0") + 1}).drop("junction_pos0")


def estimated_coverage(clusters: DataFrame, reads: DataFrame, genomes: DataFrame) -> DataFrame:
    """clusters with est_coverage (bases over genome size, null where unknown or 0) and coverage_fraction (reads over the unrounded coverage)."""
    out = clusters.join(reads.select("sample", "total_bases"), "sample", "left").join(genomes.select(F.col("run_accession").alias("sample"), "genome_size"), "sample", "left")
    raw = F.col("total_bases") / F.nullif("genome_size", F.lit(0))
    raw = F.when(raw != 0, raw)
    return out.withColumns({"est_coverage": F.bround(raw, 4), "coverage_fraction": F.bround(F.col("n_seqs") / raw, 6)}).drop("total_bases", "genome_size")


def add_pairing(placed: DataFrame, max_gap: int = 50) -> DataFrame:
    """placed(sample, is_element, side, cluster_id, ref_genome, contig, strand, junction_pos) with pairing, pairing_type and pairing_gap.

    One-to-one matching of left and right clusters of a sample on each genome: pairs of one element come first, then by gap and labels.
    """
    keys = ["sample", "ref_genome", "contig", "strand"]
    label = F.concat_ws(":", "is_element", "side", F.col("cluster_id").cast("string"))
    p = placed.withColumn("label", label)
    side = lambda s, x: p.where(F.col("side") == s).select(*keys, F.col("label").alias(x), F.col("is_element").alias(f"{x}_e"), F.col("junction_pos").alias(f"{x}_pos"))
    pairs = band_join(side("left", "l"), side("right", "r"), keys, "l_pos", "r_pos", max_gap, False)
    pairs = pairs.withColumns({"gap": F.col("r_pos") - F.col("l_pos"), "tier": F.when(F.col("l_e") == F.col("r_e"), 0).otherwise(1)})
    group = ["sample", "ref_genome"]
    lean = pairs.groupBy(*group, "l", "r").agg(F.min(F.struct("tier", F.abs("gap").alias("far"), "l", "r", "gap")).alias("x"))
    won = greedy_matches(lean, group, [F.col("x.tier").alias("t"), F.col("x.far").alias("f"), F.col("l").alias("ll"), F.col("r").alias("rr")], "l", "r").join(lean, [*group, "l", "r"])
    ends = won.select(*group, F.explode(F.array(F.struct(F.col("l").alias("label"), F.col("r").alias("mate")), F.struct(F.col("r").alias("label"), F.col("l").alias("mate")))).alias("e"), "x")
    ends = ends.select(*group, "e.label", F.col("e.mate").alias("pairing"), F.when(F.col("x.tier") == 0, "same_is").otherwise("cross_is").alias("pairing_type"), F.col("x.gap").alias("pairing_gap"))
    return p.join(ends, [*group, "label"], "left").na.fill("none", ["pairing", "pairing_type"]).drop("label")

"""Queries over hits and loci: placement, genes, pairing, nested insertions, events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.adapters import sql, view
from flankspark.functions.intervals import band_join, excise, remap_features, site_counts, union_intervals
from flankspark.jobs.catalogue import query
from flankspark.operators import events, nested, placement

KEY = ["sample", "is_element", "side", "cluster_id"]


def hsps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "hsps")


def query_parts(df: DataFrame) -> DataFrame:
    """The sample, element, side and cluster that a query's name holds."""
    part = F.split("qseqid", "__")
    return df.withColumns({"sample": part[0], "is_element": part[1], "side": part[2], "cluster_id": F.regexp_extract("qseqid", r"cluster(\d+)$", 1).cast("int")})


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.candidates(query_parts(hsps(spark, sf_dir)))


def cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "cds").withColumnRenamed("end_", "end")


CANDIDATES = f"""{sql("hsps")}, named AS (SELECT *, string_split(qseqid, '__')[1] AS sample, string_split(qseqid, '__')[2] AS is_element, string_split(qseqid, '__')[3] AS side, regexp_extract(qseqid, 'cluster(\\d+)$', 1)::INT AS cluster_id,
  string_split(sseqid, '__')[1] AS ref_genome, string_split(sseqid, '__')[2] AS contig, CASE WHEN sstrand = 'plus' THEN '+' ELSE '-' END AS strand FROM hsps WHERE pident >= 95 AND length / qlen >= 0.9),
placed AS (SELECT *, CASE WHEN side = 'left' THEN send - 1 ELSE sstart - 1 END AS junction_pos0, CASE WHEN side = 'left' THEN qlen - qend <= 0 ELSE qstart - 1 <= 0 END AS reach_ok FROM named),
one AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY qseqid, ref_genome, contig, junction_pos0 ORDER BY bitscore DESC, evalue, sstart, contig, send, sstrand) = 1),
parts AS (SELECT *, bitscore / max(bitscore) OVER (PARTITION BY qseqid, ref_genome) AS score_frac FROM one), near AS (SELECT * FROM parts WHERE score_frac >= 0.9),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qseqid, ref_genome ORDER BY bitscore DESC, evalue, sstart, contig, send, sstrand)::INT AS rank FROM near),
cand AS (SELECT * FROM ranked WHERE rank <= 10)"""
GENES = f"""{sql("cds")}, clusters AS (SELECT DISTINCT sample, is_element, side, cluster_id FROM (SELECT string_split(qseqid, '__')[1] AS sample, string_split(qseqid, '__')[2] AS is_element, string_split(qseqid, '__')[3] AS side, regexp_extract(qseqid, 'cluster(\\d+)$', 1)::INT AS cluster_id FROM hsps)),
genes AS (SELECT l.sample, l.is_element, l.side, l.cluster_id, l.ref_genome, c.gene, CASE WHEN c.strand = '+' THEN junction_pos0 - c.start ELSE c.end_ - 1 - junction_pos0 END AS gene_offset, c.end_ - c.start AS gene_length
  FROM loci l JOIN cds c ON l.ref_genome = c.ref_genome AND l.contig = c.contig AND c.start <= l.junction_pos0 AND l.junction_pos0 < c.end_ WHERE l.reach_ok),
gr AS (SELECT *, row_number() OVER (PARTITION BY sample, is_element, side, cluster_id, ref_genome ORDER BY gene_offset, gene_length, gene)::INT AS gene_rank FROM genes),
disruption AS (SELECT k.sample, k.is_element, k.side, k.cluster_id, CASE WHEN l.ref_genome IS NULL THEN 'no_hit' WHEN gene IS NULL THEN 'intergenic' ELSE 'protein_coding' END AS hit_type, l.ref_genome, l.contig, gene, gene_rank, gene_offset, gene_length, l.junction_pos0 + 1 AS junction_pos
  FROM clusters k LEFT JOIN loci l USING (sample, is_element, side, cluster_id) LEFT JOIN gr ON gr.sample = k.sample AND gr.is_element = k.is_element AND gr.side = k.side AND gr.cluster_id = k.cluster_id AND gr.ref_genome = l.ref_genome)"""
BEST = "loci AS (SELECT * FROM cand WHERE rank = 1)"
DISRUPTION = f"WITH {CANDIDATES}, {BEST}, {GENES}"


def disruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = query_parts(hsps(spark, sf_dir).select("qseqid").distinct()).select(*KEY)
    loci = candidates(spark, sf_dir).where("rank = 1").select(*KEY, "ref_genome", "contig", "junction_pos0", "reach_ok")
    return placement.classify(clusters, loci, cds(spark, sf_dir)).select(*KEY, "hit_type", "ref_genome", "contig", "gene", "gene_rank", "gene_offset", "gene_length", "junction_pos")


@query(f"{DISRUPTION} SELECT * FROM disruption")
def q01_gene_disruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disruption(spark, sf_dir)


@query(f"WITH {CANDIDATES} SELECT qseqid, ref_genome, contig, strand, junction_pos0, reach_ok, bitscore, round_even(score_frac, 9) AS score_frac, rank FROM cand")
def q15_candidate_loci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("qseqid", "ref_genome", "contig", "strand", "junction_pos0", "reach_ok", "bitscore", F.bround("score_frac", 9).alias("score_frac"), "rank")


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "placements").groupBy(*KEY, "ref_genome", "contig", "strand", "junction_pos").agg(F.max("score").alias("bitscore"))


#: A step takes the first pair in order whose ends are both free; lists hold the used ends.
GREEDY = """fold AS (SELECT {g}, 0::BIGINT AS n, []::VARCHAR[] AS used_l, []::VARCHAR[] AS used_r, NULL::VARCHAR AS l, NULL::VARCHAR AS r FROM {pairs} GROUP BY ALL
  UNION ALL
  SELECT {fg}, p.n, CASE WHEN ok THEN list_append(used_l, p.l) ELSE used_l END, CASE WHEN ok THEN list_append(used_r, p.r) ELSE used_r END, CASE WHEN ok THEN p.l END, CASE WHEN ok THEN p.r END
  FROM (SELECT f.*, p AS p, NOT list_contains(f.used_l, p.l) AND NOT list_contains(f.used_r, p.r) AS ok FROM fold f JOIN {pairs} p ON {on} AND p.n = f.n + 1) AS f)"""
PLACED = f"""{sql("placements")}, cand AS (SELECT sample, is_element, side, cluster_id, ref_genome, contig, strand, junction_pos, max(score) AS bitscore FROM placements GROUP BY ALL)"""
SELECT_LOCI = f"""WITH RECURSIVE {CANDIDATES}, raw AS (SELECT a.sample, a.is_element, a.ref_genome, a.cluster_id::VARCHAR AS l, b.cluster_id::VARCHAR AS r, a.cluster_id AS li, b.cluster_id AS ri, a.contig, a.strand, a.junction_pos0 AS lp, b.junction_pos0 AS rp, a.score_frac + b.score_frac AS s, abs(a.junction_pos0 - b.junction_pos0) AS gap
  FROM cand a JOIN cand b ON a.sample = b.sample AND a.is_element = b.is_element AND a.ref_genome = b.ref_genome AND a.contig = b.contig AND a.strand = b.strand AND a.side = 'left' AND b.side = 'right' AND a.reach_ok AND b.reach_ok AND abs(a.junction_pos0 - b.junction_pos0) < 50),
pairs AS (SELECT *, row_number() OVER (PARTITION BY sample, is_element, ref_genome ORDER BY s DESC, gap, li, ri, contig, strand, lp, rp) AS n FROM raw),
{GREEDY.format(g="sample, is_element, ref_genome", fg="f.sample, f.is_element, f.ref_genome", pairs="pairs", on="p.sample = f.sample AND p.is_element = f.is_element AND p.ref_genome = f.ref_genome")},
won AS (SELECT p.* FROM fold f JOIN pairs p USING (sample, is_element, ref_genome, n) WHERE f.l IS NOT NULL),
ends AS (SELECT sample, is_element, ref_genome, 'left' AS side, li AS cluster_id, contig, strand, lp AS junction_pos0, true AS matched FROM won UNION ALL SELECT sample, is_element, ref_genome, 'right', ri, contig, strand, rp, true FROM won),
top AS (SELECT sample, is_element, ref_genome, side, cluster_id, contig, strand, junction_pos0, false AS matched FROM cand WHERE rank = 1)"""


@query(f"{SELECT_LOCI} SELECT * FROM ends UNION ALL SELECT * FROM top ANTI JOIN ends USING (sample, is_element, ref_genome, side, cluster_id)")
def q16_locus_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.select_loci(candidates(spark, sf_dir))


PAIRING = f"""WITH RECURSIVE {PLACED}, named AS (SELECT *, concat_ws(':', is_element, side, cluster_id) AS label FROM cand),
raw AS (SELECT a.sample, a.ref_genome, a.label AS l, b.label AS r, CASE WHEN a.is_element = b.is_element THEN 0 ELSE 1 END AS tier, b.junction_pos - a.junction_pos AS gap
  FROM named a JOIN named b ON a.sample = b.sample AND a.ref_genome = b.ref_genome AND a.contig = b.contig AND a.strand = b.strand AND a.side = 'left' AND b.side = 'right' AND abs(b.junction_pos - a.junction_pos) < 50),
lean AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY sample, ref_genome, l, r ORDER BY tier, abs(gap), gap) = 1),
pairs AS (SELECT *, row_number() OVER (PARTITION BY sample, ref_genome ORDER BY tier, abs(gap), l, r) AS n FROM lean),
{GREEDY.format(g="sample, ref_genome", fg="f.sample, f.ref_genome", pairs="pairs", on="p.sample = f.sample AND p.ref_genome = f.ref_genome")},
won AS (SELECT p.* FROM fold f JOIN pairs p USING (sample, ref_genome, n) WHERE f.l IS NOT NULL),
ends AS (SELECT sample, ref_genome, l AS label, r AS pairing, tier, gap FROM won UNION ALL SELECT sample, ref_genome, r, l, tier, gap FROM won),
paired AS (SELECT n.sample, n.is_element, n.side, n.cluster_id, n.ref_genome, n.contig, n.strand, n.junction_pos, coalesce(pairing, 'none') AS pairing, CASE tier WHEN 0 THEN 'same_is' WHEN 1 THEN 'cross_is' ELSE 'none' END AS pairing_type, gap AS pairing_gap FROM named n LEFT JOIN ends USING (sample, ref_genome, label))"""


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.add_pairing(placements(spark, sf_dir).drop("bitscore"))


@query(f"{PAIRING} SELECT * FROM paired")
def q17_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired(spark, sf_dir)


@query(
    f"""WITH {sql("placements")} SELECT a.sample, a.ref_genome, a.strand, a.cluster_id AS l, b.cluster_id AS r, a.junction_pos AS l_pos, b.junction_pos AS r_pos FROM placements a JOIN placements b ON a.sample = b.sample AND a.is_element = b.is_element AND a.ref_genome = b.ref_genome AND a.strand = b.strand AND a.side = 'left' AND b.side = 'right' AND abs(a.junction_pos - b.junction_pos) <= 20"""
)
def q18_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "placements")
    side = lambda s, x: p.where(F.col("side") == s).select("sample", "is_element", "ref_genome", "strand", F.col("cluster_id").alias(x), F.col("junction_pos").alias(f"{x}_pos"))
    return band_join(side("left", "l"), side("right", "r"), ["sample", "is_element", "ref_genome", "strand"], "l_pos", "r_pos", 20, True).select("sample", "ref_genome", "strand", "l", "r", "l_pos", "r_pos")


NESTED = f"""WITH {sql("clusters")}, {sql("hsps")}, k AS (SELECT DISTINCT sample, is_element, side, cluster_id, CASE WHEN cluster_id % 9 = 0 THEN substring(rep_seq, 1, 25) ELSE rep_seq END AS rep_seq FROM clusters),
h AS (SELECT DISTINCT concat(translate(md5(cast(regexp_extract(qseqid, 'cluster(\\d+)$', 1) AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT'), translate(md5(cast(substring(string_split(qseqid, '__')[2], 2) AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT')) AS rep_seq,
  concat('E', cast(sstart % 14 AS string)) AS sseqid, CASE WHEN sstart % 3 = 0 THEN pident - 20 ELSE pident END AS pident, length, qstart, qend, qlen, cast(sstart % 1000 AS int) AS sstart, cast(send % 1000 AS int) AS send, sstrand, bitscore, 1000 AS slen FROM hsps),
hits AS (SELECT * FROM h WHERE pident >= 98 AND length >= 30),
near AS (SELECT hits.*, s.side, CASE WHEN s.side = 'left' THEN send ELSE sstart END AS junction_pos FROM hits JOIN (SELECT DISTINCT rep_seq, side FROM k WHERE length(rep_seq) >= 30) s USING (rep_seq) WHERE CASE WHEN s.side = 'left' THEN qlen - qend <= 0 ELSE qstart - 1 <= 0 END),
top AS (SELECT * FROM near QUALIFY bitscore = max(bitscore) OVER (PARTITION BY rep_seq, side)),
ties AS (SELECT rep_seq, side, list_sort(list(DISTINCT sseqid)) AS tied FROM top GROUP BY ALL),
best AS (SELECT * FROM top QUALIFY row_number() OVER (PARTITION BY rep_seq, side ORDER BY pident DESC, sseqid, junction_pos, send, sstrand, qstart, qend) = 1),
joined AS (SELECT k.*, b.sseqid AS target, b.slen AS target_len, b.junction_pos, b.sstrand, b.pident, len(tied)::INT AS n_tied, tied, least(b.junction_pos - 1, b.slen - b.junction_pos) AS far, k.rep_seq IN (SELECT rep_seq FROM hits) AS any_hit FROM k LEFT JOIN best b USING (rep_seq, side) LEFT JOIN ties USING (rep_seq, side)),
classed AS (SELECT sample, is_element, side, cluster_id, target, CASE WHEN target IS NULL THEN NULL WHEN substring(target, 2)::INT % 5 = 4 THEN NULL ELSE concat('db', cast(substring(target, 2)::INT % 5 AS string)) END AS target_db, target_len, junction_pos, sstrand, pident, n_tied, far AS dist_to_target_end,
  CASE WHEN length(rep_seq) < 30 THEN 'too_short' WHEN NOT any_hit THEN 'no_is_hit' WHEN target IS NULL THEN 'distal_only' WHEN list_contains(tied, is_element) THEN 'self' WHEN far <= 20 THEN 'terminal' ELSE 'internal' END AS class FROM joined),
placed AS (SELECT * FROM classed WHERE class IN ('internal', 'terminal')),
pairs AS (SELECT DISTINCT a.sample, a.is_element, a.cluster_id AS l, b.cluster_id AS r FROM placed a JOIN placed b ON a.sample = b.sample AND a.is_element = b.is_element AND a.target = b.target AND a.sstrand = b.sstrand AND a.side = 'left' AND b.side = 'right' AND abs(a.junction_pos - b.junction_pos) <= 20),
nested AS (SELECT *, CASE WHEN side = 'left' THEN (sample, is_element, cluster_id) IN (SELECT (sample, is_element, l) FROM pairs) ELSE (sample, is_element, cluster_id) IN (SELECT (sample, is_element, r) FROM pairs) END AS paired_in_target FROM classed)"""


def nested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = view(spark, sf_dir, "clusters").distinct().withColumn("rep_seq", F.when(F.col("cluster_id") % 9 == 0, F.substring("rep_seq", 1, 25)).otherwise(F.col("rep_seq")))
    letters = lambda c: F.translate(F.md5(c), "0123456789abcdef", "ACGTACGTACGTACGT")
    h = query_parts(hsps(spark, sf_dir)).select(
        F.concat(letters(F.col("cluster_id").cast("string")), letters(F.substring("is_element", 2, 10))).alias("rep_seq"), F.concat(F.lit("E"), (F.col("sstart") % 14).cast("string")).alias("sseqid"),
        F.when(F.col("sstart") % 3 == 0, F.col("pident") - 20).otherwise(F.col("pident")).alias("pident"), "length", "qstart", "qend", "qlen", (F.col("sstart") % 1000).alias("sstart"), (F.col("send") % 1000).alias("send"), "sstrand", "bitscore", F.lit(1000).alias("slen"),
    ).distinct()
    targets = h.select(F.col("sseqid").alias("target")).distinct().withColumn("n", F.substring("target", 2, 10).cast("int") % 5)
    targets = targets.select("target", F.when(F.col("n") != 4, F.concat(F.lit("db"), F.col("n").cast("string"))).alias("target_db"))
    limits = nested.NestedLimits(min_pident=98.0, junction_tol=0)
    return nested.paired_in_target(nested.classify_nested(k, h, targets, limits), limits.pair_tol)


@query(f"{NESTED} SELECT sample, is_element, side, cluster_id, class, target, target_db, junction_pos, dist_to_target_end, n_tied, pident, paired_in_target FROM nested")
def q19_nested_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_rows(spark, sf_dir).select(*KEY, "class", "target", "target_db", "junction_pos", "dist_to_target_end", "n_tied", "pident", "paired_in_target")


@query(
    f"""{NESTED}, classes AS (SELECT unnest(['too_short', 'no_is_hit', 'distal_only', 'self', 'terminal', 'internal']) AS class)
SELECT class, count(sample) AS n_clusters, count(DISTINCT sample) AS n_samples, round_even(count(sample) / (SELECT count(*) FROM nested), 4) AS frac_clusters FROM classes LEFT JOIN nested USING (class) GROUP BY class"""
)
def q20_class_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.class_summary(nested_rows(spark, sf_dir))


@query(
    f"""{NESTED}, n AS (SELECT *, junction_pos - lag(junction_pos) OVER (PARTITION BY is_element, target, target_db, class ORDER BY junction_pos) AS gap FROM nested WHERE class IN ('internal', 'terminal') AND target IS NOT NULL AND target_db IS NOT NULL)
SELECT is_element, target, target_db, class, count(*) AS n_clusters, count(DISTINCT sample) AS n_samples, count(DISTINCT CASE WHEN paired_in_target THEN sample END) AS n_samples_paired, count_if(side = 'left')::BIGINT AS n_left, count_if(side = 'right')::BIGINT AS n_right, max(target_len) AS target_len,
  mode(junction_pos ORDER BY junction_pos) AS top_site, round_even(median(pident), 3) AS median_pident, 1 + count(CASE WHEN gap > 20 THEN 1 END) AS n_sites FROM n GROUP BY is_element, target, target_db, class"""
)
def q21_host_target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.host_target_summary(nested_rows(spark, sf_dir))


@query(f"WITH {sql('sites')}, g AS (SELECT *, pos - lag(pos) OVER (PARTITION BY grp, kind ORDER BY pos) AS gap FROM sites) SELECT grp, kind, 1 + count(CASE WHEN gap > 20 THEN 1 END) AS n_sites FROM g GROUP BY grp, kind")
def q22_site_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_counts(view(spark, sf_dir, "sites"), ["grp", "kind"], "pos", 20)


TIES = f"""{sql("placements")}, nodes AS (SELECT DISTINCT sample, is_element, side, cluster_id FROM placements), ties AS (SELECT *, CASE WHEN cluster_id % 3 = 0 THEN 'none' WHEN cluster_id % 3 = 1 THEN cast(cluster_id + 1 AS string) ELSE concat('E', cast(cluster_id % 7 AS string), CASE WHEN side = 'left' THEN ':right:' ELSE ':left:' END, cast(cluster_id + 1 AS string)) END AS pairing FROM nodes)"""


@query(
    f"""WITH RECURSIVE {TIES}, e AS (SELECT sample, is_element, concat(side, ':', cluster_id) AS u, CASE WHEN contains(pairing, ':') THEN concat(string_split(pairing, ':')[2], ':', string_split(pairing, ':')[3]) ELSE concat(CASE WHEN side = 'left' THEN 'right' ELSE 'left' END, ':', pairing) END AS v FROM ties WHERE pairing <> 'none' AND (NOT contains(pairing, ':') OR string_split(pairing, ':')[1] = is_element)),
both_ AS (SELECT sample, is_element, u, v FROM e UNION SELECT sample, is_element, v, u FROM e),
n AS (SELECT sample, is_element, concat(side, ':', cluster_id) AS u FROM ties UNION SELECT sample, is_element, v FROM e),
reach AS (SELECT sample, is_element, u, u AS w FROM n UNION SELECT r.sample, r.is_element, r.u, b.v FROM reach r JOIN both_ b ON r.sample = b.sample AND r.is_element = b.is_element AND r.w = b.u),
comp AS (SELECT sample, is_element, u, min(w) AS c FROM reach GROUP BY ALL),
ev AS (SELECT sample, is_element, count(DISTINCT c) AS n_events FROM comp GROUP BY ALL)
SELECT is_element, sum(n_events)::BIGINT AS n_insertion_events, count(*) AS n_samples_with_element FROM ev GROUP BY is_element"""
)
def q23_event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = view(spark, sf_dir, "placements").select(*KEY).distinct()
    other = F.when(F.col("side") == "left", ":right:").otherwise(":left:")
    pairing = F.when(F.col("cluster_id") % 3 == 0, "none").when(F.col("cluster_id") % 3 == 1, (F.col("cluster_id") + 1).cast("string")).otherwise(F.concat(F.lit("E"), (F.col("cluster_id") % 7).cast("string"), other, (F.col("cluster_id") + 1).cast("string")))
    return events.element_totals(events.insertion_events(nodes.withColumn("pairing", pairing)))


@query(
    """WITH RECURSIVE h AS (SELECT concat('s', cast(l_orderkey AS string)) AS q, concat('s', cast(l_orderkey + l_linenumber AS string)) AS s, 100 - floor(l_discount * 100) AS pident FROM lineitem),
e AS (SELECT * FROM h WHERE pident >= 99 AND q <> s), b AS (SELECT q AS u, s AS v FROM e UNION SELECT s, q FROM e), n AS (SELECT q AS u FROM h UNION SELECT s FROM h),
reach AS (SELECT u, u AS w FROM n UNION SELECT r.u, b.v FROM reach r JOIN b ON r.w = b.u), c AS (SELECT u AS node, min(w) AS component FROM reach GROUP BY u),
m AS (SELECT component, min(pident) AS min_identity FROM e JOIN c ON e.q = c.node GROUP BY 1)
SELECT node, component, count(*) OVER (PARTITION BY component) AS n_members, min_identity FROM c LEFT JOIN m USING (component)"""
)
def q24_identity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flankspark.tables import table

    h = table(spark, sf_dir, "lineitem").selectExpr("concat('s', cast(l_orderkey as string)) as q", "concat('s', cast(l_orderkey + l_linenumber as string)) as s", "cast(100 - floor(l_discount * 100) as double) as pident")
    return events.identity_components(h)


@query(
    f"""{DISRUPTION}, t AS (SELECT *, CASE WHEN cluster_id % 4 = 0 THEN 'E1:left:1' ELSE 'none' END AS pairing FROM disruption),
b AS (SELECT sample, is_element, side, cluster_id, max(CASE hit_type WHEN 'protein_coding' THEN 2 WHEN 'intergenic' THEN 1 ELSE 0 END) AS p, bool_or(hit_type = 'protein_coding' AND pairing <> 'none') AS paired FROM t GROUP BY ALL)
SELECT CASE p WHEN 2 THEN 'protein_coding' WHEN 1 THEN 'intergenic' ELSE 'no_hit' END AS hit_type, count(*) AS n_clusters, count_if(paired)::BIGINT AS n_paired FROM b GROUP BY 1"""
)
def q25_hit_type_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.hit_type_tally(disruption(spark, sf_dir).withColumn("pairing", F.when(F.col("cluster_id") % 4 == 0, "E1:left:1").otherwise("none")))


@query(f"WITH {sql('placements')} SELECT is_element, coalesce(sum(CASE WHEN side = 'left' THEN cluster_id END), 0)::BIGINT AS \"left\", coalesce(sum(CASE WHEN side = 'right' THEN cluster_id END), 0)::BIGINT AS \"right\" FROM placements GROUP BY 1")
def q26_side_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.side_pivot(view(spark, sf_dir, "placements"), "is_element", "cluster_id")


UNION_SQL = f"""{sql("intervals")}, o AS (SELECT *, max(end_) OVER (PARTITION BY chrom ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM intervals),
g AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM o),
masks AS (SELECT chrom, min(start) AS start, max(end_) AS "end" FROM g GROUP BY chrom, n)"""


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_intervals(view(spark, sf_dir, "intervals").withColumnRenamed("end_", "end"), ["chrom"], "start", "end")


@query(f"WITH {UNION_SQL} SELECT * FROM masks")
def q27_interval_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks(spark, sf_dir)


@query(
    f"""WITH {UNION_SQL}, m AS (SELECT * FROM masks), {sql("features")}
SELECT f.chrom, f.feature_id, (f.start - coalesce(sum(m."end" - m.start) FILTER (m."end" <= f.start), 0))::BIGINT AS new_start, (f.end_ - coalesce(sum(m."end" - m.start) FILTER (m."end" <= f.end_), 0))::BIGINT AS new_end
FROM features f LEFT JOIN m ON f.chrom = m.chrom GROUP BY f.chrom, f.feature_id, f.start, f.end_ HAVING NOT coalesce(bool_or((m.start < f.start AND f.start < m."end") OR (m.start < f.end_ AND f.end_ < m."end")), false)"""
)
def q28_feature_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remap_features(view(spark, sf_dir, "features").withColumnRenamed("end_", "end"), masks(spark, sf_dir), ["chrom"]).select("chrom", "feature_id", "new_start", "new_end")


@query(
    """WITH s AS (SELECT p_partkey AS id, concat(md5(p_name), md5(p_brand)) AS seq, [{'s': p_size % 10, 'e': p_size % 10 + 5}, {'s': 20 + p_size % 7, 'e': 40}] AS m FROM part)
SELECT id, concat(substring(seq, 1, m[1].s), substring(seq, m[1].e + 1, m[2].s - m[1].e), substring(seq, m[2].e + 1)) AS kept FROM s"""
)
def q29_sequence_excise(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flankspark.tables import table

    p = table(spark, sf_dir, "part")
    cut = F.array(F.struct((F.col("p_size") % 10).alias("start"), (F.col("p_size") % 10 + 5).alias("end")), F.struct((F.col("p_size") % 7 + 20).alias("start"), F.lit(40).alias("end")))
    return p.select(F.col("p_partkey").alias("id"), excise(F.concat(F.md5("p_name"), F.md5("p_brand")), cut).alias("kept"))

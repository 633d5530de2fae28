"""Queries over alignments and flanks: filtering, depth, clustering, recruitment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.adapters import sql, view
from flankspark.functions.graph import cut_lineage
from flankspark.functions.sequences import anchored_distance, edit_budget
from flankspark.jobs.catalogue import query
from flankspark.operators import alignment, clustering, depth


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's alignments with their clips as a cigar."""
    a = view(spark, sf_dir, "alignments")
    op = lambda n, k: F.struct(F.lit(k).alias("op"), n.alias("len"))
    ops = F.array(op(F.col("left_clip"), 4), op(F.col("ref_end") - F.col("ref_start"), 0), op(F.col("right_clip"), 4))
    return a.withColumn("cigar", F.filter(ops, lambda x: (x["len"] > 0) | (x["op"] == 0))).drop("left_clip", "right_clip")


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.filter_alignments(alignments(spark, sf_dir))


FILTERED = f"""WITH {sql("alignments")}, base AS (
  SELECT *, ref_end - ref_start AS alen, ref_start <= 20 AS ns, ref_length - ref_end <= 20 AS ne,
    CASE WHEN nm IS NOT NULL AND ref_end - ref_start > 0 THEN 100.0::DOUBLE * (ref_end - ref_start - nm) / (ref_end - ref_start) END AS pid
  FROM alignments WHERE (flag & 2308) = 0),
filtered AS (SELECT sample, query_name, reference, ref_length, ref_start, ref_end, mapq, flag, query_sequence, left_clip, right_clip, pid AS pident,
    ns AND left_clip >= 5 AS zl, ne AND right_clip >= 5 AS zr, mapq < 30 AS za,
    CASE WHEN NOT regexp_matches(upper(query_sequence), '^[ACGT]*$') THEN 'non_acgt' WHEN alen < 20 THEN 'short_is_alignment'
      WHEN NOT (ns OR ne) THEN 'not_at_boundary' WHEN left_clip > 0 AND right_clip > 0 THEN 'dual_clip'
      WHEN NOT ((ns AND left_clip > 0) OR (ne AND right_clip > 0)) THEN 'no_softclip_on_eligible_side'
      WHEN NOT ((ns AND left_clip >= 5) OR (ne AND right_clip >= 5)) THEN 'short_clip' WHEN nm IS NULL THEN 'no_nm' WHEN pid < 90 THEN 'low_pident' END AS drop_reason
  FROM base WHERE ref_length IS NOT NULL OR NOT regexp_matches(upper(query_sequence), '^[ACGT]*$') OR alen < 20)"""
OVERHANGS = f"""{FILTERED}, cut AS (
  SELECT sample, query_name AS read_id, reference AS is_element, 'left' AS side, CASE WHEN za THEN 'ambiguous' ELSE 'left' END AS bucket, substring(query_sequence, 1, left_clip) AS seq, ref_start AS pos, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, round_even(pident, 2) AS pident, mapq FROM filtered WHERE drop_reason IS NULL AND zl
  UNION ALL
  SELECT sample, query_name, reference, 'right', CASE WHEN za THEN 'ambiguous' ELSE 'right' END, right(query_sequence, right_clip), ref_end, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END, round_even(pident, 2), mapq FROM filtered WHERE drop_reason IS NULL AND zr)"""
SEGMENTS = f"""WITH {sql("alignments")}, ends AS (SELECT sample, reference, ref_start AS pos, 1 AS d FROM alignments WHERE (flag & 2308) = 0 AND ref_end > ref_start UNION ALL SELECT sample, reference, ref_end, -1 FROM alignments WHERE (flag & 2308) = 0 AND ref_end > ref_start),
steps AS (SELECT sample, reference, pos, sum(d) AS d FROM ends GROUP BY ALL),
run AS (SELECT sample, reference, pos AS start, lead(pos) OVER w AS "end", sum(d) OVER w AS depth FROM steps WINDOW w AS (PARTITION BY sample, reference ORDER BY pos)),
segments AS (SELECT sample, reference, start, "end", depth::BIGINT AS depth FROM run WHERE depth > 0 AND "end" IS NOT NULL),
lengths AS (SELECT DISTINCT sample, reference, ref_length AS length FROM alignments)"""


def primary_blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = view(spark, sf_dir, "alignments")
    blocks = a.where((F.col("flag").bitwiseAND(alignment.SKIPPED_FLAGS) == 0) & (F.col("ref_end") > F.col("ref_start"))).select("sample", "reference", F.col("ref_start").alias("start"), F.col("ref_end").alias("end"))
    return depth.depth_segments(blocks, ["sample", "reference"]), a.select("sample", "reference", F.col("ref_length").alias("length")).distinct()


@query(f"{FILTERED} SELECT sample, query_name, drop_reason, round_even(pident, 6) AS pident, zl, zr, za FROM filtered")
def q02_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(spark, sf_dir).select("sample", "query_name", "drop_reason", F.bround("pident", 6).alias("pident"), "zl", "zr", "za")


@query(f"{FILTERED} SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM filtered GROUP BY 1")
def q03_drop_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.reason_counts(filtered(spark, sf_dir))


@query(f"{OVERHANGS} SELECT * FROM cut")
def q04_overhang_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.overhangs(filtered(spark, sf_dir))


@query(f"{OVERHANGS} SELECT sample, is_element, bucket, count(*) AS n_seqs FROM cut GROUP BY ALL")
def q04_overhang_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.manifest(alignment.overhangs(filtered(spark, sf_dir)))


@query(f"{SEGMENTS} SELECT * FROM segments")
def q05_depth_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary_blocks(spark, sf_dir)[0]


@query(
    f"""{SEGMENTS}, deep AS (SELECT sample, reference, sum("end" - start)::BIGINT AS covered FROM segments WHERE depth >= 2 GROUP BY ALL)
SELECT sample, reference, length, coalesce(covered, 0)::BIGINT AS covered, round_even(coalesce(covered, 0) / length, 6) AS frac, coalesce(covered, 0) / length >= 0.2 AS keep FROM lengths LEFT JOIN deep USING (sample, reference) WHERE length > 0"""
)
def q06_element_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, lengths = primary_blocks(spark, sf_dir)
    return depth.breadth(segments, lengths, ["sample", "reference"], 2, 0.2).withColumn("frac", F.bround("frac", 6))


@query(
    f"""{SEGMENTS}, deep AS (SELECT sample, reference FROM (SELECT sample, reference, sum("end" - start) AS covered FROM segments WHERE depth >= 2 GROUP BY ALL) JOIN lengths USING (sample, reference) WHERE covered / length >= 0.2)
SELECT sample, query_name, reference, mapq FROM alignments SEMI JOIN deep USING (sample, reference)"""
)
def q06_covered_elements_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, lengths = primary_blocks(spark, sf_dir)
    kept = depth.breadth(segments, lengths, ["sample", "reference"], 2, 0.2).where("keep")
    return view(spark, sf_dir, "alignments").join(kept, ["sample", "reference"], "left_semi").select("sample", "query_name", "reference", "mapq")


def _stat(name: str, low: str, high: str, size: str) -> str:
    part = f"greatest(0, least(\"end\", {high}) - greatest(start, {low}))"
    return f"""round_even(coalesce(sum(depth * {part}), 0) / {size}, 6) AS mean{name}, round_even(greatest(0.0, coalesce(sum(depth * depth * {part}), 0) / {size} - (coalesce(sum(depth * {part}), 0) / {size}) * (coalesce(sum(depth * {part}), 0) / {size})), 6) AS var{name}"""


@query(
    f"""{SEGMENTS} SELECT sample, reference, length, {_stat("", "0", "length", "length")}, {_stat("_first", "0", "least(200, length)", "least(200, length)")}, {_stat("_last", "length - least(200, length)", "length", "least(200, length)")}
FROM lengths LEFT JOIN segments USING (sample, reference) WHERE length > 0 GROUP BY sample, reference, length"""
)
def q07_coverage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, lengths = primary_blocks(spark, sf_dir)
    out = depth.coverage_stats(segments, lengths, ["sample", "reference"])
    return out.withColumns({c: F.bround(c, 6) for c in out.columns if c[:3] in ("mea", "var")})


@query(
    f"""{FILTERED}, counted AS (SELECT *, sum(CASE WHEN zl AND NOT za THEN 1 ELSE 0 END) OVER w AS nl, sum(CASE WHEN zr AND NOT za THEN 1 ELSE 0 END) OVER w AS nr FROM filtered WHERE drop_reason IS NULL WINDOW w AS (PARTITION BY sample, reference)),
cleared AS (SELECT sample, query_name, reference, zl AND (za OR nl >= 2) AS zl, zr AND (za OR nr >= 2) AS zr, za FROM counted) SELECT * FROM cleared WHERE zl OR zr"""
)
def q08_side_hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.side_hits(filtered(spark, sf_dir), 2).select("sample", "query_name", "reference", "zl", "zr", "za")


@query(f"WITH {sql('alignments')} SELECT sample, count(*) AS n_reads, sum(length(query_sequence))::BIGINT AS total_bases, round_even(avg(length(query_sequence)), 2) AS mean_read_length FROM alignments GROUP BY sample")
def q09_read_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depth.read_stats(view(spark, sf_dir, "alignments").withColumn("n", F.length("query_sequence")), ["sample"], "n")


@query(
    f"""WITH {sql("overhangs")}, refs AS (SELECT is_element, max(seq) AS target FROM overhangs GROUP BY 1), d AS (SELECT DISTINCT is_element, seq, target, greatest(1, round_even(length(seq) * 0.1, 0)::INT) AS k FROM overhangs JOIN refs USING (is_element)),
e AS (SELECT *, list_min([levenshtein(seq, target[1:j]) FOR j IN range(greatest(0, length(seq) - k), least(length(target), length(seq) + k) + 1)]) AS best FROM d)
SELECT is_element, seq, k AS budget, CASE WHEN best <= k THEN best::INT END AS distance FROM e"""
)
def q10_anchored_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "overhangs")
    pairs = o.select("is_element", "seq").distinct().join(o.groupBy("is_element").agg(F.max("seq").alias("target")), "is_element")
    pairs = pairs.withColumn("budget", edit_budget(F.length("seq"), 0.1))
    return pairs.select("is_element", "seq", "budget", anchored_distance(F.col("seq"), F.col("target"), F.col("budget")).alias("distance"))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_reads(view(spark, sf_dir, "overhangs").where("bucket <> 'ambiguous'"))


#: One step for each distinct sequence, longest first: it joins the earliest seed that it matches, or becomes one.
LEADERS = f"""WITH RECURSIVE {sql("overhangs")}, items AS (SELECT sample, is_element, side, CASE WHEN side = 'left' THEN reverse(seq) ELSE seq END AS cmp, min(read_id) AS id FROM overhangs WHERE bucket <> 'ambiguous' GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample, is_element, side ORDER BY length(cmp) DESC, id, cmp) AS r, greatest(1, round_even(length(cmp) * 0.1, 0)::INT) AS k FROM items),
fold AS (SELECT sample, is_element, side, 0::BIGINT AS r, []::VARCHAR[] AS seeds, NULL::VARCHAR AS cmp, 0::BIGINT AS seed FROM ranked WHERE r = 1
  UNION ALL
  SELECT sample, is_element, side, r, CASE WHEN hit IS NULL THEN list_append(seeds, cmp) ELSE seeds END, cmp, coalesce(hit - 1, len(seeds)) FROM (
    SELECT f.sample, f.is_element, f.side, n.r, f.seeds, n.cmp,
      list_position(list_transform(f.seeds, lambda s: list_min([levenshtein(n.cmp, s[1:j]) FOR j IN range(greatest(0, length(n.cmp) - n.k), least(length(s), length(n.cmp) + n.k) + 1)]) <= n.k), true) AS hit
    FROM fold f JOIN ranked n ON n.sample = f.sample AND n.is_element = f.is_element AND n.side = f.side AND n.r = f.r + 1))"""


@query(f"{LEADERS} SELECT sample, is_element, side, cmp, seed::INT AS seed FROM fold WHERE r > 0")
def q11_leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = view(spark, sf_dir, "overhangs").where("bucket <> 'ambiguous'").withColumn("cmp", clustering.compared(F.col("seq"), F.col("side")))
    return clustering.leader_clusters(items, ["sample", "is_element", "side"], 0.10).select("sample", "is_element", "side", "cmp", "seed").distinct()


#: The same fold over the seeds, in the looser budget, then sizes, numbers and representatives.
MERGED = f"""{LEADERS}, seeds AS (SELECT f.sample, f.is_element, f.side, f.seed, r.id, r.cmp FROM fold f JOIN ranked r USING (sample, is_element, side, r) QUALIFY row_number() OVER (PARTITION BY f.sample, f.is_element, f.side, f.seed ORDER BY f.r) = 1),
again AS (SELECT *, row_number() OVER (PARTITION BY sample, is_element, side ORDER BY length(cmp) DESC, id, cmp) AS r, greatest(1, round_even(length(cmp) * 0.15, 0)::INT) AS k FROM seeds),
refold AS (SELECT sample, is_element, side, 0::BIGINT AS r, []::VARCHAR[] AS heads, NULL::BIGINT AS seed, 0::BIGINT AS merged FROM again WHERE r = 1
  UNION ALL
  SELECT sample, is_element, side, r, CASE WHEN hit IS NULL THEN list_append(heads, cmp) ELSE heads END, seed, coalesce(hit - 1, len(heads)) FROM (
    SELECT f.sample, f.is_element, f.side, n.r, f.heads, n.cmp, n.seed,
      list_position(list_transform(f.heads, lambda s: list_min([levenshtein(n.cmp, s[1:j]) FOR j IN range(greatest(0, length(n.cmp) - n.k), least(length(s), length(n.cmp) + n.k) + 1)]) <= n.k), true) AS hit
    FROM refold f JOIN again n ON n.sample = f.sample AND n.is_element = f.is_element AND n.side = f.side AND n.r = f.r + 1)),
reads AS (SELECT sample, is_element, side, read_id, seq, CASE WHEN side = 'left' THEN reverse(seq) ELSE seq END AS cmp FROM overhangs WHERE bucket <> 'ambiguous'),
owned AS (SELECT d.*, g.merged, count(*) OVER w AS n, first_value(d.seq) OVER (w ORDER BY length(d.cmp) DESC, d.read_id, d.cmp) AS rep FROM reads d JOIN fold f USING (sample, is_element, side, cmp) JOIN refold g ON g.sample = d.sample AND g.is_element = d.is_element AND g.side = d.side AND g.seed = f.seed WINDOW w AS (PARTITION BY d.sample, d.is_element, d.side, g.merged))"""


@query(f"{MERGED} SELECT sample, is_element, side, read_id, (dense_rank() OVER (PARTITION BY sample, is_element, side ORDER BY merged) - 1)::INT AS cluster_id, rep AS representative_sequence FROM owned WHERE n >= 2")
def q12_merged_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark, sf_dir).select("sample", "is_element", "side", "read_id", "cluster_id", "representative_sequence")


def recruited(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ambiguous reads with the clusters that the other reads form, and these clusters."""
    o = view(spark, sf_dir, "overhangs")
    reps = cut_lineage(clustering.cluster_reads(o.where("bucket <> 'ambiguous'"), only_sizes=True))
    return clustering.recruit(o.where("bucket = 'ambiguous'"), reps), reps


RECRUIT = f"""{MERGED}, reps AS (SELECT sample, is_element, side AS rep_side, (dense_rank() OVER (PARTITION BY sample, is_element, side ORDER BY merged) - 1)::INT AS cluster_id, any_value(rep) AS rep, count(*) AS n_reads FROM owned WHERE n >= 2 GROUP BY sample, is_element, side, merged),
amb AS (SELECT *, row_number() OVER () AS rid FROM overhangs WHERE bucket = 'ambiguous'),
pairs AS (SELECT a.rid, r.rep_side, r.cluster_id, CASE WHEN r.rep_side = a.side THEN a.seq ELSE reverse(translate(a.seq, 'ACGTacgt', 'TGCAtgca')) END AS x, r.rep AS y FROM amb a JOIN reps r USING (sample, is_element)),
turned AS (SELECT *, CASE WHEN rep_side = 'left' THEN reverse(x) ELSE x END AS u, CASE WHEN rep_side = 'left' THEN reverse(y) ELSE y END AS v FROM pairs),
qt AS (SELECT rid, rep_side, cluster_id, CASE WHEN length(u) <= length(v) THEN u ELSE v END AS q, CASE WHEN length(u) <= length(v) THEN v ELSE u END AS t FROM turned),
dist AS (SELECT *, greatest(1, round_even(length(q) * 0.1, 0)::INT) AS k FROM qt WHERE length(q) > 0),
best AS (SELECT *, list_min([levenshtein(q, t[1:j]) FOR j IN range(greatest(0, length(q) - k), least(length(t), length(q) + k) + 1)]) AS d FROM dist),
near AS (SELECT *, d / length(q) AS norm, min(d / length(q)) OVER (PARTITION BY rid) AS least FROM best WHERE d <= k),
won AS (SELECT rid, count(*) AS ties, any_value(rep_side) AS rep_side, any_value(cluster_id) AS cluster_id, any_value(norm) AS norm FROM near WHERE norm - least <= 1e-9 GROUP BY ALL),
recruited AS (SELECT a.sample, a.read_id, a.is_element, a.side AS called_side, CASE WHEN ties = 1 THEN rep_side END AS side, CASE WHEN ties = 1 THEN cluster_id END AS cluster_id, CASE WHEN ties = 1 THEN round_even(norm, 6) END AS recruit_norm_dist, CASE WHEN ties IS NULL THEN 'no_match' WHEN ties > 1 THEN 'tie' END AS reason FROM amb a LEFT JOIN won USING (rid))"""


@query(f"{RECRUIT} SELECT * FROM recruited")
def q13_recruit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recruited(spark, sf_dir)[0].drop("seq")


@query(
    f"""{RECRUIT}, n AS (SELECT sample, is_element, side, cluster_id, count(*) AS n FROM recruited WHERE reason IS NULL GROUP BY ALL)
SELECT r.sample, 'cluster' AS row_type, r.is_element, rep_side AS side, r.cluster_id, NULL AS reason, n_reads AS n_core, coalesce(n, 0) AS n_recruited, n_reads + coalesce(n, 0) AS n_total FROM reps r LEFT JOIN n ON r.sample = n.sample AND r.is_element = n.is_element AND r.rep_side = n.side AND r.cluster_id = n.cluster_id
UNION ALL SELECT sample, 'unassigned', is_element, called_side, NULL, reason, NULL, count(*), NULL FROM recruited WHERE reason IS NOT NULL GROUP BY sample, is_element, called_side, reason"""
)
def q14_cluster_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, reps = recruited(spark, sf_dir)
    return clustering.cluster_coverage(reps, found)

"""Queries over metadata, names, sizes and parsed text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.adapters import sql, view
from flankspark.jobs.catalogue import query
from flankspark.operators import events, metadata, placement
from flankspark.sources.text import overhang_header, parse_members, parse_overhang_header
from flankspark.tables import table

SRA = "sra AS (SELECT cast(o_orderkey AS string) AS Accession, cast(o_custkey % 100 * 100 + o_orderkey % 40 AS string) AS Submission, CASE WHEN o_orderstatus = 'P' THEN '-' WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE cast(cast(floor(o_totalprice) AS bigint) * 1000 AS string) END AS Bases, CASE WHEN o_orderkey % 17 = 0 THEN '-' ELSE cast(o_custkey AS string) END AS BioSample FROM orders)"
ATB = "atb AS (SELECT cast(c_custkey AS string) AS sample_accession, cast(c_custkey * 3 AS string) AS run_accession, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'abc' ELSE concat(cast(c_custkey * 1000 + c_nationkey AS string), '.0') END AS Genome_Size FROM customer)"


def sra(spark: SparkSession, sf_dir: str) -> DataFrame:
    bases = "CASE WHEN o_orderstatus = 'P' THEN '-' WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE cast(cast(floor(o_totalprice) AS bigint) * 1000 AS string) END AS Bases"
    return table(spark, sf_dir, "orders").selectExpr("cast(o_orderkey AS string) AS Accession", "cast(o_custkey % 100 * 100 + o_orderkey % 40 AS string) AS Submission", bases, "CASE WHEN o_orderkey % 17 = 0 THEN '-' ELSE cast(o_custkey AS string) END AS BioSample")


def atb(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = "CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'abc' ELSE concat(cast(c_custkey * 1000 + c_nationkey AS string), '.0') END AS Genome_Size"
    return table(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS sample_accession", "cast(c_custkey * 3 AS string) AS run_accession", size, "c_custkey AS ordinal")


PASSING = f"WITH {SRA}, {ATB}, passing AS (SELECT * FROM sra WHERE Bases <> '-' AND BioSample <> '-' AND BioSample IN (SELECT sample_accession FROM atb) AND try_cast(Bases AS double) >= 50e6 AND try_cast(Bases AS double) < 200e6)"


def passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.usable_runs(sra(spark, sf_dir), atb(spark, sf_dir), 50e6, 200e6)


@query(f"{PASSING} SELECT Accession, BioSample, Bases FROM passing")
def q30_metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passing(spark, sf_dir).select("Accession", "BioSample", "Bases")


@query(f"{PASSING} SELECT sample_accession, run_accession FROM atb WHERE run_accession IN (SELECT Accession FROM passing)")
def q30_passing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.passing_samples(atb(spark, sf_dir), passing(spark, sf_dir)).select("sample_accession", "run_accession")


@query(f"WITH {ATB} SELECT run_accession, floor(try_cast(Genome_Size AS double))::BIGINT AS genome_size FROM atb WHERE try_cast(Genome_Size AS double) > 0")
def q30_genome_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.genome_sizes(atb(spark, sf_dir), ["ordinal"])


@query(f"WITH {SRA} SELECT Accession, Submission FROM sra WHERE Submission IN (SELECT Submission FROM sra GROUP BY 1 HAVING count(*) = 1)")
def q31_single_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.only_once(sra(spark, sf_dir), "Submission").select("Accession", "Submission")


@query(
    """WITH a AS (SELECT c_custkey AS id, c_mktsegment AS v FROM customer), b AS (SELECT CASE WHEN o_custkey % 7 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS id, max(CASE WHEN o_custkey % 2 = 0 THEN c_mktsegment ELSE 'other' END) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'only_first' WHEN a.id IS NULL THEN 'only_second' WHEN a.v = b.v THEN 'same' ELSE 'different' END AS state FROM a FULL JOIN b ON a.id = b.id"""
)
def q32_id_set_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    a = c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))
    b = o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy(F.when(F.col("o_custkey") % 7 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).alias("id")).agg(F.max(F.when(F.col("o_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("other")).alias("v"))
    return metadata.compare_ids(a, b, "id", "v")


@query(
    f"""WITH {sql("placements")}, c AS (SELECT sample, is_element, cluster_id, count(*) AS n FROM placements GROUP BY ALL)
SELECT sample, is_element, cluster_id, n, round_even(n / max(n) OVER (PARTITION BY sample), 6) AS share, sum(n) OVER (PARTITION BY sample) < 30 AS few FROM c QUALIFY n / max(n) OVER (PARTITION BY sample) >= 0.5"""
)
def q33_cluster_share_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = view(spark, sf_dir, "placements").groupBy("sample", "is_element", "cluster_id").agg(F.count("*").alias("n"))
    return events.large_clusters(c, "sample", "n", 0.5).withColumn("share", F.bround("share", 6))


MEMBERS = "lines AS (SELECT cast(l_orderkey % 3000 AS int) AS cluster, concat(cast(l_linenumber AS string), '\t', cast(500 + l_partkey % 300 AS string), 'nt, >', CASE WHEN l_suppkey % 3 = 0 THEN 'ISOSDB' ELSE 'IS' END, cast(l_partkey AS string), '... ', CASE WHEN l_linenumber = 1 THEN '*' ELSE concat(CASE WHEN l_suppkey % 2 = 0 THEN 'at 1:100:1:100/+/' ELSE 'at +/' END, cast(90 + l_suppkey % 10 AS string), '.50%') END) AS line, l_linenumber AS ordinal, 500 + l_partkey % 300 AS length, concat(CASE WHEN l_suppkey % 3 = 0 THEN 'ISOSDB' ELSE 'IS' END, cast(l_partkey AS string)) AS name, l_linenumber = 1 AS is_rep, (CASE WHEN l_linenumber = 1 THEN 100.0 ELSE 90 + l_suppkey % 10 + 0.5 END)::DOUBLE AS identity FROM lineitem)"


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.when(F.col("l_suppkey") % 3 == 0, "ISOSDB").otherwise("IS"), F.col("l_partkey").cast("string"))
    at = F.when(F.col("l_suppkey") % 2 == 0, "at 1:100:1:100/+/").otherwise("at +/")
    tail = F.when(F.col("l_linenumber") == 1, "*").otherwise(F.concat(at, (F.col("l_suppkey") % 10 + 90).cast("string"), F.lit(".50%")))
    line = F.concat(F.col("l_linenumber").cast("string"), F.lit("\t"), (F.col("l_partkey") % 300 + 500).cast("string"), F.lit("nt, >"), name, F.lit("... "), tail)
    return parse_members(table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 3000).cast("int").alias("cluster"), line.alias("line")))


@query(f"WITH {MEMBERS} SELECT cluster, ordinal, length, name, is_rep, identity FROM lines")
def q22_cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir)


@query(
    f"""WITH {MEMBERS}, m AS (SELECT DISTINCT cluster, ordinal, length, name, identity FROM lines WHERE NOT starts_with(name, 'ISOSDB')), b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY identity DESC, length DESC, ordinal, name) = 1),
r AS (SELECT DISTINCT cluster, name FROM lines WHERE is_rep) SELECT r.cluster, r.name, coalesce(b.name, r.name) AS new_name FROM r LEFT JOIN b USING (cluster)"""
)
def q34_rename_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = members(spark, sf_dir)
    known = m.where(~F.startswith("name", F.lit("ISOSDB"))).select("cluster", "ordinal", "length", "name", "identity").distinct().withColumn("ordinal", F.struct("ordinal", "name"))
    best = metadata.best_members(known).select("cluster", F.col("name").alias("new_name"))
    reps = m.where("is_rep").select("cluster", "name").distinct()
    return reps.join(best, "cluster", "left").withColumn("new_name", F.coalesce("new_name", "name"))


@query(
    """WITH names AS (SELECT DISTINCT substring(p_name, 1, 3 + p_size % 6) AS name FROM part), texts AS (SELECT p_partkey AS id, p_name AS body FROM part)
SELECT id, body, max_by(name, length(name)) AS name FROM texts JOIN names ON starts_with(body, name) GROUP BY id, body"""
)
def q35_prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = p.select(F.expr("substring(p_name, 1, 3 + p_size % 6)").alias("name")).distinct()
    return metadata.longest_prefix(p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("body")), names)


def _slope(of: str, to: str, table_: str) -> str:
    return f"""(SELECT *, CASE WHEN a IS NULL THEN (n - c) / b WHEN b IS NULL THEN (c - p) / a ELSE (a * a * n - b * b * p + (b * b - a * a) * c) / (a * b * (a + b)) END AS {to}
  FROM (SELECT * EXCLUDE (a, b, p, n, c), x - lag(x) OVER w AS a, lead(x) OVER w - x AS b, lag({of}) OVER w AS p, lead({of}) OVER w AS n, {of} AS c FROM {table_} WINDOW w AS (PARTITION BY kind ORDER BY x)))"""


CURVE = "curve AS (SELECT event_type AS kind, (user_id * user_id + user_id)::DOUBLE AS x, count(*)::DOUBLE AS y, 0 AS a, 0 AS b, 0 AS p, 0 AS n, 0 AS c FROM events GROUP BY 1, user_id)"


@query(f"WITH {CURVE}, d1 AS {_slope('y', 'd1', 'curve')}, d2 AS {_slope('d1', 'd2', 'd1')} SELECT kind, x, round_even(abs(d2), 9) AS bend FROM d2 QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round_even(abs(d2), 9) DESC, x) = 1")
def q36_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("kind"), (F.col("user_id") * F.col("user_id") + F.col("user_id")).cast("double").alias("x")).agg(F.count("*").cast("double").alias("y"))
    return metadata.elbow(curve, ["kind"], "x", "y")


@query(f"WITH {sql('overhangs')} SELECT seq, count(*) AS n FROM overhangs GROUP BY 1 HAVING count(*) > 1")
def q37_duplicate_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.duplicates(view(spark, sf_dir, "overhangs"), "seq")


@query(
    f"""WITH {ATB}, r AS (SELECT cast(o_custkey AS string) AS sample, sum(floor(o_totalprice))::BIGINT AS total_bases FROM orders GROUP BY 1), g AS (SELECT run_accession AS sample, floor(try_cast(Genome_Size AS double))::BIGINT AS genome_size FROM atb WHERE try_cast(Genome_Size AS double) > 0),
k AS (SELECT cast(c_custkey AS string) AS sample, c_nationkey + 1 AS n_seqs FROM customer)
SELECT sample, n_seqs, round_even(nullif(total_bases / nullif(genome_size, 0), 0), 4) AS est_coverage, round_even(n_seqs / nullif(total_bases / nullif(genome_size, 0), 0), 6) AS coverage_fraction FROM k LEFT JOIN r USING (sample) LEFT JOIN g USING (sample)"""
)
def q38_estimated_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("sample")).agg(F.sum(F.floor("o_totalprice")).alias("total_bases"))
    k = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("sample"), (F.col("c_nationkey") + 1).alias("n_seqs"))
    return placement.estimated_coverage(k, reads, metadata.genome_sizes(atb(spark, sf_dir), ["ordinal"]))


@query(f"WITH {sql('overhangs')} SELECT sample, read_id, is_element, cast(length(seq) AS string) AS pos, side, '+' AS strand, 98.5::DOUBLE AS pident, CASE WHEN mapq % 2 = 0 THEN mapq END AS mapq FROM overhangs")
def q39_header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = view(spark, sf_dir, "overhangs").withColumns({"pos": F.length("seq"), "strand": F.lit("+"), "pident": F.lit(98.5), "mapq": F.when(F.col("mapq") % 2 == 0, F.col("mapq"))})
    return o.select(overhang_header(o).alias("h")).select(parse_overhang_header(F.col("h")).alias("p")).select("p.*")


@query(
    f"""WITH {sql("overhangs")}, c AS (SELECT sample, is_element, side, count(*) AS n, count(DISTINCT seq) AS d FROM overhangs GROUP BY ALL)
SELECT side, count(*) AS n_groups, sum(n)::BIGINT AS total, sum(d)::BIGINT AS n_distinct, min(n) AS low, max(n) AS high, round_even(avg(n), 6) AS mean, round_even(quantile_cont(n, 0.25), 6) AS q1, round_even(quantile_cont(n, 0.5), 6) AS q2, round_even(quantile_cont(n, 0.75), 6) AS q3 FROM c GROUP BY side"""
)
def q40_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = view(spark, sf_dir, "overhangs").groupBy("sample", "is_element", "side").agg(F.count("*").alias("n"), F.countDistinct("seq").alias("d"))
    q = lambda p, k: F.bround(F.percentile("n", F.lit(p)), 6).alias(k)
    return c.groupBy("side").agg(F.count("*").alias("n_groups"), F.sum("n").alias("total"), F.sum("d").alias("n_distinct"), F.min("n").alias("low"), F.max("n").alias("high"), F.bround(F.avg("n"), 6).alias("mean"), q(0.25, "q1"), q(0.5, "q2"), q(0.75, "q3"))

"""Queries over archives, BAM files and manifests, identity clusters, incremental runs and small selections; files are written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.adapters import bases, sql, view
from flankspark.functions.sequences import file_stem, other_side
from flankspark.jobs.catalogue import ORACLES, query
from flankspark.jobs.flanks import FILTERED, OVERHANGS, alignments, filtered
from flankspark.jobs.formats import PARTS, parts, place
from flankspark.jobs.loci import DISRUPTION, NESTED, disruption, nested_rows
from flankspark.operators import alignment, identity, metadata, nested, placement
from flankspark.sources import archives, bam, sinks, text
from flankspark.streaming.samples import run_new_samples
from flankspark.tables import table


@query(
    f"""WITH {PARTS}, r AS (SELECT name, substring(seq, 1, 30) AS seq FROM parts UNION ALL SELECT concat('g', cast(p_size AS string)), CASE WHEN p_partkey % 9 = 0 THEN '' ELSE substring(seq, 31) END FROM parts), n AS (SELECT name, count(*) AS n FROM r GROUP BY name)
SELECT name, seq, CASE WHEN n > 1 THEN 'repeated' WHEN seq = '' THEN 'empty' END AS problem FROM r JOIN n USING (name)"""
)
def q57_glued_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's record has a second one glued to its sequence; names of the second come often, and some have no sequence."""
    p = parts(spark, sf_dir)
    second = F.concat(F.lit("g"), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 9 == 0, "").otherwise(F.expr("lower(substring(seq, 31))")))
    at = place(spark)
    p.select(F.concat(F.lit(">"), "name", F.lit(" words\n"), F.substring("seq", 1, 30), F.lit(">"), second)).write.text(at)
    return text.read_glued(spark, at, p.select(F.concat(F.lit("g"), F.col("p_size").cast("string")).alias("name")).distinct())


@query(f"WITH {sql('placements')} SELECT sample, is_element, side, cluster_id, junction_pos, score, NULL::VARCHAR AS problem FROM placements")
def q58_table_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zip for each sample, and empty ones for samples that aren't in the table."""
    p = view(spark, sf_dir, "placements").select("sample", "is_element", "side", "cluster_id", "junction_pos", "score")
    at = place(spark)
    archives.write_archives(p, at, samples=p.select("sample").union(table(spark, sf_dir, "nation").select(F.concat(F.lit("none"), "n_nationkey"))))
    return archives.read_tables(spark, at, "side string, cluster_id int, junction_pos int, score double")


def with_database(overhang: DataFrame) -> DataFrame:
    return overhang.withColumn("database", F.when(F.col("pos") % 3 == 0, "IS").when(F.col("pos") % 3 == 1, "Tn"))


@query(f"{OVERHANGS} SELECT sample, is_element, bucket, concat_ws('|', sample, read_id, is_element, concat('pos:', pos)) AS header, seq, NULL::VARCHAR AS problem FROM cut WHERE is_element IN ('E1', 'E4', 'E17')")
def q59_flank_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tar.gz of FASTA files and a manifest for each sample; some elements are read back, by a filter that the source takes."""
    cut = with_database(alignment.overhangs(filtered(spark, sf_dir)))
    header = F.concat_ws("|", "sample", "read_id", "is_element", F.concat(F.lit("pos:"), F.col("pos").cast("string")))
    at = place(spark)
    archives.write_archives(cut.select("sample", "is_element", "bucket", header.alias("header"), "seq", "database"), at, "flanks")
    return archives.read_flanks(spark, at, ["E1", "E4", "E17"])


@query(
    f"""{OVERHANGS}, d AS (SELECT *, CASE WHEN pos % 3 = 0 THEN 'IS' WHEN pos % 3 = 1 THEN 'Tn' ELSE '' END AS database FROM cut), n AS (SELECT sample, is_element, bucket, count(*) AS n_seqs FROM cut GROUP BY ALL)
SELECT sample, is_element, bucket, n_seqs, database FROM n JOIN (SELECT sample, is_element, arg_max(database, (pos, read_id, side)) AS database FROM d GROUP BY ALL) USING (sample, is_element)"""
)
def q60_manifest_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.manifest_with_database(with_database(alignment.overhangs(filtered(spark, sf_dir))), ["pos", "read_id", "side"]).select("sample", "is_element", "bucket", "n_seqs", "database")


@query(f"{OVERHANGS} SELECT sample, read_id, is_element, side, pos FROM cut WHERE bucket <> 'ambiguous' AND is_element IN ('E2', 'E3', 'E5', 'E8')")
def q61_manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = alignment.overhangs(filtered(spark, sf_dir))
    return alignment.scan_by(alignment.manifest(cut), cut, ["E2", "E3", "E5", "E8"]).select("sample", "read_id", "is_element", "side", "pos")


@query(f"{DISRUPTION} SELECT sample, is_element, side, cluster_id FROM disruption WHERE hit_type = 'no_hit'")
def q62_without_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of the disruption tables are read, and the clusters without a place taken from them."""
    d = disruption(spark, sf_dir).select("sample", "is_element", "side", "cluster_id", "hit_type", F.lit("ACGT").alias("rep_seq"))
    at = place(spark)
    archives.write_archives(d, at)
    return nested.without_place(archives.read_tables(spark, at, "side string, cluster_id int, hit_type string, rep_seq string")).drop("rep_seq")


def bam_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The adapter's alignments as read from BAM files without tags of the filter, and the references."""
    a = alignments(spark, sf_dir).withColumns({"cigar": F.when(F.size(F.filter("cigar", lambda x: x["len"] > 0)) > 0, F.filter("cigar", lambda x: x["len"] > 0)), "ref_end": F.lit(None).cast("int")})
    references = a.where("ref_length is not null").select("reference", F.col("ref_length").alias("length")).distinct()
    return a, references


BAM = f"""WITH {sql("alignments")}, a AS (SELECT *, ref_length IS NULL AS unknown FROM alignments)
SELECT sample, query_name, CASE WHEN NOT unknown THEN reference END AS reference, ref_length, ref_start, CASE WHEN ref_end > ref_start THEN ref_end WHEN left_clip + right_clip > 0 THEN ref_start END AS ref_end, mapq, flag, nm, query_sequence, left_clip, CASE WHEN ref_end <= ref_start AND left_clip > 0 AND right_clip = 0 THEN left_clip ELSE right_clip END AS right_clip FROM a"""


@query(f"SELECT sample, query_name, reference, ref_length, ref_start, ref_end, mapq, flag, nm, query_sequence, left_clip FROM ({BAM})")
def q63_bam_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alignments, written to a BAM for each sample and read in splits."""
    rows, references = bam_rows(spark, sf_dir)
    at = place(spark)
    bam.write_bam(rows, references, at)
    s = bam.read_bam(spark, at, 1 << 17).withColumn("left_clip", F.coalesce(alignment.clip_length(F.col("cigar"), 1), F.lit(0)))
    return s.select("sample", "query_name", "reference", "ref_length", "ref_start", "ref_end", "mapq", "flag", "nm", "query_sequence", "left_clip")


@query(f"{FILTERED} SELECT sample, query_name, reference, ref_start, ref_end, round_even(pident::FLOAT::DOUBLE, 4) AS zi, zl, zr, za FROM filtered WHERE drop_reason IS NULL")
def q64_tagged_bam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept reads with the filter's findings as tags, written and read back."""
    kept = filtered(spark, sf_dir).where("drop_reason is null").withColumn("zi", F.col("pident").cast("float"))
    at = place(spark)
    bam.write_bam(kept, kept.select("reference", F.col("ref_length").alias("length")).distinct(), at)
    return bam.read_bam(spark, at).select("sample", "query_name", "reference", "ref_start", "ref_end", F.bround(F.col("zi").cast("double"), 4).alias("zi"), "zl", "zr", "za")


FAMILY = f"concat(substring(concat(substring({bases('p_partkey % 60')}, 1, cast(p_size as int) % 30), 'G', substring({bases('p_partkey % 60')}, cast(p_size as int) % 30 + 2, 40), {bases('p_partkey % 60 + 1000')}, {bases('p_partkey % 60 + 2000')}), 1 + cast(p_partkey % 4 as int), 90), substring({bases('p_partkey')}, 1, cast(p_partkey % 3 as int)))"


@query()
def q65_identity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of near sequences; edit distances to parts of a sequence are out of SQL's reach, so a test compares brute force."""
    p = table(spark, sf_dir, "part").selectExpr("concat('p', cast(p_partkey as string)) as name", f"{FAMILY} as seq")
    return identity.identity_clusters(p, 0.95, 10)


@query(f"{OVERHANGS} SELECT * FROM cut")
def q66_incremental_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overhangs of samples that arrive in two lots; the second run works on the samples of its lot only."""
    a = alignments(spark, sf_dir)
    at = place(spark)
    for even in (True, False):
        late = F.pmod(F.length("sample") + F.ascii(F.reverse("sample")), F.lit(2)) == (0 if even else 1)
        a.where(late).write.mode("append").parquet(f"{at}-in")
        run_new_samples(spark, f"{at}-in", f"{at}-out", f"{at}-seen", a.schema, lambda rows: alignment.overhangs(alignment.filter_alignments(rows)))
    own = alignment.overhangs(filtered(spark, sf_dir))
    return spark.read.schema(own.schema).parquet(f"{at}-out").select(*own.columns)


@query(
    f"""{NESTED} SELECT n.sample, n.is_element, n.side, n.cluster_id, n.class, b.length AS aln_len, round_even(b.length / b.qlen, 3) AS qcov, round_even(1 / b.bitscore, 9) AS evalue, array_to_string(t.tied, ',') AS tied_targets
FROM nested n JOIN k USING (sample, is_element, side, cluster_id) LEFT JOIN best b ON b.rep_seq = k.rep_seq AND b.side = k.side LEFT JOIN ties t ON t.rep_seq = k.rep_seq AND t.side = k.side"""
)
def q67_nested_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nested.as_output(nested_rows(spark, sf_dir))
    return out.select("sample", "is_element", "side", "cluster_id", "class", "aln_len", "qcov", F.bround(1 / F.col("bitscore"), 9).alias("evalue"), "tied_targets")


@query(
    f"""{NESTED}, s AS (SELECT is_element, target, target_db, class, count(DISTINCT sample) AS n_samples, count(DISTINCT CASE WHEN paired_in_target THEN sample END) AS n_samples_paired FROM nested WHERE class IN ('internal', 'terminal') AND target_db IS NOT NULL AND target IS NOT NULL AND is_element IS NOT NULL GROUP BY ALL)
SELECT is_element, target, target_db, class, n_samples, n_samples_paired, row_number() OVER (ORDER BY n_samples_paired DESC, n_samples DESC, is_element, target, target_db, class) - 1 AS place FROM s"""
)
def q68_summary_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nested.in_order(nested.host_target_summary(nested_rows(spark, sf_dir)))
    return out.select("is_element", "target", "target_db", "class", "n_samples", "n_samples_paired", "place")


@query("SELECT p_partkey, p_name, 'random' AS kind FROM (SELECT * FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 20) UNION ALL SELECT p_partkey, p_name, 'top' FROM (SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20)")
def q69_selected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rows drawn by a seed, and the twenty with the highest price; limits are what these are for."""
    p = table(spark, sf_dir, "part")
    draw = lambda df, kind: df.select("p_partkey", "p_name", F.lit(kind).alias("kind"))
    return draw(metadata.sampled(p, "p_partkey", 20), "random").unionByName(draw(metadata.top(p, [F.desc("p_retailprice"), "p_partkey"], 20), "top"))


@query(f"WITH {sql('placements')} SELECT sample, is_element, count(*) AS n FROM placements WHERE sample IN (SELECT DISTINCT sample FROM placements ORDER BY sample LIMIT 5) GROUP BY ALL")
def q70_first_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the first five samples by name, which is what such a trial run is for."""
    return metadata.of_first_inputs(view(spark, sf_dir, "placements"), "sample", 5).groupBy("sample", "is_element").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'right' ELSE 'left' END AS other, CASE WHEN p_size % 5 = 0 THEN concat('G', cast(p_size AS string), '.v1') ELSE concat('G', cast(p_size AS string)) END AS stem FROM part")
def q71_sides_and_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    name = F.concat(F.lit("/data/run.1/G"), F.col("p_size").cast("string"), F.when(F.col("p_size") % 5 == 0, ".v1.gbff").when(F.col("p_size") % 5 == 1, "").otherwise(".gbff"))
    return p.select("p_partkey", other_side(F.when(F.col("p_size") % 2 == 0, "left").otherwise("right")).alias("other"), file_stem(name).alias("stem"))


@query(f"WITH {sql('placements')} SELECT sample, is_element, count(*) AS n_events FROM placements GROUP BY ALL")
def q72_long_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = place(spark)
    sinks.write_long(view(spark, sf_dir, "placements").groupBy("sample", "is_element").agg(F.count("*").alias("n_events")), at)
    return spark.read.csv(at, header=True, schema="sample string, is_element string, n_events long").select("sample", "is_element", "n_events")


@query("SELECT concat('n', cast(n_nationkey AS string)) AS Accession, n_name AS Sample FROM nation UNION ALL SELECT concat('s', cast(s_suppkey AS string)), s_name FROM supplier")
def q73_listed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables named in a list file, by wildcards and one by one; one of them is empty."""
    at = place(spark)
    for folder, source, key in (("a/n", "nation", "n_nationkey"), ("b", "supplier", "s_suppkey"), ("c", "region", "r_regionkey")):
        rows = table(spark, sf_dir, source).select(F.concat(F.lit(source[0]), F.col(key).cast("string")).alias("Accession"), F.col(f"{source[0]}_name").alias("Sample"))
        sinks.write_tsv(rows.where("false") if source == "region" else rows, f"{at}/{folder}")
    lines = spark.createDataFrame([("# tables",), (f"{at}/a/*",), ("",), (f"{at}/b",), (f"{at}/c",)], "value string")
    lines.write.text(f"{at}/list")
    return text.read_listed(spark, f"{at}/list", "Accession string, Sample string")


@query("SELECT p_partkey::BIGINT AS id, p_name AS name, concat('run', cast(p_size % 3 AS string)) AS run FROM part")
def q74_tagged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three runs, each row tagged with the run that its file's path names."""
    at = place(spark)
    p = table(spark, sf_dir, "part")
    for k in range(3):
        sinks.write_tsv(p.where(F.col("p_size") % 3 == k).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), f"{at}/run{k}.tables")
    return text.read_tagged(spark, f"{at}/*.tables", "id long, name string", r"/(run\d+)\.tables/", "run")


@query(
    f"""WITH {sql("features")}, {sql("intervals")}, p AS (SELECT DISTINCT chrom, start AS pos FROM intervals),
j AS (SELECT p.chrom, p.pos, concat('g', cast(feature_id AS string)) AS gene, row_number() OVER (PARTITION BY p.chrom, p.pos ORDER BY f.start, f.end_, concat('g', cast(feature_id AS string))) AS r FROM p JOIN features f ON f.chrom = p.chrom AND f.start <= p.pos AND p.pos <= f.end_)
SELECT chrom, pos, gene FROM j WHERE r = 1"""
)
def q75_first_closed_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes = view(spark, sf_dir, "features").select("chrom", "start", F.col("end_").alias("end"), F.concat(F.lit("g"), F.col("feature_id").cast("string")).alias("gene"))
    points = view(spark, sf_dir, "intervals").select("chrom", F.col("start").alias("pos")).distinct()
    return placement.first_gene_closed(points, genes, ["chrom"], ["chrom", "pos"], "pos").select("chrom", "pos", "gene")


@query(f"{OVERHANGS} SELECT sample, read_id, is_element, cast(pos AS string) AS pos, side, strand, CASE WHEN mapq % 2 = 0 THEN round_even(pident, 2) END AS pident FROM cut")
def q76_legacy_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers without a mapq, parsed by the older format, and numbers from texts that may be empty."""
    cut = alignment.overhangs(filtered(spark, sf_dir))
    old = cut.withColumnRenamed("mapq", "quality").withColumn("mapq", F.lit(None).cast("int"))
    number = F.when(F.col("quality") % 2 == 0, F.format_string("%.2f", F.col("h.pident"))).otherwise("")
    return old.select("quality", text.parse_overhang_header(text.overhang_header(old), legacy=True).alias("h")).select("h.sample", "h.read_id", "h.is_element", "h.pos", "h.side", "h.strand", text.to_float(number).alias("pident"))


NO_SQL = frozenset({"q65_identity_clusters"})
assert not NO_SQL & set(ORACLES)

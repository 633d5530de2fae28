"""Queries that write the text formats from the given tables, read them back, and work on what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flankspark.adapters import bases, sql, view
from flankspark.functions.graph import checkpoint_folder
from flankspark.functions.intervals import mask_features
from flankspark.jobs.catalogue import query
from flankspark.jobs.loci import DISRUPTION, disruption
from flankspark.operators import clustering, events, metadata
from flankspark.schemas import HSP
from flankspark.sources import sinks, text
from flankspark.tables import table


def place(spark: SparkSession) -> str:
    """A new path in the shared folder, whose files go when the session ends: results are read lazily, so they are needed until then."""
    parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_folder(spark)}/formats-{uuid.uuid4().hex}")
    system = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(parent)
    system.deleteOnExit(parent)
    return f"{parent.toString()}/files"


PARTS = f"parts AS (SELECT concat('p', cast(p_partkey AS string)) AS name, concat({bases('p_partkey')}, {bases('p_size')}) AS seq, p_size, p_partkey FROM part)"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("concat('p', cast(p_partkey AS string)) AS name", f"concat({bases('p_partkey')}, {bases('p_size')}) AS seq", "p_size", "p_partkey")


def fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = place(spark)
    lines = parts(spark, sf_dir).withColumn("seq", F.concat(F.substring("seq", 1, 30), F.lit("\n"), F.expr("substring(seq, 31)")))
    sinks.write_fasta(lines.withColumn("name", F.concat("name", F.lit(" some words"))), at, "name", "seq")
    return text.read_fasta(spark, at)


@query(f"WITH {PARTS} SELECT name, concat(name, ' some words') AS header, seq FROM parts")
def q42_fasta_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta(spark, sf_dir)


@query(f"WITH {PARTS} SELECT name AS reference, 'db' AS database, length(seq)::INT AS length FROM parts UNION ALL SELECT concat('s', cast(s_suppkey AS string)), 'other', length(s_name)::INT FROM supplier")
def q42_reference_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = table(spark, sf_dir, "supplier").selectExpr("concat('s', cast(s_suppkey AS string)) AS name", "s_name AS seq")
    return text.union_references([text.reference_lengths(fasta(spark, sf_dir), "db"), text.reference_lengths(other, "other")])


@query("SELECT 'repeated name' AS problem, concat('b', cast(p_size AS string)) AS name FROM part GROUP BY p_size HAVING count(*) > 1 UNION ALL SELECT 'empty sequence', concat('b', cast(p_size AS string)) FROM part WHERE p_size % 9 = 0 UNION ALL SELECT 'header inside sequence', concat('b', cast(p_size AS string)) FROM part WHERE p_size % 9 = 4")
def q42_fasta_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "part").selectExpr("concat('b', cast(p_size AS string)) AS name", "case when p_size % 9 = 0 then '' when p_size % 9 = 4 then concat(p_name, '>', p_name) else p_name end AS seq")
    return text.check_fasta(records)


READS = "reads AS (SELECT concat('r', cast(l_orderkey AS string), '_', cast(l_linenumber AS string)) AS read_id, translate(md5(cast(l_partkey AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, concat(CASE WHEN l_partkey % 5 = 0 THEN '@' WHEN l_partkey % 5 = 1 THEN '+' ELSE 'I' END, md5(cast(l_suppkey AS string))) AS q, CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END AS mate FROM lineitem)"


@query(f"WITH {READS} SELECT 'S' AS sample, read_id, seq, substring(q, 1, 32) AS qual, mate FROM reads")
def q43_fastq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('@r', cast(l_orderkey AS string), '_', cast(l_linenumber AS string), ' more') AS h", "translate(md5(cast(l_partkey AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq",
        "substring(concat(CASE WHEN l_partkey % 5 = 0 THEN '@' WHEN l_partkey % 5 = 1 THEN '+' ELSE 'I' END, md5(cast(l_suppkey AS string))), 1, 32) AS q", "l_linenumber % 2 AS odd",
    )
    files = []
    for odd in (1, 0):
        files.append(place(spark))
        own.where(F.col("odd") == odd).select(F.concat_ws("\n", "h", "seq", F.lit("+"), "q")).write.text(files[-1])
    return text.read_reads(spark, "S", files).select("sample", "read_id", "seq", "qual", "mate")


def sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "alignments")
    head = a.where("ref_length is not null").select(F.concat(F.lit("@SQ\tSN:"), "reference", F.lit("\tLN:"), F.col("ref_length").cast("string")).alias("line")).distinct()
    op = lambda c, k: F.when(c > 0, F.concat(c.cast("string"), F.lit(k))).otherwise("")
    cigar = F.concat(op(F.col("left_clip"), "S"), op(F.col("ref_end") - F.col("ref_start"), "M"), op(F.col("right_clip"), "S"))
    fields = ["query_name", F.col("flag").cast("string"), "reference", (F.col("ref_start") + 1).cast("string"), F.col("mapq").cast("string"), F.when(cigar != "", cigar).otherwise("*"), *map(F.lit, ("*", "0", "0")), "query_sequence", F.lit("*"), F.concat(F.lit("RG:Z:"), "sample"), F.concat(F.lit("NM:i:"), F.col("nm").cast("string"))]
    at = place(spark)
    head.unionByName(a.select(F.concat_ws("\t", *fields).alias("line"))).write.text(at)
    return text.read_sam(spark, at)


@query(f"WITH {sql('alignments')} SELECT sample, query_name, reference, ref_length, ref_start, greatest(ref_start, ref_end) AS ref_end, mapq, flag, nm, query_sequence, left_clip, right_clip FROM alignments WHERE ref_end > ref_start OR left_clip + right_clip > 0 UNION ALL SELECT sample, query_name, reference, ref_length, ref_start, NULL, mapq, flag, nm, query_sequence, 0, 0 FROM alignments WHERE NOT (ref_end > ref_start OR left_clip + right_clip > 0)")
def q44_sam_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flankspark.operators.alignment import clip_length

    one = F.size("cigar") == 1
    s = sam(spark, sf_dir).withColumns({"left_clip": F.coalesce(clip_length(F.col("cigar"), 1), F.lit(0)), "right_clip": F.coalesce(F.when(one, 0).otherwise(clip_length(F.col("cigar"), -1)), F.lit(0))})
    return s.select("sample", "query_name", "reference", "ref_length", "ref_start", "ref_end", "mapq", "flag", "nm", "query_sequence", "left_clip", "right_clip")


@query(f"WITH {sql('alignments')}, refs AS (SELECT concat('E', cast(p_partkey % 60 AS string)) AS reference, max(p_size)::INT AS length FROM part GROUP BY 1), m AS (SELECT reference, count(*) AS mapped FROM alignments WHERE (flag & 4) = 0 GROUP BY 1) SELECT reference, length, coalesce(mapped, 0)::BIGINT AS mapped FROM refs LEFT JOIN m USING (reference)")
def q45_reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "part").groupBy(F.concat(F.lit("E"), (F.col("p_partkey") % 60).cast("string")).alias("reference")).agg(F.max("p_size").cast("int").alias("length"))
    return text.reference_counts(view(spark, sf_dir, "alignments"), refs)


@query(f"WITH {sql('hsps')} SELECT qseqid, sseqid, pident, length, 0 AS mismatch, 0 AS gapopen, qstart, qend, sstart, send, round_even(evalue, 9) AS evalue, bitscore, qlen, 1000 AS slen, sstrand FROM hsps")
def q46_hits_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = view(spark, sf_dir, "hsps").withColumns({"mismatch": F.lit(0), "gapopen": F.lit(0), "slen": F.lit(1000), "evalue": F.col("evalue").cast("double")})
    at = place(spark)
    h.select(*[c.strip().split(" ")[0] for c in HSP.split(",")]).write.csv(at, sep="\t", header=False)
    return text.read_hsps(spark, at).withColumn("evalue", F.bround("evalue", 9))


LISTS = """m AS (SELECT cast(l_orderkey % 500 AS int) AS cluster, concat('S', cast(l_suppkey % 30 AS string), '|r', cast(l_orderkey AS string), '_', cast(l_linenumber AS string), '|E') AS name, cast(l_quantity AS int) + 10 AS length FROM lineitem),
members AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY length DESC, name) - 1 AS ordinal FROM m)"""


def member_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member list of the lines' clusters, written and read back; the longest member stands for its cluster."""
    from pyspark.sql import Window

    name = F.concat(F.lit("S"), (F.col("l_suppkey") % 30).cast("string"), F.lit("|r"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"), F.lit("|E"))
    m = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 500).cast("int").alias("cluster"), name.alias("name"), (F.col("l_quantity").cast("int") + 10).alias("length"))
    m = m.withColumn("ordinal", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("length"), "name")) - 1)
    tail = F.when(F.col("ordinal") == 0, "*").otherwise("at 1:9:1:9/+/98.25%")
    line = F.concat(F.col("ordinal").cast("string"), F.lit("\t"), F.col("length").cast("string"), F.lit("nt, >"), "name", F.lit("... "), tail)
    lists = m.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("ordinal", line.alias("line")))).alias("x"))
    at = place(spark)
    lists.select(F.concat(F.lit(">Cluster "), F.col("cluster").cast("string"), F.lit("\n"), F.array_join(F.col("x.line"), "\n"))).write.text(at)
    return text.read_clstr(spark, at)


@query(f"WITH {LISTS} SELECT cluster, ordinal::INT AS ordinal, length, name, ordinal = 0 AS is_rep, CASE WHEN ordinal = 0 THEN 100.0 ELSE 98.25 END::DOUBLE AS identity FROM members")
def q47_member_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_file(spark, sf_dir)


@query(f"WITH {LISTS} SELECT cluster, count(*) AS n_seqs, count(DISTINCT split_part(name, '|', 1)) AS n_samples, max(CASE WHEN ordinal = 0 THEN name END) AS representative FROM members GROUP BY cluster HAVING count(*) >= 2")
def q41_pooled_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.pooled_clusters(member_file(spark, sf_dir))


@query("SELECT concat('c', cast(p_partkey AS string)) AS contig, (p_size * 10)::INT AS start, (p_size * 10 + 90)::INT AS \"end\", CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE '+' END AS strand, CASE WHEN p_partkey % 3 = 0 THEN 'unnamed_CDS' WHEN p_partkey % 3 = 1 THEN concat('g', cast(p_size AS string)) ELSE 'a product' END AS gene FROM part")
def q48_coding_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pad = "\n" + " " * 21
    p = table(spark, sf_dir, "part")
    first, last = (F.col("p_size") * 10 + 1).cast("string"), (F.col("p_size") * 10 + 90).cast("string")
    span = F.concat(F.lit("join("), first, F.lit(".."), (F.col("p_size") * 10 + 30).cast("string"), F.lit("," + pad), (F.col("p_size") * 10 + 50).cast("string"), F.lit(".."), last, F.lit(")"))
    where = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("complement("), first, F.lit(".."), last, F.lit(")"))).otherwise(span)
    qual = F.when(F.col("p_partkey") % 3 == 0, "/note=\"none\"").when(F.col("p_partkey") % 3 == 1, F.concat(F.lit('/gene="g'), F.col("p_size").cast("string"), F.lit('"'))).otherwise('/product="a product"')
    record = F.concat(F.lit("LOCUS       c"), F.col("p_partkey").cast("string"), F.lit("   5000 bp\nFEATURES\n     CDS             "), where, F.lit(pad), qual, F.lit("\n     CDS             1..5000" + pad + '/gene="whole"\nORIGIN\n//'))
    at = place(spark)
    p.select(record).write.text(at)
    return text.read_cds(spark, at).drop("ref_genome")


@query(f"WITH {PARTS} SELECT name, CASE WHEN p_partkey % 4 = 0 THEN concat('IS', cast(p_partkey AS string)) ELSE name END AS new_name, seq FROM parts WHERE p_size > 10")
def q49_renamed_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = parts(spark, sf_dir)
    kept = fasta(spark, sf_dir).join(events.at_least(known, "p_size", 10, inclusive=False).select("name"), "name", "left_semi")
    names = known.where("p_partkey % 4 = 0 and p_size > 10").select("name", F.concat(F.lit("IS"), F.col("p_partkey").cast("string")).alias("new_name"))
    return metadata.rename(kept, names).select("name", "new_name", "seq")


@query("""WITH d AS (SELECT CASE WHEN s_suppkey % 5 = 0 THEN concat('bad label ', cast(s_suppkey AS string)) ELSE concat('l', cast(s_nationkey AS string)) END AS label, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE concat('/', cast(s_suppkey AS string)) END AS path FROM supplier)
SELECT 'label' AS problem, label FROM d WHERE contains(label, ' ') UNION ALL SELECT 'empty path', label FROM d WHERE path IS NULL UNION ALL SELECT 'repeated label', label FROM d GROUP BY label HAVING count(*) > 1""")
def q50_table_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "supplier").selectExpr("s_name as other", "case when s_suppkey % 7 = 0 then null else concat('/', cast(s_suppkey as string)) end as path", "case when s_suppkey % 5 = 0 then concat('bad label ', cast(s_suppkey as string)) else concat('l', cast(s_nationkey as string)) end as label")
    at = place(spark)
    sinks.write_tsv(d, at)
    return text.check_databases(text.read_databases(spark, at))


@query("SELECT DISTINCT concat('SRR', cast(o_custkey AS string)) AS accession FROM orders")
def q51_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select(F.concat(F.lit("run=SRR"), F.col("o_custkey").cast("string"), F.lit("; none")).alias("value"))
    return text.accessions(lines).orderBy("accession")


SIZES = f"""{sql("placements")}, k AS (SELECT sample, is_element, side, cluster_id, count(*) AS n FROM placements GROUP BY ALL)"""


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "placements").withColumn("representative_sequence", F.lit("x"))
    return clustering.representatives(p).withColumnRenamed("n_reads", "n")


@query(f"WITH {SIZES} SELECT n, count(*) AS rows FROM k GROUP BY n")
def q52_size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.histogram(cluster_sizes(spark, sf_dir).withColumnRenamed("n", "size"), "size").select(F.col("size").alias("n"), F.col("n").alias("rows"))


@query(f"WITH {SIZES} SELECT is_element, sum(n)::BIGINT AS n_inputs, count(*) AS n_clusters, round_even(count_if(n = 1) / sum(n), 6) AS singleton_part, round_even(max(n) / sum(n), 6) AS largest_part FROM k GROUP BY is_element")
def q52_sweep_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.sweep_ratios(cluster_sizes(spark, sf_dir), ["is_element"], "n")


@query(f"{DISRUPTION} SELECT gene, count(*) AS n_clusters, count(DISTINCT sample) AS n_samples FROM disruption WHERE hit_type = 'protein_coding' GROUP BY gene")
def q53_gene_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.gene_support(disruption(spark, sf_dir))


@query(f"""WITH {sql("intervals")}, {sql("features")}, good AS (SELECT chrom, start, end_ FROM intervals WHERE 85 + start % 16 >= 90 AND end_ - start >= 100 AND chrom <> 'c7'),
o AS (SELECT *, max(end_) OVER (PARTITION BY chrom ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM good),
g AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY start, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM o),
m AS (SELECT chrom, min(start) AS start, max(end_) AS "end" FROM g GROUP BY chrom, n)
SELECT f.chrom, f.feature_id, (f.start - coalesce(sum(m."end" - m.start) FILTER (m."end" <= f.start), 0))::BIGINT AS new_start, (f.end_ - coalesce(sum(m."end" - m.start) FILTER (m."end" <= f.end_), 0))::BIGINT AS new_end
FROM features f LEFT JOIN m ON f.chrom = m.chrom GROUP BY f.chrom, f.feature_id, f.start, f.end_ HAVING NOT coalesce(bool_or((m.start < f.start AND f.start < m."end") OR (m.start < f.end_ AND f.end_ < m."end")), false)""")
def q54_masked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = view(spark, sf_dir, "intervals").withColumnRenamed("end_", "end")
    # One sequence has no good hit and passes through.
    hits = i.withColumns({"pident": (F.lit(85) + F.col("start") % 16).cast("double"), "length": F.when(F.col("chrom") == "c7", 0).otherwise(F.col("end") - F.col("start"))})
    return mask_features(view(spark, sf_dir, "features").withColumnRenamed("end_", "end"), hits, ["chrom"]).select("chrom", "feature_id", "new_start", "new_end")


@query(f"WITH {sql('placements')} SELECT sample, is_element, cluster_id, side, junction_pos, score FROM placements")
def q55_written_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = place(spark)
    sinks.write_table(view(spark, sf_dir, "placements"), at)
    back = spark.read.parquet(at)
    return back.select(F.col("sample").cast("string"), F.col("is_element").cast("string"), "cluster_id", "side", "junction_pos", "score")


@query(f"WITH {SIZES} SELECT is_element, count(*)::INT AS n, (sum(n) / 4)::DOUBLE AS quarter FROM k GROUP BY is_element")
def q55_written_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = place(spark)
    sinks.write_summary(cluster_sizes(spark, sf_dir).groupBy("is_element").agg(F.count("*").alias("n"), (F.sum("n") / 4).alias("quarter")), at, "n")
    return spark.read.csv(at, header=True, schema="is_element string, n int, quarter double")


@query("SELECT p_partkey, replace(lower(trim(p_name)), ' ', '_') AS slug, replace(concat(p_brand, '/', p_type), '/', '_') AS safe, printf('%.4f', p_size / 8) AS p4, CASE WHEN p_size % 4 = 0 THEN cast((p_size // 4)::BIGINT AS string) ELSE cast(p_size / 4 AS string) END AS gap, split_part(concat(p_brand, '|', p_type, '|', cast(p_size AS string), '|x'), '|', 3) AS third FROM part")
def q56_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    out = p.select("p_partkey", metadata.slug(F.col("p_name")).alias("slug"), sinks.safe_name(F.concat("p_brand", F.lit("/"), "p_type")).alias("safe"), (F.col("p_size") / 8).alias("p4"), metadata.gap_text(F.col("p_size") / 4).alias("gap"), F.split(F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string"), F.lit("x")), r"\|")[2].alias("third"))
    return sinks.fixed(out, ["p4"])

"""Readers of the text formats. Records that are malformed raise an error when they are read; they aren't turned into nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flankspark.schemas import DATABASES, HSP, IDXSTATS, SAMPLES, SRA

#: Headers of overhang records; mapq may be missing.
HEADER = r"^([^|]+)\|([^|]+)\|([^|]+)\|pos:([^|]*)\|side:(left|right)\|strand:([+-])\|pident:([0-9.]+)(?:\|mapq:(\d+))?$"
#: Members of cluster lists; coordinates before the strand are optional.
MEMBER = r"^(\d+)\s+(\d+)nt,\s+>(.+?)\.\.\.\s+(?:\*|at\s+(?:\d+:\d+:\d+:\d+/)?[+-]/([0-9.]+)%)$"
LABEL = "^[A-Za-z0-9_-]+$"


def must(condition: Column, value: Column, what: str, shown: Column) -> Column:
    """value where condition holds, else an error that shows what it was."""
    return F.when(condition, value).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(shown, F.lit("null")))).cast("string"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, header, seq) of FASTA records with sequences over any number of lines; files are split between records, gz is read as it is."""
    records = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>|\r", "").alias("r")).where("trim(r) <> ''")
    parts = F.split("r", "\n", 2)
    return records.select(F.regexp_extract(parts[0], r"^(\S*)", 1).alias("name"), F.trim(parts[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+", "").alias("seq"))


def check_fasta(records: DataFrame) -> DataFrame:
    """(problem, name) of empty sequences, repeated names, and ``>`` inside a sequence."""
    bad = F.array(F.when(F.col("seq") == "", F.lit("empty sequence")), F.when(F.col("seq").contains(">"), F.lit("header inside sequence")))
    own = records.select(F.explode(F.filter(bad, lambda x: x.isNotNull())).alias("problem"), "name")
    return own.unionByName(records.groupBy("name").count().where("count > 1").select(F.lit("repeated name").alias("problem"), "name"))


def reference_lengths(records: DataFrame, database: str) -> DataFrame:
    return records.select(F.col("name").alias("reference"), F.lit(database).alias("database"), F.length("seq").alias("length"))


def union_references(tables: list[DataFrame]) -> DataFrame:
    """All references; a name in two databases raises an error when it is read."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    held = out.groupBy("reference").agg(F.count("*").alias("n"), F.min("database").alias("database"), F.min("length").alias("length"))
    return held.select(must(F.col("n") == 1, F.col("reference"), "reference in more than one database", F.col("reference")).alias("reference"), "database", "length")


def parse_overhang_header(header: Column, legacy: bool = False) -> Column:
    """A struct of the fields of an overhang's header; another format is an error. Of legacy headers, so is one with a mapq."""
    ok = header.rlike(HEADER)
    if legacy:
        ok &= ~header.contains("|mapq:")
    field = lambda i: F.regexp_extract(must(ok, header, "not an overhang header", header), HEADER, i)
    return F.struct(
        field(1).alias("sample"), field(2).alias("read_id"), field(3).alias("is_element"), field(4).alias("pos"), field(5).alias("side"), field(6).alias("strand"),
        field(7).cast("double").alias("pident"), F.nullif(field(8), F.lit("")).cast("int").alias("mapq"),
    )


def overhang_header(row: DataFrame) -> Column:
    """The header that parse_overhang_header reads."""
    head = F.concat_ws("|", "sample", "read_id", "is_element", F.concat(F.lit("pos:"), F.col("pos").cast("string")), F.concat(F.lit("side:"), F.col("side")), F.concat(F.lit("strand:"), F.col("strand")), F.format_string("pident:%.2f", F.col("pident").cast("double")))
    return F.when(F.col("mapq").isNull(), head).otherwise(F.concat(head, F.lit("|mapq:"), F.col("mapq").cast("string")))


def _placed(text: DataFrame) -> DataFrame:
    """Pieces of text files with the file and split they lie in and a number i; pieces of a split have numbers without gaps, in their order."""
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"))


def filled(lines: DataFrame, header: Column, name: str) -> DataFrame:
    """Lines (of _placed) with the last header, at or above them, of their file; lines above the first have none.

    A window fills within a split, which has a bounded size; the last header of each split is carried into the splits behind it.
    """
    lines = lines.withColumn("__head", header)
    inside = Window.partitionBy("file", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    last = lines.groupBy("file", "block").agg(F.max_by("__head", F.when(F.col("__head").isNotNull(), F.col("i"))).alias("__last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select("file", "block", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    own = lines.withColumn("__own", F.last("__head", ignorenulls=True).over(inside)).join(carry, ["file", "block"])
    return own.withColumn(name, F.coalesce("__own", "__carry")).drop("__head", "__own", "__carry")


def read_clstr(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, ordinal, length, name, is_rep, identity) of a clusterer's member lists; the representative has identity 100.

    Files are read line by line, so a cluster may be of any size; a member above the first cluster is an error.
    """
    lines = filled(_placed(spark.read.text(path)).where("trim(value) <> ''"), F.nullif(F.regexp_extract("value", r"^>Cluster (\d+)", 1), F.lit("")), "number")
    members = lines.where("value not like '>Cluster%'")
    return parse_members(members.select(must(F.col("number").isNotNull(), F.col("number"), "member before any cluster", F.col("value")).cast("int").alias("cluster"), F.col("value").alias("line")))


def parse_members(lines: DataFrame) -> DataFrame:
    line = F.regexp_replace(F.trim("line"), "\r", "")
    safe = must(line.rlike(MEMBER), line, "not a cluster member", line)
    rep = line.endswith("*")
    return lines.select(
        "cluster", F.regexp_extract(safe, MEMBER, 1).cast("int").alias("ordinal"), F.regexp_extract(safe, MEMBER, 2).cast("int").alias("length"), F.regexp_extract(safe, MEMBER, 3).alias("name"),
        rep.alias("is_rep"), F.when(rep, 100.0).otherwise(F.expr("try_cast(nullif(regexp_extract(trim(line), '([0-9.]+)%$', 1), '') as double)")).alias("identity"),
    )


def read_fastq(spark: SparkSession, path: str | list[str], mate: int = 1) -> DataFrame:
    """(read_id, seq, qual, mate) of FASTQ records of four lines; files are split, gz is read as it is.

    Records are split at an @ after a line break. Where a quality begins with @, that cuts a record in two: the first part has three lines,
    the second, which follows it, is one. Only such parts are joined, on the number of the part that comes next, which is the number behind
    or, at the end of a split, the first one of the file's next split. Records in one piece aren't shuffled.
    """
    text = _placed(spark.read.text(path, lineSep="\n@"))
    # The first header of a file still has its @; a part that is one line may begin with one of its own.
    text = text.withColumn("r", F.regexp_replace(F.regexp_replace("value", r"\r", ""), r"\n+$", "")).withColumn("n", F.size(F.split("r", "\n")))
    text = text.withColumn("r", F.when(F.col("n") > 1, F.regexp_replace("r", "^@", "")).otherwise(F.col("r")))
    splits = text.groupBy("file", "block").agg(F.min("i").alias("first"), F.max("i").alias("i"))
    ends = splits.select("i", F.lead("first").over(Window.partitionBy("file").orderBy("block")).alias("behind"))
    heads = text.where((F.col("n") != 4) & F.col("r").rlike("\n[+][^\n]*$")).join(ends, "i", "left")
    heads = heads.select("r", F.when(F.col("behind").isNull(), F.col("i") + 1).otherwise(F.col("behind")).alias("next"))
    tails = text.where("n = 1").select(F.col("i").alias("next"), F.col("r").alias("tail"))
    # A head without a tail breaks off, and a tail without a head belongs to nothing: both are errors below, unless the tail is empty.
    parts = heads.join(tails, "next", "full").where("r is not null or tail <> ''").select(F.concat(F.coalesce("r", F.lit("")), F.coalesce(F.concat(F.lit("\n@"), "tail"), F.lit(""))).alias("r"))
    # So is a part that is neither.
    records = text.where((F.col("n") == 4) | (F.col("n") != 1) & ~F.col("r").rlike("\n[+][^\n]*$")).select("r").unionByName(parts)
    x = F.split("r", "\n")
    good = (F.size(x) == 4) & (F.length(F.get(x, F.lit(1))) == F.length(F.get(x, F.lit(3)))) & F.startswith(F.get(x, F.lit(2)), F.lit("+"))
    return records.select(F.regexp_extract(must(F.coalesce(good, F.lit(False)), x[0], "not a FASTQ record", F.col("r")), r"^(\S+)", 1).alias("read_id"), x[1].alias("seq"), x[3].alias("qual"), F.lit(mate).alias("mate"))


def read_reads(spark: SparkSession, sample: str, files: list[str]) -> DataFrame:
    """The reads of a sample's one or two FASTQ files; another number of files is an error."""
    if len(files) not in (1, 2):
        raise ValueError(f"{sample}: {len(files)} FASTQ files, not 1 or 2")
    out = read_fastq(spark, files[0])
    out = out if len(files) == 1 else out.unionByName(read_fastq(spark, files[1], 2))
    return out.withColumn("sample", F.lit(sample))


OPERATIONS = "MIDNSHP=X"


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments from SAM text: sample (of the tag RG), query_name, reference, ref_length (of the header), ref_start, ref_end, mapq, flag, nm, cigar, query_sequence."""
    lines = spark.read.text(path)
    head = lines.where("value like '@SQ%'").select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("reference"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("int").alias("ref_length")).distinct()
    f = F.split("value", "\t")
    tag = lambda name: F.nullif(F.regexp_extract("value", rf"\t{name}:[iZ]:([^\t]+)", 1), F.lit(""))
    sizes, ops = (F.regexp_extract_all(f[5], F.lit(rf"(\d+)([{OPERATIONS}])"), F.lit(i)) for i in (1, 2))
    code = F.create_map(*[F.lit(x) for i, o in enumerate(OPERATIONS) for x in (o, i)])
    cigar = F.zip_with(ops, sizes, lambda o, n: F.struct(code[o].alias("op"), n.cast("int").alias("len")))
    a = lines.where("value not like '@%'").select(
        tag("RG").alias("sample"), f[0].alias("query_name"), F.nullif(f[2], F.lit("*")).alias("reference"), (f[3].cast("int") - 1).alias("ref_start"), f[4].cast("int").alias("mapq"), f[1].cast("int").alias("flag"),
        tag("NM").cast("int").alias("nm"), F.when(f[5] != "*", cigar).alias("cigar"), F.nullif(f[9], F.lit("*")).alias("query_sequence"),
    )
    covered = F.aggregate("cigar", F.lit(0), lambda s, x: s + F.when(x["op"].isin(0, 2, 3, 7, 8), x["len"]).otherwise(0))
    return a.withColumn("ref_end", F.col("ref_start") + covered).join(head, "reference", "left")


def reference_counts(alignments: DataFrame, references: DataFrame) -> DataFrame:
    """(reference, length, mapped) of every reference, also those without a mapped read."""
    mapped = alignments.where(F.col("reference").isNotNull() & (F.col("flag").bitwiseAND(4) == 0)).groupBy("reference").agg(F.count("*").alias("mapped"))
    return mapped.join(references.select("reference", "length"), "reference", "right").withColumn("mapped", F.coalesce("mapped", F.lit(0)).cast("long"))


def read_tsv(spark: SparkSession, path: str | list[str], schema: str, header: bool = True) -> DataFrame:
    """A tab-separated file with a given schema and no quotes; lines that start with # are skipped.

    With a header, columns are taken by name, whatever others there are; one that is missing is an error.
    """
    if not header:
        return spark.read.csv(path, schema=schema, sep="\t", header=False, quote="", comment="#")
    raw = spark.read.csv(path, sep="\t", header=True, quote="", comment="#")
    wanted = [x.strip().split(" ") for x in schema.split(",")]
    if missing := [c for c, _ in wanted if c not in raw.columns]:
        raise ValueError(f"columns missing in {path}: {missing}")
    return raw.select(*[F.col(f"`{c}`").cast(kind) for c, kind in wanted])


def read_hsps(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, HSP, header=False)


def read_idxstats(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, IDXSTATS, header=False).where("reference <> '*'").orderBy("reference")


def read_sra(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SRA)


def read_databases(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, DATABASES)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SAMPLES)


def check_databases(databases: DataFrame) -> DataFrame:
    """(problem, label) of labels that aren't plain, labels that repeat, and empty paths."""
    own = F.array(F.when(~F.coalesce("label", F.lit("")).rlike(LABEL), F.lit("label")), F.when(F.coalesce(F.trim("path"), F.lit("")) == "", F.lit("empty path")))
    a = databases.select(F.explode(F.filter(own, lambda x: x.isNotNull())).alias("problem"), "label")
    return a.unionByName(databases.groupBy("label").count().where("count > 1").select(F.lit("repeated label").alias("problem"), "label"))


def read_tagged(spark: SparkSession, paths: str | list[str], schema: str, pattern: str, tag: str) -> DataFrame:
    """Files of one kind with a column taken from each one's name."""
    return read_tsv(spark, paths, schema).withColumn(tag, F.regexp_extract(F.input_file_name(), pattern, 1))


def read_listed(spark: SparkSession, lists: str, schema: str) -> DataFrame:
    """The tables whose paths, which may hold wildcards, are the lines of a file; empty tables have no rows, blank lines and those with # are passed over.

    The paths come to the driver, which plans the scan of their files anyway.
    """
    paths = [r[0] for r in spark.read.text(lists).select(F.trim("value")).where("trim(value) <> '' and value not like '#%'").distinct().collect()]
    if not paths:
        raise ValueError(f"{lists} lists no tables")
    return read_tsv(spark, sorted(paths), schema)


def to_float(value: Column) -> Column:
    """The number that a text is, null for an empty one; anything else is an error."""
    return F.nullif(F.trim(value), F.lit("")).cast("double")


def accessions(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(r"([ESD]RR\d+)"), F.lit(1))).alias("accession")).distinct()


def read_cds(spark: SparkSession, path: str) -> DataFrame:
    """(ref_genome, contig, start, end, strand, gene) of the coding sequences of GenBank flat files, one file a genome.

    A record is a LOCUS; joined locations span from their least to their largest position. A coding sequence that covers its whole contig
    is a circular artefact and left out. The name is that of the gene, else the product, else the locus tag, else unnamed_CDS.
    """
    records = spark.read.text(path, lineSep="\n//\n").select("value", F.regexp_extract(F.input_file_name(), r"([^/]+?)\.[^/.]*$", 1).alias("ref_genome"))
    contig = F.regexp_extract("value", r"LOCUS\s+(\S+)\s+(\d+)", 1)
    size = F.regexp_extract("value", r"LOCUS\s+(\S+)\s+(\d+)", 2)
    feats = records.where("value like '%LOCUS%'").select("ref_genome", contig.alias("contig"), F.nullif(size, F.lit("")).cast("int").alias("size"), F.explode(F.regexp_extract_all("value", F.lit(r"(?m)^     CDS +([^\n]*(?:\n {21}[^\n]*)*)"), F.lit(1))).alias("f"))
    loc = F.regexp_extract(F.regexp_replace("f", r"\n {21}", " "), r"^(.*?)(?: /|$)", 1)
    numbers = F.transform(F.regexp_extract_all(loc, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int"))
    qual = lambda k: F.nullif(F.regexp_extract(F.regexp_replace("f", r"\n {21}", " "), f'/{k}="([^"]*)"', 1), F.lit(""))
    out = feats.select("ref_genome", "contig", "size", (F.array_min(numbers) - 1).alias("start"), F.array_max(numbers).alias("end"), F.when(loc.contains("complement"), "-").otherwise("+").alias("strand"), F.coalesce(qual("gene"), qual("product"), qual("locus_tag"), F.lit("unnamed_CDS")).alias("gene"))
    return out.where((F.col("start") > 0) | (F.col("end") < F.col("size")) | F.col("size").isNull()).drop("size")


def split_glued(lines: DataFrame, names: DataFrame) -> DataFrame:
    """(name, seq, problem) of records whose header may run into the sequence: body starts with the longest known name; the rest is sequence, upper-cased.

    problem is repeated for each record whose name comes more than once, be the records equal or not, and empty for one without a
    sequence, which a writer leaves out. A body that starts with no known name is an error when it is read.
    """
    from flankspark.operators.metadata import longest_prefix

    found = longest_prefix(lines.select("body"), names)
    name = must(F.col("name").isNotNull(), F.col("name"), "can't split header from sequence", F.substring("body", 1, 60))
    out = found.select(name.alias("name"), F.upper(F.expr("substring(body, length(name) + 1)")).alias("seq"))
    times = out.groupBy("name").agg(F.count("*").alias("n"))
    return out.join(times, "name").select("name", "seq", F.when(F.col("n") > 1, "repeated").when(F.col("seq") == "", "empty").alias("problem"))


def read_glued(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """split_glued of a FASTA file in which headers follow a sequence on its line: a record begins at every >.

    A header at the start of a line ends with its line, and its name with the first space; one inside of a line is glued to what follows.
    """
    pieces = _placed(spark.read.text(path, lineSep=">")).where("trim(value) <> ''")
    # What came before says whether this > stood at the start of a line: nothing, or a line break.
    order = Window.partitionBy("file", "block").orderBy("i")
    last = pieces.groupBy("file", "block").agg(F.max_by("value", "i").alias("last"))
    carry = last.select("file", "block", F.lag("last").over(Window.partitionBy("file").orderBy("block")).alias("carry"))
    own = pieces.withColumn("before", F.lag("value").over(order)).join(carry, ["file", "block"]).withColumn("before", F.coalesce("before", "carry"))
    starts = F.col("before").isNull() | F.col("before").rlike(r"[\r\n]$")
    flat = F.regexp_replace("value", r"\s+", "")
    line = F.split("value", r"\r?\n", 2)
    plain = own.where(starts).select(F.regexp_extract(line[0], r"^(\S*)", 1).alias("name"), F.upper(F.regexp_replace(F.coalesce(F.get(line, F.lit(1)), F.lit("")), r"\s+", "")).alias("seq"))
    glued = split_glued(own.where(~starts).select(flat.alias("body")), names).drop("problem")
    out = plain.unionByName(glued)
    times = out.groupBy("name").agg(F.count("*").alias("n"))
    return out.join(times, "name").select("name", "seq", F.when(F.col("n") > 1, "repeated").when(F.col("seq") == "", "empty").alias("problem"))

import pytest
from pyspark.sql import functions as F

from flankspark.sources import archives, sinks, text
from flankspark.sources.config import Config, ConfigError, archive_samples, input_mode, load


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nACGT\nAC\n>two\nGG\n>two\n\n")
    df = text.read_fasta(spark, str(tmp_path / "a.fa"))
    assert sorted(tuple(r) for r in df.select("name", "seq").collect()) == [("one", "ACGTAC"), ("two", ""), ("two", "GG")]
    assert sorted(tuple(r) for r in text.check_fasta(df).collect()) == [("empty sequence", "two"), ("repeated name", "two")]
    sinks.write_fasta(df.where("seq <> ''"), str(tmp_path / "out"), "name", "seq")
    assert text.read_fasta(spark, str(tmp_path / "out")).count() == 2


def test_headers(spark):
    good = ["S|r1|E|pos:5|side:left|strand:+|pident:98.50|mapq:12", "S|r1|E|pos:5|side:left|strand:+|pident:98.50"]
    df = spark.createDataFrame([(h,) for h in good], "h string")
    got = [tuple(r[0]) for r in df.select(text.parse_overhang_header(F.col("h"))).collect()]
    assert got == [("S", "r1", "E", "5", "left", "+", 98.5, 12), ("S", "r1", "E", "5", "left", "+", 98.5, None)]
    old = spark.createDataFrame([(good[1],)], "h string")
    assert old.select(text.parse_overhang_header(F.col("h"), legacy=True)).first()[0].mapq is None
    with pytest.raises(Exception, match="not an overhang header"):
        spark.createDataFrame([(good[0],)], "h string").select(text.parse_overhang_header(F.col("h"), legacy=True)).collect()
    with pytest.raises(Exception, match="not an overhang header"):
        spark.createDataFrame([(good[0].replace("strand:+", "strand:x"),)], "h string").select(text.parse_overhang_header(F.col("h"))).collect()


def test_clstr(spark, tmp_path):
    (tmp_path / "a.clstr").write_text(">Cluster 0\n0\t900nt, >IS1... *\n1\t880nt, >IS2... at +/97.50%\n>Cluster 1\n0\t700nt, >IS3... *\n")
    got = sorted(tuple(r) for r in text.read_clstr(spark, str(tmp_path / "a.clstr")).collect())
    assert got == [(0, 0, 900, "IS1", True, 100.0), (0, 1, 880, "IS2", False, 97.5), (1, 0, 700, "IS3", True, 100.0)]
    bad = spark.createDataFrame([(0, "nonsense")], "cluster int, line string")
    with pytest.raises(Exception, match="not a cluster member"):
        text.parse_members(bad).collect()


def test_fastq_and_tables(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n")
    assert [tuple(r) for r in text.read_fastq(spark, str(tmp_path / "a.fq")).collect()] == [("r1", "ACGT", "IIII", 1), ("r2", "GG", "II", 1)]
    (tmp_path / "d.tsv").write_text("label\tpath\n# note\nok\t/a\nbad label\t/b\nok\t/c\nempty\t\n")
    got = sorted(tuple(r) for r in text.check_databases(text.read_databases(spark, str(tmp_path / "d.tsv"))).collect())
    assert got == [("empty path", "empty"), ("label", "bad label"), ("repeated label", "ok")]
    (tmp_path / "i.tsv").write_text("E1\t100\t5\t0\n*\t0\t0\t9\n")
    assert [r.reference for r in text.read_idxstats(spark, str(tmp_path / "i.tsv")).collect()] == ["E1"]


def test_fastq_is_split(spark, tmp_path):
    import random

    r = random.Random(3)
    want = []
    for i in range(3000):
        n = r.choice([1, 1, 2, 40, 90])
        want.append((f"r{i}", "".join(r.choice("ACGT") for _ in range(n)), "".join(r.choice("@+I") for _ in range(n)), 1))
    (tmp_path / "a.fq").write_text("".join(f"@{i} x\n{s}\n+\n{q}\n" for i, s, q, _ in want))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = text.read_fastq(spark, str(tmp_path / "a.fq"))
        assert df.rdd.getNumPartitions() > 5 and sorted(tuple(x) for x in df.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "bad.fq").write_text("@r1\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="not a FASTQ record"):
        text.read_fastq(spark, str(tmp_path / "bad.fq")).collect()
    with pytest.raises(ValueError, match="3 FASTQ files"):
        text.read_reads(spark, "s", ["a", "b", "c"])


def test_tables_are_read_by_name(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("BioSample\tx\tAccession\tSubmission\tBases\tSample\tType\nb1\t0\ta1\ts1\t9\tn\tt\n")
    row = text.read_sra(spark, str(tmp_path / "s.tsv")).first()
    assert (row.Accession, row.BioSample, row.Bases) == ("a1", "b1", "9")
    (tmp_path / "t.tsv").write_text("label\tother\nl\tx\n")
    with pytest.raises(ValueError, match="path"):
        text.read_databases(spark, str(tmp_path / "t.tsv"))


def test_member_lists_with_and_without_coordinates(spark):
    lines = spark.createDataFrame([(0, "0\t900nt, >A... *"), (0, "1\t880nt, >B... at 1:100:1:100/+/97%"), (0, "2\t880nt, >C... at -/97.50%")], "cluster int, line string")
    assert [(r.name, r.identity) for r in text.parse_members(lines).collect()] == [("A", 100.0), ("B", 97.0), ("C", 97.5)]


def test_rename_without_leftovers(spark):
    from flankspark.operators.metadata import rename

    rows = spark.createDataFrame([("a",), ("b",)], "name string")
    names = lambda *x: spark.createDataFrame(list(x), "name string, new_name string")
    assert sorted(r.new_name for r in rename(rows, names(("a", "z"))).collect()) == ["b", "z"]
    with pytest.raises(Exception, match="no row to rename: c"):
        rename(rows, names(("a", "z"), ("c", "y"))).collect()


def test_references_of_two_databases(spark):
    one = spark.createDataFrame([("a", "x", 1)], "reference string, database string, length int")
    assert text.union_references([one]).count() == 1
    with pytest.raises(Exception, match="more than one database"):
        text.union_references([one, one]).collect()


def test_genbank(spark, tmp_path):
    pad = " " * 21
    record = f"LOCUS       c1   1000 bp\nFEATURES\n     CDS             complement(11..40)\n{pad}/gene=\"abc\"\n     CDS             join(50..60,\n{pad}70..80)\n{pad}/locus_tag=\"t1\"\n     CDS             1..1000\n{pad}/gene=\"whole\"\nORIGIN\n//\n"
    (tmp_path / "G1.gbff").write_text(record)
    got = sorted(tuple(r) for r in text.read_cds(spark, str(tmp_path / "G1.gbff")).collect())
    assert got == [("G1", "c1", 10, 40, "-", "abc"), ("G1", "c1", 49, 80, "+", "t1")]


def test_glued(spark):
    lines = spark.createDataFrame([("IS10acgt",), ("IS1ggg",), ("IS2",)], "body string")
    names = spark.createDataFrame([("IS1",), ("IS10",), ("IS2",)], "name string")
    got = sorted(tuple(r) for r in text.split_glued(lines, names).collect())
    assert got == [("IS1", "GGG", None), ("IS10", "ACGT", None), ("IS2", "", "empty")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "a/b", 1.0)], "sample string, is_element string, x double")
    sinks.write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    sinks.write_tsv(df.where("false"), str(tmp_path / "e"), True)
    assert [f.suffixes[-1] for f in (tmp_path / "e").glob("part-*")] == [".gz"]
    empty = text.read_tsv(spark, str(tmp_path / "e"), "sample string, is_element string, x double")
    assert empty.count() == 0 and empty.columns == df.columns
    sinks.write_summary(df, str(tmp_path / "s"), "x")
    assert sinks.fixed(df, ["x"]).first().x == "1.0000"
    assert df.select(sinks.safe_name(F.col("is_element"))).first()[0] == "a_b"


def test_a_table_of_many_keys_is_few_files_and_keeps_its_keys(spark, tmp_path):
    keys = [(f"{i:03d}", "" if i == 7 else None if i == 8 else str(i % 5), float(i)) for i in range(400)]
    df = spark.createDataFrame(keys, "sample string, is_element string, x double").repartition(8)
    sinks.write_table(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(repr, map(tuple, back.select("sample", "is_element", "x").collect()))) == sorted(map(repr, keys))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 8
    # A file holds a range of keys.
    spans = sorted((r[1], r[2]) for r in back.groupBy(F.input_file_name()).agg(F.min("sample"), F.max("sample")).collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_config():
    c = Config({"inputs": {"samples": "s.tsv"}, "a": {"n": "x"}}, "/base")
    assert input_mode(c) == "samples" and c.file("inputs.samples") == "/base/s.tsv"
    c.number("a.n", 1)
    c.number("a.m", 5, high=2)
    c.file("b")
    with pytest.raises(ConfigError) as e:
        c.check()
    assert len(str(e.value).splitlines()) == 3


def test_lists_and_reads_over_splits(spark, tmp_path):
    """Files cut into many splits: a cluster larger than a split, records that a split cuts at a quality that begins with @, and two files."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    clusters = [(c, i) for c, n in ((0, 1), (1, 400), (2, 3), (7, 60)) for i in range(n)]
    lines = []
    for c, i in clusters:
        lines += [f">Cluster {c}"] * (i == 0) + [f"{i}\t90nt, >s{i}... " + ("*" if i == 0 else "at +/97.50%")]
    (tmp_path / "c").mkdir()
    for part in "ab":
        (tmp_path / "c" / f"{part}.clstr").write_text("\n".join(lines) + "\n")
    (tmp_path / "q").mkdir()
    reads = [(f"r{i}", "ACGT" * (i % 7 + 1), "@+I@"[: 1 + i % 3] + "I" * (4 * (i % 7 + 1) - 1 - i % 3)) for i in range(500)]
    for part in "ab":
        (tmp_path / "q" / f"{part}.fq").write_text("".join(f"@{part}{n} x\n{s}\n+\n{q}\n" for n, s, q in reads))
    try:
        for size in ("300", "1000", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = text.read_clstr(spark, str(tmp_path / "c"))
            assert sorted((r.cluster, r.ordinal) for r in got.collect()) == sorted(clusters * 2)
            got = text.read_fastq(spark, str(tmp_path / "q")).collect()
            assert sorted((r.read_id, r.seq, r.qual) for r in got) == sorted((p + n, s, q) for n, s, q in reads for p in "ab")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for bad in ("@a\nACGT\n+\n", "@a\nACGT\n+\nIII\n", "@a\nACGT\n+\nIIII\n@b\n", "@a\nAC\nGT\n+\nIIII\n"):
        (tmp_path / "bad.fq").write_text(bad)
        with pytest.raises(Exception, match="not a FASTQ record"):
            text.read_fastq(spark, str(tmp_path / "bad.fq")).collect()


def test_glued_files(spark, tmp_path):
    names = spark.createDataFrame([("IS1",), ("IS10",), ("IS2",)], "name string")
    (tmp_path / "a.fa").write_text(">one first\nAC\ngt>IS10ac\nTT\n>two\nGG>IS1>IS2cc>IS2cc\n")
    got = sorted(tuple(r) for r in text.read_glued(spark, str(tmp_path / "a.fa"), names).collect())
    assert got == sorted([("one", "ACGT", None), ("IS10", "ACTT", None), ("two", "GG", None), ("IS1", "", "empty"), ("IS2", "CC", "repeated"), ("IS2", "CC", "repeated")])
    (tmp_path / "a.fa").write_text(">one\nAC>unknownGT\n")
    with pytest.raises(Exception, match="can't split header"):
        text.read_glued(spark, str(tmp_path / "a.fa"), names).collect()
    same = spark.createDataFrame([("IS2a",), ("IS2a",)], "body string")
    assert [r.problem for r in text.split_glued(same, names).collect()] == ["repeated"] * 2


def test_table_archives(spark, tmp_path):
    at = str(tmp_path / "z")
    rows = spark.createDataFrame([("S1", "E/1", 5, None), ("S1", "E2", 6, "no_hit"), ("S2", "E2", 7, "x")], "sample string, is_element string, n int, hit_type string")
    archives.write_archives(rows, at, samples=spark.createDataFrame([("S1",), ("S2",), ("none",)], "sample string"))
    assert sorted(p.name for p in (tmp_path / "z").iterdir()) == ["S1.zip", "S2.zip", "none.zip"]
    back = archives.read_tables(spark, at, "n int, hit_type string")
    assert sorted(map(tuple, back.collect())) == [("S1", "E/1", 5, None, None), ("S1", "E2", 6, "no_hit", None), ("S2", "E2", 7, "x", None)]
    (tmp_path / "z" / "bad.zip").write_bytes(b"no zip")
    again = archives.read_tables(spark, at, "n int", ["E/1"])
    assert sorted((r.sample, r.n, r.problem is None) for r in archives.read_tables(spark, at, "n int").collect())[2:] == [("S2", 7, True), ("bad", None, False)]
    assert [tuple(r)[:3] for r in again.collect()] == [("S1", "E/1", 5)]


def test_flank_archives_are_opened_by_their_manifests(spark, tmp_path):
    at = tmp_path / "t"
    flanks = [(s, e, b, f"{s}|r{i}|{e}", "ACGT"[: i + 1], "IS") for s, e in (("S1", "E1"), ("S1", "E/2"), ("S2", "E3")) for b in ("left", "ambiguous") for i in range(2)]
    archives.write_archives(spark.createDataFrame(flanks, "sample string, is_element string, bucket string, header string, seq string, database string"), str(at), "flanks")
    assert sorted(map(tuple, archives.read_flanks(spark, str(at)).collect())) == sorted((*f[:5], None) for f in flanks)
    assert {r.is_element for r in archives.read_flanks(spark, str(at), ["E/2"]).collect()} == {"E/2"}
    # Three archives that aren't any, two with a manifest beside them: that which has a wanted element is opened, and found bad.
    for name, entries in (("B1", "E1\tleft\t3"), ("B2", "E3\tleft\t4\nE1\tleft\t0"), ("B3", None)):
        (at / f"{name}.tar.gz").write_bytes(b"no archive")
        if entries:
            (at / name).mkdir()
            (at / name / f"{name}.manifest.tsv").write_text("is_element\tside\tn_seqs\n" + entries + "\n")
    plan = archives.read_flanks(spark, str(at), ["E1", "E9"])
    found = plan.where("is_element = 'E1'").collect() + archives.read_flanks(spark, str(at)).where("problem is not null").collect()
    assert len([r for r in found if r.is_element == "E1"]) == 4
    raw = archives._Reader({"kind": "flanks", "path": str(at)}, archives.Archives({}).schema() and spark.createDataFrame([], archives.FLANKS).schema)
    assert list(raw.pushFilters([archives.In(("is_element",), ("E1", "E9"))])) == []
    opened = [r[0] for p in raw.partitions() for r in raw.read(p) if r[-1]]
    assert opened == ["B1", "B3"]


def test_settings_from_a_file(tmp_path):
    (tmp_path / "c.yaml").write_text("inputs:\n  existing_overhangs: old\nlimits:\n  max_edit: 0.1\n  bad: x\n")
    c = load(str(tmp_path / "c.yaml"))
    assert input_mode(c) == "existing_overhangs" and c.number("limits.max_edit", 1) == 0.1 and c.file("inputs.existing_overhangs") == str(tmp_path / "old")
    assert archive_samples(c, ["S2.tar.gz", "S1.tar.gz", "S1.v2.tar.gz", "notes.txt"]) == ["S1", "S2"]
    c.check()
    archive_samples(c, ["a.b.tar.gz"])
    c.number("limits.bad", 1)
    with pytest.raises(ConfigError, match="no archives(?s:.*)not a number"):
        c.check()
    (tmp_path / "d.yaml").write_text("- 1\n")
    assert load(str(tmp_path / "d.yaml")).problems

"""Cases derived by hand, and random ones against small programs written from the definitions."""

import random

import pytest
from pyspark.sql import functions as F

from flankspark.functions import intervals, sequences
from flankspark.functions.graph import connected_components
from flankspark.operators import clustering, depth, events, metadata, nested, placement


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def prefix_distance(q, t, k):
    row = list(range(len(t) + 1))
    row = [0 + j for j in range(len(t) + 1)]
    for i, c in enumerate(q, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    best = min(row)
    return best if best <= k else None


def test_edit_budget(spark):
    cases = [(5, 0.10, 1), (15, 0.10, 2), (25, 0.10, 2), (35, 0.10, 4), (10, 0.15, 2), (30, 0.15, 4)]
    for n, f, want in cases:
        assert spark.range(1).select(sequences.edit_budget(F.lit(n), f)).first()[0] == want


def test_anchored_distance(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    pairs = [("ACGTACGTAC", "ACGTACGTACGT", 1), ("ACGTACCT", "ACGTACGTACGT", 1), ("TTTTTT", "ACGTACGTACGT", 1), ("", "ACG", 1)]
    for _ in range(60):
        t = word(r.randint(1, 14))
        q = list(t[: r.randint(1, 14)])
        for _ in range(r.randint(0, 3)):
            q[r.randrange(len(q))] = r.choice("ACGT")
        pairs.append(("".join(q), t, r.randint(1, 3)))
    df = spark.createDataFrame(pairs, "q string, t string, k int")
    got = df.select("q", "t", "k", sequences.anchored_distance(F.col("q"), F.col("t"), F.col("k")).alias("d")).collect()
    for x in got:
        assert x.d == prefix_distance(x.q, x.t, x.k), x


def leaders(items, fraction):
    """items: (id, seq); the longest left seeds a cluster of all in their own budget of it."""
    left, out = sorted(items, key=lambda x: (-len(x[1]), x[0], x[1])), []
    while left:
        seed = left[0][1]
        mine = [x for x in left if prefix_distance(x[1], seed, max(1, round(len(x[1]) * fraction))) is not None]
        out.append(sorted(i for i, _ in mine))
        left = [x for x in left if x not in mine]
    return sorted(out)


def test_leader_clusters(spark):
    golden = [("r1", "ACGTACGTACGT"), ("r2", "ACGTACGTAC"), ("r3", "TTTTTTTTTT"), ("r4", "ACGTACCT"), ("r5", "TTTTTT")]
    r = random.Random(5)
    base = ["".join(r.choice("ACGT") for _ in range(24)) for _ in range(6)]
    many = []
    for i in range(80):
        s = list(r.choice(base)[: r.randint(12, 24)])
        s[r.randrange(len(s))] = r.choice("ACGT")
        many.append((f"x{i:03d}", "".join(s)))
    for items in (golden, many):
        df = spark.createDataFrame([("g", *x) for x in items], "g string, read_id string, cmp string")
        found: dict = {}
        for x in clustering.leader_clusters(df, ["g"], 0.10).collect():
            found.setdefault(x.seed, []).append(x.read_id)
        assert sorted(sorted(v) for v in found.values()) == leaders(items, 0.10)
    assert leaders(golden, 0.10) == [["r1", "r2", "r4"], ["r3", "r5"]]


def test_large_groups_are_clustered_in_rounds(spark, monkeypatch):
    r = random.Random(15)
    base = ["".join(r.choice("ACGT") for _ in range(24)) for _ in range(6)]
    df = spark.createDataFrame([(g, f"x{i:03d}", "".join(c if r.random() > 0.06 else r.choice("ACGT") for c in r.choice(base)[: r.randint(12, 24)])) for g, n in (("g", 90), ("h", 20), (None, 3)) for i in range(n)], "g string, read_id string, cmp string")
    want = rows(clustering.leader_clusters(df, ["g"], 0.10).where("g is not null"), "g", "read_id", "seed")
    monkeypatch.setattr(clustering, "FOLDED", 7)
    monkeypatch.setattr(clustering, "HEAD", 4)
    monkeypatch.setattr(clustering, "BLOCK", 2)
    assert rows(clustering.leader_clusters(df, ["g"], 0.10).where("g is not null"), "g", "read_id", "seed") == want
    assert len(want) == 110 and max(x[2] for x in want) > 7
    assert clustering.leader_clusters(df.where("false"), ["g"], 0.10).count() == 0


def test_recruiting_in_blocks(spark, monkeypatch):
    r = random.Random(16)
    word = lambda n: "".join(r.choice("AC") for _ in range(n))
    reps = spark.createDataFrame([("s", "e", r.choice(["left", "right"]), i, word(10)) for i in range(40)], "sample string, is_element string, side string, cluster_id int, representative_sequence string")
    amb = spark.createDataFrame([("s", f"r{i}", "e", r.choice(["left", "right"]), word(r.randint(6, 12))) for i in range(120)], "sample string, read_id string, is_element string, side string, seq string")
    want = rows(clustering.recruit(amb, reps).na.fill("-").na.fill(-1), *clustering.recruit(amb, reps).columns)
    assert rows(clustering.recruit(amb, reps).na.fill("-").na.fill(-1), *clustering.recruit(amb, reps).columns) == want
    assert {x[-2] for x in want} == {"-", "tie", "no_match"} and len(want) == 120


def test_merge_and_size(spark):
    seqs = ["ACGTACGTACGTACGTACGT"] * 2 + ["ACGTACGTACGTACTTACTT", "GGGGGGGGGGGG"]
    df = spark.createDataFrame([("s", "e", "right", f"r{i}", x) for i, x in enumerate(seqs)], "sample string, is_element string, side string, read_id string, seq string")
    got = clustering.cluster_reads(df, max_edit=0.05, merge_edit=0.10)
    assert rows(got, "read_id", "cluster_id", "representative_sequence") == [(f"r{i}", 0, seqs[0]) for i in range(3)]
    assert rows(clustering.cluster_reads(df, max_edit=0.05, merge_edit=0.10, min_size=1), "read_id", "cluster_id")[-1] == ("r3", 1)


def test_recruit_ties_and_misses(spark):
    reps = spark.createDataFrame([("s", "e", "right", 0, "ACGTACGTAC"), ("s", "e", "right", 1, "ACGTACGTAG"), ("s", "e", "left", 2, "GGGGCCCCAA")], "sample string, is_element string, side string, cluster_id int, representative_sequence string")
    amb = [("a", "right", "ACGTACGTAT"), ("b", "right", "TTTTTTTTTT"), ("c", "up", "ACGT"), ("d", "right", "ACGTACGTAC"), ("f", "right", "TTGGGGCCCC")]
    df = spark.createDataFrame([("s", i, "e", side, seq) for i, side, seq in amb], "sample string, read_id string, is_element string, side string, seq string")
    got = {r.read_id: (r.reason, r.side, r.cluster_id) for r in clustering.recruit(df, reps).collect()}
    assert got == {"a": ("tie", None, None), "b": ("no_match", None, None), "c": ("bad_side", None, None), "d": (None, "right", 0), "f": (None, "left", 2)}


def test_junction(spark):
    def at(side, sstart, send, qstart, qend, qlen):
        a, b = placement.junction(*[F.lit(x) for x in (side, sstart, send, qstart, qend, qlen)])
        return tuple(spark.range(1).select(a, b).first())

    assert at("left", 100, 149, 1, 50, 50) == (148, True)
    assert at("left", 100, 149, 1, 49, 50) == (148, False)
    assert at("right", 100, 149, 1, 50, 50) == (99, True)
    assert at("right", 149, 100, 1, 50, 50) == (148, True)


def test_genes(spark):
    cds = spark.createDataFrame([("g", "c", 10, 40, "+", "A"), ("g", "c", 20, 50, "-", "B"), ("g", "c", 10, 30, "+", "C")], "ref_genome string, contig string, start int, end int, strand string, gene string")
    points = spark.createDataFrame([(1, "g", "c", 25), (2, "g", "c", 40), (3, "g", "c", 50)], "id int, ref_genome string, contig string, p int")
    got = rows(placement.rank_genes(points, cds, ["ref_genome", "contig"], ["id"], "p"), "id", "gene_rank", "gene", "gene_offset", "gene_length")
    assert got == [(1, 1, "C", 15, 20), (1, 2, "A", 15, 30), (1, 3, "B", 24, 30), (2, 1, "B", 9, 30)]
    closed = rows(placement.first_gene_closed(points, cds, ["ref_genome", "contig"], ["id"], "p"), "id", "gene")
    assert closed == [(1, "C"), (2, "A"), (3, "B")]


def test_pairing(spark):
    p = [("X", "left", 1, 100), ("Y", "left", 1, 105), ("X", "right", 1, 140), ("Y", "right", 2, 104), ("Z", "left", 9, 1000), ("Z", "right", 9, 1050)]
    df = spark.createDataFrame([("s", e, side, i, "g", "c", "+", at) for e, side, i, at in p], "sample string, is_element string, side string, cluster_id int, ref_genome string, contig string, strand string, junction_pos int")
    got = rows(placement.add_pairing(df).where("side = 'left'"), "is_element", "pairing", "pairing_type", "pairing_gap")
    assert got == [("X", "X:right:1", "same_is", 40), ("Y", "Y:right:2", "same_is", -1), ("Z", "none", "none", None)]


@pytest.mark.parametrize("folded", [512, 0, 59])
def test_greedy_matching(spark, monkeypatch, folded):
    monkeypatch.setattr(placement, "FOLDED", folded)
    r = random.Random(11)
    pairs = [(g, r.randint(0, 30), i, f"l{r.randint(0, 8)}", f"r{r.randint(0, 8)}") for g in range(3) for i in range(60 - g)]
    df = spark.createDataFrame(pairs, "g int, w int, i int, l string, r string")
    got = rows(placement.greedy_matches(df, ["g"], [F.col("w"), F.col("i")], "l", "r"), "g", "l", "r")
    want, used = [], set()
    for g, _, _, a, b in sorted(pairs):
        if (g, a) not in used and (g, b) not in used:
            used |= {(g, a), (g, b)}
            want.append((g, a, b))
    assert got == sorted(want)


def test_bands(spark):
    a = spark.createDataFrame([(1, 100)], "k int, x int")
    b = spark.createDataFrame([(1, 120), (1, 121), (1, 80), (2, 100)], "k int, y int")
    assert rows(intervals.band_join(a, b, ["k"], "x", "y", 20, True), "y") == [(80,), (120,)]
    assert rows(intervals.band_join(a, b, ["k"], "x", "y", 20, False), "y") == []


def test_union_and_remap(spark):
    i = spark.createDataFrame([("c", 5, 10), ("c", 10, 12), ("c", 14, 20), ("c", 15, 16)], "chrom string, start int, end int")
    assert rows(intervals.union_intervals(i, ["chrom"], "start", "end"), "start", "end") == [(5, 12), (14, 20)]
    mask = spark.createDataFrame([("c", 10, 20)], "chrom string, start int, end int")
    f = [(1, 0, 10), (2, 5, 25), (3, 12, 18), (4, 20, 30), (5, 10, 20), (6, 15, 30)]
    df = spark.createDataFrame([("c", *x) for x in f], "chrom string, feature_id int, start int, end int")
    assert rows(intervals.remap_features(df, mask, ["chrom"]), "feature_id", "new_start", "new_end") == [(1, 0, 10), (2, 5, 15), (4, 10, 20), (5, 10, 10)]


def test_excise(spark):
    df = spark.createDataFrame([("ABCDEFGHIJ", [(2, 4), (6, 7)]), ("ABC", [])], "s string, m array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(intervals.excise(F.col("s"), F.col("m"))).collect()] == ["ABEFHIJ", "ABC"]


def test_sites(spark):
    df = spark.createDataFrame([("a", x) for x in (100, 110, 130, 151)] + [("b", 100), ("b", 120)], "k string, pos int")
    assert rows(intervals.site_counts(df, ["k"], "pos", 20), "k", "n_sites") == [("a", 2), ("b", 1)]


def test_depth(spark):
    blocks = spark.createDataFrame([("e", 1, 3), ("e", 1, 3), ("e", 2, 3), ("e", 2, 3)], "k string, start int, end int")
    seg = depth.depth_segments(blocks, ["k"])
    assert rows(seg, "start", "end", "depth") == [(1, 2, 2), (2, 3, 4)]
    lengths = spark.createDataFrame([("e", 4), ("f", 10), ("z", 0)], "k string, length int")
    stats = {r.k: r for r in depth.coverage_stats(seg, lengths, ["k"], 4).collect()}
    assert (stats["e"].mean, stats["e"].var, stats["e"].var_first) == (1.5, 2.75, 2.75) and stats["f"].mean == 0 and "z" not in stats
    assert rows(depth.breadth(seg, lengths, ["k"], 4, 0.25), "k", "covered", "keep") == [("e", 1, True), ("f", 0, False)]


def test_nested_classes(spark):
    seq = "A" * 40
    hit = lambda s, p, t, score=50.0: (s, t, 99.0, 40, 1, 40, 40, p, p + 39, "plus", score, 1000)
    names = ["r21", "r22", "r980", "tie"]
    seqs = {n: chr(65 + i) * 40 for i, n in enumerate(names)}
    h = [hit(seqs["r21"], 21, "T"), hit(seqs["r22"], 22, "T"), hit(seqs["r980"], 980, "T"), hit(seqs["tie"], 500, "A"), hit(seqs["tie"], 500, "Host")]
    hs = spark.createDataFrame(h, "rep_seq string, sseqid string, pident double, length int, qstart int, qend int, qlen int, sstart int, send int, sstrand string, bitscore double, slen int")
    k = [("s", "Host", "right", i, seqs[n]) for i, n in enumerate(names)] + [("s", "Host", "right", 8, "ACGT"), ("s", "Host", "right", 9, "Z" * 40)]
    ks = spark.createDataFrame(k, "sample string, is_element string, side string, cluster_id int, rep_seq string")
    targets = spark.createDataFrame([("T", "db")], "target string, target_db string")
    got = nested.classify_nested(ks, hs, targets)
    assert rows(got, "cluster_id", "class") == [(0, "terminal"), (1, "internal"), (2, "terminal"), (3, "self"), (8, "too_short"), (9, "no_is_hit")]
    summary = {r["class"]: r.n_clusters for r in nested.class_summary(got).collect()}
    assert summary == {"too_short": 1, "no_is_hit": 1, "distal_only": 0, "self": 1, "terminal": 2, "internal": 1}
    assert len(seq) == 40


def test_nested_pairs_and_summaries_are_of_placed_classes(spark):
    rows_ = [("s", "E", side, i, kind, "T", "db", 500, pos, "plus", 99.0) for i, (side, kind, pos) in enumerate([("left", "self", 100), ("right", "self", 101), ("left", "internal", 300), ("right", "terminal", 310), ("right", "self", 305)])]
    df = spark.createDataFrame(rows_, "sample string, is_element string, side string, cluster_id int, class string, target string, target_db string, target_len int, junction_pos int, sstrand string, pident double")
    got = nested.paired_in_target(df)
    assert rows(got, "cluster_id", "paired_in_target") == [(0, False), (1, False), (2, True), (3, True), (4, False)]
    assert rows(nested.host_target_summary(got), "class", "n_clusters", "n_samples_paired") == [("internal", 1, 1), ("terminal", 1, 1)]


def hits_of(spark, hits):
    """hits: (element, side, cluster, sstart, send, strand, bitscore) on one contig."""
    data = [("s", e, side, c, f"{e}{side}{c}", "g__c", 100.0, 50, 1, 50, 50, a, b, strand, score, 0.0) for e, side, c, a, b, strand, score in hits]
    return spark.createDataFrame(data, "sample string, is_element string, side string, cluster_id int, qseqid string, sseqid string, pident double, length int, qstart int, qend int, qlen int, sstart int, send int, sstrand string, bitscore double, evalue double")


def test_candidates_are_one_for_a_junction(spark):
    df = hits_of(spark, [("E", "right", 0, 100, 149, "plus", 90.0), ("E", "right", 0, 100, 51, "minus", 95.0), ("E", "right", 0, 500, 549, "plus", 80.0)])
    assert rows(placement.candidates(df), "junction_pos0", "strand", "score_frac", "rank") == [(99, "-", 1.0, 1)]
    assert rows(placement.candidates(df, min_score=0.8), "junction_pos0", "rank") == [(99, 1), (499, 2)]


def test_loci_go_by_parts_of_the_best_score(spark):
    # A long cluster's second-best place has a higher raw score than a short one's best, but a smaller part.
    hits = [("E", "left", 0, 51, 100, "plus", 400.0), ("E", "left", 0, 951, 1000, "plus", 380.0), ("E", "right", 1, 1010, 1059, "plus", 300.0), ("E", "right", 2, 110, 159, "plus", 60.0)]
    got = rows(placement.select_loci(placement.candidates(hits_of(spark, hits))), "side", "cluster_id", "junction_pos0", "matched")
    assert got == [("left", 0, 99, True), ("right", 1, 1009, False), ("right", 2, 109, True)]


def test_unknown_references_are_charged_with_the_first_reasons_only(spark):
    from flankspark.operators import alignment

    a = [("n", "ACGN", 0, 60), ("short", "ACGT", 0, 5), ("fine", "ACGT", 0, 60)]
    df = spark.createDataFrame([("s", i, "X", None, lo, hi, 60, 0, 0, [(4, 9), (0, hi - lo)], seq) for i, seq, lo, hi in a], "sample string, query_name string, reference string, ref_length int, ref_start int, ref_end int, mapq int, flag int, nm int, cigar array<struct<op:int,len:int>>, query_sequence string")
    assert rows(alignment.filter_alignments(df), "query_name", "drop_reason") == [("n", "non_acgt"), ("short", "short_is_alignment")]


def test_pooled_clusters(spark):
    m = spark.createDataFrame([(0, "A|1", True), (0, "A|2", False), (0, "B|1", False), (1, "C|1", True)], "cluster int, name string, is_rep boolean")
    assert rows(clustering.pooled_clusters(m), "cluster", "n_seqs", "n_samples", "representative") == [(0, 3, 2, "A|1")]


def test_events(spark):
    c = [("s", "E", "left", 0, "E:right:0"), ("s", "E", "right", 0, "none"), ("s", "E", "left", 1, "F:right:3")]
    schema = "sample string, is_element string, side string, cluster_id int, pairing string"
    assert rows(events.insertion_events(spark.createDataFrame(c, schema)), "is_element", "n_events") == [("E", 2)]
    old = [("s", "E", "left", 0, "0"), ("s", "E", "right", 0, "none")]
    assert rows(events.insertion_events(spark.createDataFrame(old, schema)), "n_events") == [(1,)]


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(120)] + [(200 + i, 201 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = dict(rows(connected_components(spark.createDataFrame(edges, "u int, v int")), "node", "component"))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_genome_sizes(spark):
    df = spark.createDataFrame([("a", "5230000.0", 0), ("b", "", 1), ("c", "abc", 2), ("a", "7", 3)], "run_accession string, Genome_Size string, n int")
    assert rows(metadata.genome_sizes(df, ["n"]), "run_accession", "genome_size") == [("a", 5230000)]


def test_indexed_leaders_equal_brute_force(spark, monkeypatch):
    """Groups that need an index, over lengths from nothing to 60, chains of near sequences, repeats, and both budgets."""
    monkeypatch.setattr(clustering, "FOLDED", 5)
    r = random.Random(21)
    word = lambda n, of="ACGT": "".join(r.choice(of) for _ in range(n))

    def changed(s, n):
        s = list(s)
        for _ in range(n):
            kind = r.randrange(3)
            at = r.randrange(len(s) + 1)
            if kind == 0:
                s.insert(at, r.choice("ACGT"))
            elif s and at < len(s):
                s[at : at + 1] = [] if kind == 1 else [r.choice("ACGT")]
        return "".join(s)

    for fraction, head in ((0.10, 768), (0.15, 2), (0.30, 4)):
        monkeypatch.setattr(clustering, "HEAD", head)
        monkeypatch.setattr(clustering, "BLOCK", 2 if head < 9 else 256)
        items = []
        for g in ("a", "b"):
            seqs = ["", "A", "C", "AC", "GTT"] + [word(r.randrange(3, 14), "AC") for _ in range(25)]
            chain = word(40)
            for _ in range(12):
                chain = changed(chain, 3)
                seqs.append(chain)
            for b in [word(r.randrange(20, 60)) for _ in range(4)]:
                seqs += [changed(b, r.randrange(5))[: r.randrange(15, 60)] for _ in range(12)]
            items += [(g, f"{g}{i:03d}", s) for i, s in enumerate(seqs + seqs[:4])]
        df = spark.createDataFrame(items, "g string, read_id string, cmp string")
        found: dict = {}
        for x in clustering.leader_clusters(df, ["g"], fraction).collect():
            found.setdefault((x.g, x.seed), []).append(x.read_id)
        for g in ("a", "b"):
            assert sorted(sorted(v) for k, v in found.items() if k[0] == g) == leaders([x[1:] for x in items if x[0] == g], fraction)


def test_recruiting_equals_brute_force(spark):
    r = random.Random(22)
    word = lambda n, of="ACGT": "".join(r.choice(of) for _ in range(n))
    turn = str.maketrans("ACGT", "TGCA")
    reps = [("s", e, side, i, word(r.randrange(1, 40), "ACG" if i % 3 else "A")) for e in ("e", "f") for side in ("left", "right") for i in range(15)]
    reps += [("s", "e", "left", 99, reps[0][4])]
    amb = []
    for i in range(150):
        e, side, _, seq = r.choice(reps)[1:]
        seq = list(seq)
        for _ in range(r.randrange(3)):
            seq[r.randrange(len(seq))] = r.choice("ACGT")
        seq = "".join(seq) + word(r.choice([0, 0, 5]))
        amb.append(("s", f"r{i}", e, r.choice(["left", "right", "up", None]), r.choice([seq, seq[::-1].translate(turn), seq[: r.randrange(1, 12)], ""])))
    want = []
    for s, i, e, side, seq in amb:
        if side not in ("left", "right"):
            want.append((i, None, None, "bad_side"))
            continue
        near = []
        for _, re_, rside, rid, rep in reps:
            if re_ != e:
                continue
            x = seq if rside == side else seq[::-1].translate(turn)
            u, v = (x[::-1], rep[::-1]) if rside == "left" else (x, rep)
            q, t = (u, v) if len(u) <= len(v) else (v, u)
            d = prefix_distance(q, t, max(1, round(len(q) * 0.1))) if q else None
            if d is not None:
                near.append((d / len(q), rside, rid))
        best = [x for x in near if x[0] - min(near)[0] <= 1e-9] if near else []
        want.append((i, None, None, "no_match") if not best else (i, None, None, "tie") if len(best) > 1 else (i, best[0][1], best[0][2], None))
    a = spark.createDataFrame(amb, "sample string, read_id string, is_element string, side string, seq string")
    b = spark.createDataFrame(reps, "sample string, is_element string, side string, cluster_id int, representative_sequence string")
    got = clustering.recruit(a, b).select("read_id", "side", "cluster_id", "reason").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {x[3] for x in want} == {None, "tie", "no_match", "bad_side"}


def test_tied_hits_are_chosen_alike_in_any_order(spark):
    """Hits that differ only in what of the query they hold: the one that reaches the junction, or the longest, wherever it lies in the table."""
    hit = lambda qstart, length: ("S0__E1__right__cluster1", "G0__c0", 99.0, length, qstart, 50, 50, 101, 150, "plus", 90.0, 0.001, "right")
    kinds = "qseqid string, sseqid string, pident double, length int, qstart int, qend int, qlen int, sstart int, send int, sstrand string, bitscore double, evalue double, side string"
    found = {"c": set(), "n": set()}
    tied = [hit(2, 49), hit(1, 46), hit(1, 50), hit(2, 50)]
    clusters = spark.createDataFrame([("S0", "E1", "right", 1, "A" * 50)], "sample string, is_element string, side string, cluster_id int, rep_seq string")
    targets = spark.createDataFrame([("G0__c0", "db")], "target string, target_db string")
    for rows in (tied, tied[::-1], tied[1:] + tied[:1], tied[2:] + tied[:2]):
        h = spark.createDataFrame(rows, kinds).coalesce(1)
        found["c"] |= {(r.reach_ok, r.length) for r in placement.candidates(h).collect()}
        n = nested.classify_nested(clusters, h.drop("side").withColumns({"rep_seq": F.lit("A" * 50), "slen": F.lit(1000)}), targets)
        found["n"] |= {(r.target, r.aln_len) for r in n.collect()}
    assert found == {"c": {(True, 50)}, "n": {("G0__c0", 50)}}

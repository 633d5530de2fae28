"""The Jaccard join against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from flankspark.llm import jaccard

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    own = list(range(len(docs)))

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if c and 100 * c >= 75 * (len(a) + len(sets[j]) - c):
                x, y = find(i), find(j)
                own[max(x, y)] = min(x, y)
    least: dict = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs))


def texts(seed, n, size, edits, passage):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    base, common = [word() for _ in range(size)], [word() for _ in range(passage)]
    out = []
    for _ in range(n):
        kind = r.random()
        w = list(base) if kind < 0.7 else [word() for _ in range(max(1, int(size * r.uniform(0.3, 1.2))))] + common
        for _ in range(r.randrange(edits + 1)):
            if w:
                w[r.randrange(len(w))] = word()
        if r.random() < 0.2:
            w = w[: r.randrange(len(w) + 1)]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("n", "size", "edits", "passage"), [(260, 150, 9, 60), (220, 60, 4, 30), (300, 14, 2, 6), (150, 7, 1, 3)])
def test_components_equal_brute_force(spark, n, size, edits, passage):
    docs = [(i * 3 % 1009, t) for i, t in enumerate(texts(n, n, size, edits, passage))]
    got = jaccard.find_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(docs)


@pytest.mark.parametrize("bounds", [{"CHUNK": 7, "PART": 11, "COLUMNS": 16}, {"HELD": 900}, {"HOT": 2, "SALTS": 3}, {"HOT": 3, "SALTS": 2, "CHUNK": 7, "PART": 11}])
def test_blocks_split(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(jaccard, name, value)
    docs = list(enumerate(texts(8, 150, 150, 9, 60)))
    got = jaccard.find_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(docs)


def test_pairs_of_hot_signatures(spark):
    r = random.Random(3)
    rows = [(s, r.randrange(40), 0) for s in (1, 2) for _ in range(60)] + [(3, n, 0) for n in r.sample(range(1000), 300)] * 2 + [(4, 5, 0)]
    want = {(min(n for t, n, _ in rows if t == s), n) for s, n, _ in rows} - {(n, n) for _, n, _ in rows}
    dealt = []
    for at in range(0, len(rows), 90):
        sig, node = (np.array([x[k] for x in rows[at : at + 90]], np.int64) for k in (0, 1))
        dealt += [tuple(map(int, x)) for x in zip(sig, node, jaccard.salted(sig, node), strict=True)]
    assert {x[2] for x in dealt} > {-1, 0}
    got = [tuple(x) for x in jaccard.leader_pairs(spark.createDataFrame(dealt, "sig long, node long, salt int")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_task_sends_few_rows_of_a_hot_signature(spark, monkeypatch):
    """Blocks that hold a signature fewer than HOT times each: what counts is the task's sum."""
    r = random.Random(4)
    seen, rows = jaccard.Seen(), []
    for block in range(400):
        sig, node = np.array([7] * 5 + [1000 + block], np.int64), np.array([r.randrange(-(10**12), 10**12) for _ in range(6)], np.int64)
        rows += [tuple(map(int, x)) for x in zip(sig, node, jaccard.salted(sig, node, seen), strict=True)]
    hot = [x for x in rows if x[0] == 7]
    to_bucket = [n for _, n, salt in hot if salt <= 0]
    assert len(to_bucket) < 60 and min(to_bucket) == min(n for _, n, _ in hot)
    assert all(salt == 0 for s, _, salt in rows if s != 7)
    got = {tuple(x) for x in jaccard.leader_pairs(spark.createDataFrame(rows, "sig long, node long, salt int")).collect()}
    least = min(n for _, n, _ in hot)
    assert got == {(least, n) for _, n, _ in hot} - {(least, least)}


def test_signatures_of_a_long_task_stay_cold(monkeypatch):
    """Many signatures that a task meets once each share counters, however few of them there are."""
    monkeypatch.setattr(jaccard, "COUNTERS", 1 << 10)
    r, seen, dealt = random.Random(6), jaccard.Seen(), 0
    for _ in range(200):
        sig, node = (np.array([r.getrandbits(63) for _ in range(500)], np.int64) for _ in range(2))
        sig[:20] = 7
        salt = jaccard.salted(sig, node, seen)
        dealt += int((salt[20:] != 0).sum())
    assert dealt < 200 * 480 // 50 and len(seen.sent) < 2000
    assert (salt[:20] != 0).all()


def test_leaders_of_one_home_share_their_blocks(spark):
    """Six leaders of the same 40 near copies and 10 strays: each member is in one block, and every stray meets every member."""
    members, strays = list(range(100, 140)), list(range(200, 210))
    pairs = spark.createDataFrame([(a, b) for a in range(100, 106) for b in members + strays if a != b], "a long, b long")
    labels = spark.createDataFrame([(b, 100) for b in members], "node long, component long")
    classes = spark.createDataFrame([(b, 50) for b in members + strays], "node long, n long")
    rows = jaccard.stray_blocks(pairs, labels, classes).collect()
    assert len(rows) == len(members) + len(strays) and {r.a for r in rows} == {100}
    assert {r.node for r in rows if r.is_left} == {*strays} and {r.node for r in rows if r.is_right} == {*members, *strays}
    assert jaccard.stray_blocks(pairs.where("b < 200"), labels, classes) is None


def test_strays_of_leaders_that_are_in_no_component(spark, monkeypatch):
    """The leader itself is a stray where most of its members are in a component without it."""
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    monkeypatch.setattr(jaccard, "PART", 3)
    pairs = spark.createDataFrame([(1, b) for b in range(2, 40)], "a long, b long")
    component = {b: 5 if b < 20 else 20 if b < 30 else b for b in range(1, 40)} | {1: 1}
    labels = spark.createDataFrame([(b, c) for b, c in component.items() if list(component.values()).count(c) > 1], "node long, component long")
    classes = spark.createDataFrame([(b, 9) for b in range(1, 40)], "node long, n long")
    met, blocks = set(), {}
    for r in jaccard.stray_blocks(pairs, labels, classes).collect():
        blocks.setdefault((r.a, r.chunk, r.part), []).append(r)
    for rows in blocks.values():
        met |= {frozenset((x.node, y.node)) for x in rows for y in rows if x.is_left and y.is_right and x.node != y.node}
    assert len(blocks) > 1 and met >= {frozenset((x, y)) for x in component for y in component if component[x] != component[y]}


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(30000))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, long), (7, long + " more"), (9, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"), (10, "É é É é É"), (11, "é é é é é")]
    df = spark.createDataFrame([(a, b, "s") for a, b in docs], "doc_id long, text string, n_shingles string")
    assert sorted(tuple(r) for r in jaccard.find_components(df).collect()) == brute(docs)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 8, 10, 11]
    assert jaccard.find_components(df.where("false")).count() == 0


def test_keep_one_judges_rows_that_share_an_id(spark):
    copy, base = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    near = base + " more"
    docs = [(1, copy), (5, copy), (5, "only under five here now"), (6, "six is alone in this table"), (7, "seven one text of its own"), (7, "seven another text of its own"), (7, "seven another text of its own"), (8, base), (8, near), (9, near)]
    docs += [(None, copy), (None, "no id but a text alone"), (None, "no id and yet another text"), (None, "no id and yet another text"), (None, ""), (None, None), (10, ""), (10, "")]
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one(spark.createDataFrame([(*x, "s") for x in docs], "doc_id long, text string, source string")).collect()]
    eights = [x for x in kept if x[0] == 8]
    assert len(eights) == 1 and eights[0][1] in (base, near)
    want = [(1, copy), docs[2], docs[3], docs[4], docs[5], (None, docs[11][1]), (None, docs[12][1]), (None, ""), (None, None), (10, ""), (10, "")]
    assert sorted(map(repr, kept)) == sorted(map(repr, want + eights))


def test_parities_lose_no_link():
    r = random.Random(5)
    sets, words = [], [np.uint64(r.getrandbits(64)) for _ in range(3000)]
    for n in (1, 2, 7, 31, 32, 33, 60, 70, 250, 260, 900):
        base = r.sample(words, n)
        for _ in range(6):
            cut = r.sample(base, max(1, n - r.randrange(n // 4 + 1)))
            sets.append(sorted({*cut, *r.sample(words, r.randrange(n // 4 + 1))}))
    odd = [np.frombuffer(jaccard.parities(np.array(x, np.uint64)), np.uint64) for x in sets]
    sizes = np.array([len(x) for x in sets])
    left, right = (np.array([r.random() < 0.7 for _ in sets]) for _ in range(2))
    may = jaccard.may_link(odd, sizes, left, right)
    for i, a in enumerate(sets):
        links = [j for j, b in enumerate(sets) if i != j and 175 * len({*a} & {*b}) >= 75 * (len(a) + len(b)) and (left[i] and right[j] or right[i] and left[j])]
        assert may[i] or not links
    far = [np.frombuffer(jaccard.parities(np.array(r.sample(words, 500), np.uint64)), np.uint64) for _ in range(20)]
    assert not jaccard.may_link(far, np.full(20, 500), np.ones(20, bool), np.ones(20, bool)).any()


def test_bounds_cover_every_pair():
    for s in range(1, 200):
        for r in range(s, 4 * s // 3 + 1):
            band = jaccard.band_of(s)
            own = {b: (way, m, h) for b, way, m, h in jaccard.duties(s)}
            other = {b: (way, m, h) for b, way, m, h in jaccard.duties(r)}
            assert band in own and band in other
            need = jaccard.differ(s, r)
            if need < 0:
                continue
            for way, m, h in (own[band], other[band]):
                assert (m > need // 2) if way else (h >= need and m > need), (s, r)

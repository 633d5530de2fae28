"""SimHash components, whitening and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flankspark.llm import importance, queries, simhash, whitening

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [None, "", " \n\t ", "one", "One two", "one  TWO\x0bthree", "é ñ ß — word", "a b c " * 40, "x" * 5000 + " y z w"]


def near_copies(r, n_groups, n_copies):
    words = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n_groups):
        base = [r.choice(words) for _ in range(r.randrange(60, 200))]
        for _ in range(n_copies):
            own = list(base)
            for _ in range(r.randrange(4)):
                own[r.randrange(len(own))] = r.choice(words)
            out.append(" ".join(own))
    return out


# ---------------------------------------------------------------- simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_components(nodes, radius):
    """The least id that each (id, fingerprint) reaches."""
    least = {}
    left = list(dict.fromkeys(f for _, f in nodes))
    while left:
        group, open_ = {left[0]}, [left[0]]
        while open_:
            x = open_.pop()
            more = {y for y in left if y not in group and (x ^ y).bit_count() <= radius}
            group |= more
            open_ += more
        ids = [i for i, f in nodes if f in group and i is not None]
        least |= dict.fromkeys(group, min(ids, default=None))
        left = [y for y in left if y not in group]
    return least


def test_fingerprint_equals_brute_force(monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    for t in TEXTS + near_copies(r, 4, 2):
        assert simhash.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def test_tree_finds_what_is_near():
    r = random.Random(5)
    values = list({r.getrandbits(64) for _ in range(150)})
    values += [v ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for v in values[:60]]
    tree = simhash.BKTree()
    places = [tree.add(v) for v in values]
    for radius in (0, 1, 3, 40):
        for v in values[:40] + [r.getrandbits(64) for _ in range(20)]:
            assert {tree.values[i] for i in tree.near(v, radius)} == {x for x in values if (x ^ v).bit_count() <= radius}
    assert [tree.add(v) for v in values] == places


@pytest.mark.parametrize("m", [4, 5, 6, 9])
def test_routes_lose_no_link(spark, m):
    r = random.Random(m)
    pairs = []
    for _ in range(300):
        a, b = r.getrandbits(64), 0
        for bit in r.sample(range(64), 3):
            b |= 1 << bit
        pairs.append((a - (1 << 63), (a ^ b) - (1 << 63)))
    df = spark.createDataFrame(pairs, "a long, b long")
    shared = F.arrays_overlap(simhash._routes(F.col("a"), m, 3), simhash._routes(F.col("b"), m, 3))
    assert df.where(~shared).count() == 0


@pytest.mark.parametrize("tree,shard", [(2048, 64), (5, 64), (2048, 1)])
def test_components_equal_brute_force(spark, monkeypatch, tree, shard):
    monkeypatch.setattr(simhash, "TREE", tree)
    monkeypatch.setattr(simhash, "SHARD", shard)
    r = random.Random(tree)
    texts = TEXTS + near_copies(r, 12, 12) + [None]
    rows = [(i * 7 % 1000 if i % 11 else None, t) for i, t in enumerate(texts)] + [(3, texts[20]), (3, texts[20])]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    least = slow_components(prints, 3)
    assert Counter((i, f"{f:016x}", least[f]) for i, f in prints) == Counter(tuple(x) for x in got)


def test_dense_ball_over_many_trees(spark, monkeypatch):
    """All fingerprints share most bits, so every shard is hot: trees stay small, and links are a forest, not all pairs."""
    monkeypatch.setattr(simhash, "TREE", 16)
    r = random.Random(8)
    fps = list({sum(1 << b for b in r.sample(range(40), r.randrange(4))) for _ in range(400)})
    found = simhash.links(spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long")).collect()
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in found:
        assert a != b
        parent[root(a)] = root(b)
    least = slow_components(list(enumerate(fps)), 3)
    groups = Counter((least[f], root(i)) for i, f in enumerate(fps))
    assert len(groups) == len({a for a, _ in groups}) == len({b for _, b in groups})


# ---------------------------------------------------------------- whitening


def symmetric(values, seed):
    r = np.random.default_rng(seed)
    q = np.linalg.qr(r.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(values)) - 0.5 * (q.T @ q))
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize(
    "values",
    [[9, 5, 3, 1, 0.5], [4, 4, 4, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5 + 3e-12, 1e-3], [2.0] * 6, [1e6, 1.0, 1.0 + 1e-7, 1e-6], [0.0, 0.0], list(np.linspace(1, 1 + 1e-6, 24)), [3]],
)
def test_eigenvectors_are_right_to_double_precision(values):
    a, q = symmetric(values, len(values))
    a = (a + a.T) / 2
    x, e = whitening.eigen(a)
    scale = max(float(np.abs(a).max()), 1e-300)
    assert float(np.abs(x.T @ x - np.eye(len(a))).max()) < 1e-16
    assert float(np.abs(a @ x - x * e).max()) / scale < 1e-16
    assert all(e[i] >= e[i + 1] - 1e-15 * scale for i in range(len(e) - 1))
    order = np.argsort(-np.array(values))
    for k, i in enumerate(order):
        gap = min([abs(values[i] - v) for j, v in enumerate(values) if j != i], default=1)
        if gap > 1e-13 * scale:
            # The matrix itself was made with errors of some 1e-19.
            assert abs(abs(float(q[:, i] @ x[:, k])) - 1) < 1e-15
            assert float(np.abs(np.abs(q[:, i]) - np.abs(x[:, k])).max()) < 1e-15 + 1e-17 * scale / gap


def whitened(spark, rows, **options):
    rows = [(i, None if x is None else [None if v is None else float(v) for v in x]) for i, x in rows]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), **options)
    return out.collect()


def test_whitening_equals_brute_force(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(60, 6)) * [3, 2, 1, 1, 0.5, 0.1]
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(base.astype(np.float32))]
    rows += [(60, None), (61, [1.0, None, 0, 0, 0, 0]), (62, [float("nan")] * 6), (63, [float("inf"), 0, 0, 0, 0, 0]), (64, []), (65, [1.0, 2.0]), (66, [1e30, 0, 0, 0, 0, 0]), (None, rows[3][1]), *[rows[5]] * 4]
    used = [(i, x) for i, x in rows if x is not None and len(x) == 6 and all(v is not None and math.isfinite(v) and abs(v) < 1e20 for v in x)]
    x = np.array([[math.floor(1024 * float(np.float32(v))) + 100000 for v in v_] for _, v_ in used])
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    got = whitened(spark, rows, components=4)
    assert Counter(g.vec_id for g in got) == Counter({i: 4 * k for i, k in Counter(i for i, _ in used).items()})
    want = {}
    for (i, _), c, own in zip(used, centred, x, strict=True):
        for k in range(4):
            want[i, k + 1] = (sum((n * int(o) - int(t)) ** 2 for o, t in zip(own, s, strict=True)), abs(float(c @ q[:, k])) / math.sqrt(e[k]), e[k] / np.trace(v))
    for g in got:
        deviation, value, part = want[g.vec_id, g.component]
        assert g.n == n and int(g.deviation) == deviation
        assert abs(abs(g.whitened) - value) < 1e-9 and abs(g.explained / part - 1) < 1e-12 and g.identity_error < 1e-12


def test_whitening_of_equal_and_huge_vectors(spark):
    same = whitened(spark, [(i, [1.0, 2.0]) for i in range(5)])
    assert same == []
    line = whitened(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])
    assert {g.component for g in line} == {1} and all(abs(g.explained - 1) < 1e-12 for g in line)
    huge = [(0, [5e8, 0.0]), (1, [-5e8, 0.0]), (2, [0.0, 1.0]), (3, [0.0, -1.0])]
    x = [[math.floor(1024 * float(np.float32(v))) + 100000 for v in y] for _, y in huge]
    s = [sum(c) for c in zip(*x, strict=True)]
    for g in whitened(spark, huge):
        assert int(g.deviation) == sum((4 * o - t) ** 2 for o, t in zip(x[g.vec_id], s, strict=True))
        assert g.identity_error < 1e-6


# ---------------------------------------------------------------- importance


def slow_resample(docs, bench, percent, min_words, max_run, buckets, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, max_run + 1) for i in range(len(words) - k + 1)]

    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x)[1])
    for x in bench:
        t.update(features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for i, x in docs:
        n, f = features(x)
        weight = sum(map(gain, f))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    enough = [x for x in out if x[4] >= min_words]
    drawn = sorted(enough, key=lambda x: (-x[3], 2**63 if x[0] is None else x[0]))[: percent * len(enough) // 100]
    ranks = {}
    for k, x in enumerate(drawn):
        ranks.setdefault(x, []).append(k + 1)
    return Counter((*x[:4], ranks[x].pop(0) if ranks.get(x) else None) for x in out)


@pytest.mark.parametrize("percent,max_run", [(10, 1), (37, 3), (0, 1), (100, 1)])
def test_resampling_equals_brute_force(spark, percent, max_run):
    r = random.Random(percent)
    docs = [(r.randrange(40), t) for t in TEXTS + near_copies(r, 8, 10)] + [(None, TEXTS[7]), (None, "b c d " * 20)]
    docs += [docs[30]] * 5
    bench = [None, "", *near_copies(r, 3, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = importance.resample(d, spark.createDataFrame([(t,) for t in bench], "text string"), percent=percent, max_run=max_run, buckets=97).collect()
    assert Counter(tuple(x) for x in got) == slow_resample(docs, bench, percent, 20, max_run, 97, 2024)


def test_cutoff_by_bisection(spark):
    r = random.Random(2)
    values = [r.choice([-(10**12), 0, 5, 6, 7, 10**9, r.randrange(-1000, 1000)]) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v long").cache()
    for k in (1, 2, 250, 499, 500):
        v = sorted(values)[k - 1]
        assert importance.smallest(rows, F.col("v"), k) == (v, sum(x < v for x in values), sum(x <= v for x in values))


def test_all_rows_tie(spark):
    scored = spark.createDataFrame([(7, i, 5) for i in range(100)], "id long, row long, score long")
    ranks = sorted(x.rank for x in importance.draw(scored, 30).collect() if x.rank is not None)
    assert ranks == list(range(1, 31))


def test_registered():
    assert {"op11_simhash", "op12_whitening", "op13_importance_resampling"} <= set(queries.queries())

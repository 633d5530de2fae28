"""Identity clusters against a program that compares everything with everything."""

import random

import pytest

from flankspark.operators import identity

TURN = str.maketrans("ACGT", "TGCA")


def inside(q, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(q, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def slow(records, threshold, both):
    heads, out = [], {}
    for name, s in sorted((x for x in records if x[1]), key=lambda x: (-len(x[1]), x[0], x[1])):
        k = int(round((1 - threshold) * len(s), 6) // 1)
        for i, h in enumerate(heads):
            if min(inside(s, h), inside(s[::-1].translate(TURN), h) if both else len(s)) <= k:
                out[name] = i
                break
        else:
            out[name] = len(heads)
            heads.append(s)
    return out


def families(seed, n_families, n_members, low, high):
    r = random.Random(seed)
    out = []
    for f in range(n_families):
        base = "".join(r.choice("ACGT") for _ in range(r.randrange(low, high)))
        for m in range(n_members):
            s = list(base)
            for _ in range(r.randrange(1 + len(s) // 8)):
                at = r.randrange(len(s))
                s[at : at + 1] = r.choice([[], [r.choice("ACGT")], [s[at], r.choice("ACGT")]])
            s = "".join(s)[r.randrange(4) :]
            out.append((f"f{f:02d}m{m:02d}", s if r.random() < 0.7 else s[::-1].translate(TURN)))
    return out


def test_edits_inside():
    r = random.Random(4)
    for _ in range(300):
        q, t = ("".join(r.choice("AC") for _ in range(r.randrange(0, 70))) for _ in range(2))
        d = inside(q, t)
        assert identity.edits_inside(q, t, d) == d and (d == 0 or identity.edits_inside(q, t, d - 1) is None)


@pytest.mark.parametrize("threshold,word,both,head", [(0.95, 10, True, 64), (0.90, 8, True, 2), (0.80, 4, False, 64)])
def test_clusters_equal_brute_force(spark, monkeypatch, threshold, word, both, head):
    monkeypatch.setattr(identity, "HEAD", head)
    monkeypatch.setattr(identity, "TRIED", 8 if head > 2 else 1)
    records = families(word, 8, 10, 30, 140) + [("a", "A"), ("aa", "AA"), ("empty", ""), ("none", None), ("poly", "A" * 60), ("poly2", "A" * 50 + "C"), ("cg", "CG" * 20)]
    got = identity.identity_clusters(spark.createDataFrame(records, "name string, seq string").repartition(4), threshold, word, both).collect()
    assert {r.name: r.cluster for r in got} == slow(records, threshold, both)
    heads = {r.cluster: dict(records)[r.name] for r in got if r.is_rep}
    assert len(heads) == len({r.cluster for r in got})
    for r in got:
        s = dict(records)[r.name]
        d = inside(s if r.strand == "+" else s[::-1].translate(TURN), heads[r.cluster])
        assert abs(r.identity - (1 - d / len(s))) < 1.01e-4 and r.identity >= threshold - 1e-9


def test_no_records(spark):
    assert identity.identity_clusters(spark.createDataFrame([], "name string, seq string")).count() == 0


def test_copies_are_compared_once(spark, monkeypatch):
    asked = []
    own = identity._first_held
    monkeypatch.setattr(identity, "_first_held", lambda rest, *more: asked.append(rest.count()) or own(rest, *more))
    known = families(5, 4, 5, 30, 60) + [("cg", "CG" * 20)]
    records = [(f"{name}c{i}", s) for name, s in known for i in range(20)] + [("cgc0", "CG" * 20), (None, known[0][1])]
    got = identity.identity_clusters(spark.createDataFrame(records, "name string, seq string").repartition(4), 0.9, 8).collect()
    assert asked[0] == len({s for _, s in known})
    assert len(got) == len(records) and sum(r.is_rep for r in got) == len({r.cluster for r in got})
    want = slow([r for r in records if r[0]], 0.9, True)
    own_seqs = {r[0]: r[1] for r in records}
    # The copy without a name comes first of its length, which may number clusters anew, so clusters are compared as sets.
    sets = lambda pairs: {frozenset(n for n, c in pairs if c == k) for k in {c for _, c in pairs}}
    assert sets([(own_seqs[r.name], r.cluster) for r in got if r.name]) == sets([(own_seqs[n], c) for n, c in want.items()])

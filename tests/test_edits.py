"""Edit distances of many pairs at once, and the ways of clustering and recruitment that use them, against the ways without."""

import random

import numpy as np
import pyarrow as pa
import pytest

from flankspark.functions import edits
from flankspark.operators import clustering


def slow(q, t, k):
    row = list(range(len(q) + 1))
    least = row[-1]
    for c in t:
        new = [row[0] + 1]
        for i, x in enumerate(q, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
        row, least = new, min(least, new[-1])
    return least if least <= k else -1


def near(r, s, letters, most):
    s = list(s)
    for _ in range(r.randrange(most)):
        if s:
            at = r.randrange(len(s))
            s[at : at + 1] = r.choice([[], [r.choice(letters)], [s[at], r.choice(letters)]])
    return "".join(s) + "".join(r.choice(letters) for _ in range(r.randrange(5)))


@pytest.mark.parametrize("letters", ["ACGT", "AC", "Aéß漢"])
@pytest.mark.parametrize("low,high", [(0, 12), (20, 66), (60, 200)])
def test_prefix_edits(letters, low, high):
    r = random.Random(high)
    own = ["".join(r.choice(letters) for _ in range(r.randrange(low, high))) for _ in range(30)]
    own += [near(r, s, letters, 8) for s in own] + ["", "A"]
    n = len(own)
    q, k = [r.randrange(n) for _ in range(300)], [r.randrange(20) for _ in range(300)]
    t = [r.randrange(n) if i % 2 else (q[i] + 30) % 60 for i in range(300)]
    got = edits.prefix_edits(edits.Texts(pa.array(own)), np.array(q), np.array(t), np.array(k))
    assert list(got) == [slow(own[a], own[b], c) for a, b, c in zip(q, t, k, strict=True)]


def reads(spark, n_samples=3):
    r, out = random.Random(2), []
    base = ["".join(r.choice("ACGT") for _ in range(r.randrange(8, 90))) for _ in range(8)]
    for i in range(400):
        s = near(r, r.choice(base), "ACGT", 6)
        out.append((f"S{i % n_samples}", f"r{r.randrange(900)}", "E1" if i % 5 else "E2", r.choice(["left", "right"]), "ambiguous" if i % 4 == 0 else "own", s))
    out += [*out[:40], ("S0", "x", "E1", "left", "own", None), (None, "y", "E1", "left", "own", "ACGT"), ("S0", "z", "E1", "left", "ambiguous", ""), ("S0", "w", "E1", None, "ambiguous", "ACGT")]
    return spark.createDataFrame(out, "sample string, read_id string, is_element string, side string, bucket string, seq string").repartition(5)


@pytest.mark.parametrize("rows", [1 << 16, 7])
def test_clusters_and_recruits_as_without_batches(spark, monkeypatch, rows):
    o = reads(spark)
    plain = lambda df: sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))
    own = o.where("bucket = 'own'")
    monkeypatch.setattr(clustering, "ROWS", rows)
    got = clustering.cluster_reads(own)
    sizes = clustering.cluster_reads(own, only_sizes=True)
    assert plain(sizes) == plain(clustering.representatives(got))
    found = plain(clustering.recruit(o.where("bucket = 'ambiguous'"), sizes))
    with monkeypatch.context() as m:
        # Groups of some sizes go one way, the others the other.
        m.setattr(clustering, "HELD", 45)
        m.setattr(clustering, "FEW", 6)
        mixed = clustering.cluster_reads(own)
        assert plain(mixed) == plain(got) and plain(clustering.cluster_reads(own, only_sizes=True)) == plain(sizes)
        assert plain(clustering.recruit(o.where("bucket = 'ambiguous'"), sizes)) == found
        m.setattr(clustering, "HELD", 0)
        m.setattr(clustering, "FEW", 0)
        assert plain(clustering.cluster_reads(own)) == plain(got)
        assert plain(clustering.recruit(o.where("bucket = 'ambiguous'"), sizes)) == found
    assert len(got.collect()) > 100 and any("no_match" in x for x in found)

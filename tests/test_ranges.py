"""Range-split scans against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flankspark.functions import intervals, ranges


def plain_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture()
def hot(spark):
    """One key holds nearly all rows; there are null keys, null values and equal positions."""
    r = random.Random(12)
    rows = [("hot" if i % 20 else r.choice(["a", None]), r.randrange(300), i, r.choice([None, r.randrange(-50, 50)])) for i in range(900)]
    return spark.createDataFrame(rows, "k string, pos int, i int, v int").repartition(5)


@pytest.mark.parametrize("upto", [0, -1])
@pytest.mark.parametrize("kind", ["sum", "max", "last"])
def test_scans_equal_windows(spark, hot, kind, upto):
    of = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[kind]
    order = Window.partitionBy("k").orderBy("pos", "i").rowsBetween(Window.unboundedPreceding, upto)
    want = plain_rows(hot.withColumn("out", of("v").over(order)), "k", "pos", "i", "out")
    for most in (10, 10_000):
        scan = ranges.Ordered(hot, ["k"], ["pos", "i"], rows=most)
        assert scan.split == (most == 10)
        assert plain_rows(scan.scan("out", kind, "v", upto).done(), "k", "pos", "i", "out") == want


def test_a_hot_key_takes_many_tasks(hot):
    scan = ranges.Ordered(hot.where("k = 'hot'"), ["k"], ["pos", "i"], rows=10)
    held = [r["count"] for r in scan.df.groupBy("__range").count().collect()]
    assert len(held) >= 3 and max(held) < 900 * 0.6


def test_intervals_on_a_hot_key(spark, monkeypatch):
    r = random.Random(13)
    spans = [("c" if i % 9 else "d", s := r.randrange(20_000), s + r.randrange(1, 40)) for i in range(700)]
    df = spark.createDataFrame(spans, "chrom string, start int, end int")
    features = spark.createDataFrame([("c" if i % 7 else "d", i, s := r.randrange(20_000), s + r.randrange(1, 300)) for i in range(300)], "chrom string, feature_id int, start int, end int")

    def answers():
        masks = intervals.union_intervals(df, ["chrom"], "start", "end")
        return (
            plain_rows(masks, "chrom", "start", "end"),
            plain_rows(intervals.site_counts(df, ["chrom"], "start", 25), "chrom", "n_sites"),
            plain_rows(intervals.remap_features(features, masks, ["chrom"]), "chrom", "feature_id", "new_start", "new_end"),
        )

    want = answers()
    monkeypatch.setattr(ranges, "ROWS", 20)
    assert answers() == want
    union = []
    for k, a, b in sorted(spans):
        if union and union[-1][0] == k and a <= union[-1][2]:
            union[-1][2] = max(union[-1][2], b)
        else:
            union.append([k, a, b])
    assert want[0] == sorted(map(tuple, union), key=repr)


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(6)
    assert sorted(r.n for r in ranges.numbered(df, "n").collect()) == list(range(1000))
    assert all(r.n == r.x for r in ranges.numbered(df, "n", ["x"]).collect())
    assert ranges.numbered(df.where("false"), "n").count() == 0

"""Incremental runs against one run over everything."""

from pyspark.sql import functions as F

from flankspark.streaming.samples import run_new_samples

SCHEMA = "sample string, x int"


def test_runs_work_on_new_samples_only(spark, tmp_path):
    inbox, out, seen = (str(tmp_path / n) for n in ("in", "out", "seen"))
    worked = []

    def work(rows):
        worked.append(sorted(r[0] for r in rows.select("sample").distinct().collect()))
        return rows.where("x > 0").groupBy("sample").agg(F.sum("x").alias("total"), F.count("*").alias("n"))

    def put(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        return run_new_samples(spark, inbox, out, seen, SCHEMA, work)

    def results():
        return sorted(tuple(r) for r in spark.read.schema("total long, n long, sample string").parquet(out).select("sample", "total", "n").collect())

    put(("a", 1), ("a", 2), ("b", 5), ("none", -1))
    assert run() == 1 and worked == [["a", "b", "none"]]
    assert results() == [("a", 3, 2), ("b", 5, 1)]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "sample=b").iterdir()}
    assert run() == 0 and len(worked) == 1

    # A new sample, and more of one that was there: both are worked on as a whole, b isn't touched.
    put(("c", 7))
    put(("a", 10))
    assert run() == 1 and worked[1:] == [["a", "c"]]
    assert results() == [("a", 13, 3), ("b", 5, 1), ("c", 7, 1)]
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "sample=b").iterdir()}

    # A batch that is repeated leaves the same results; one whose results went away loses its partition.
    batch = spark.read.schema(SCHEMA).parquet(inbox)
    assert results() == sorted(tuple(r) for r in batch.where("x > 0").groupBy("sample").agg(F.sum("x"), F.count("*")).collect())
    run_new_samples(spark, inbox, out, str(tmp_path / "again"), SCHEMA, lambda rows: work(rows).where("sample <> 'c'"))
    assert results() == [("a", 13, 3), ("b", 5, 1)]

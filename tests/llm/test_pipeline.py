"""The pipeline's stages on planted documents, and on empty input."""

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 8)))
    prose = lambda n: " ".join(r.choice(["the", "of", "and"]) if r.random() < 0.3 else word() for _ in range(n))
    items = [(i, prose(40)) for i in range(5)]
    docs = {i: prose(r.randrange(60, 300)) for i in range(120)}
    docs[200], docs[201] = docs[3], docs[3] + " one more"
    docs[300] = prose(20) + " " + items[2][1]
    docs[301] = prose(3000) + " " + items[1][1]
    docs[400], docs[401], docs[402] = "short", None, " ".join(["again and again it goes"] * 30)
    return items, docs


def test_stages(spark, tmp_path):
    items, docs = planted()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, t, "en", f"src{i % 4}" if i % 5 else None, len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        now = spark.read.parquet(str(tmp_path / f"out{k}"))
        kept[name] = {r.doc_id for r in now.collect()}
        if k < 4:
            assert now.dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
    all_ids = set(docs)
    assert kept["quality_rules"] == all_ids - {400, 401, 402}
    assert kept["jaccard_join"] == kept["quality_rules"] - {200, 201}
    assert kept["decontamination"] == kept["jaccard_join"] - {300}
    assert kept["mixing"] == kept["sharding"] == kept["decontamination"]
    # A shard is a stretch of the mixture: the written order, by files and rows, is the order of shards and slots.
    order = [r.doc_id for r in sorted(now.collect(), key=lambda r: (r.shard, r.slot))]
    written = [r.doc_id for r in spark.read.parquet(str(tmp_path / "out3")).selectExpr("doc_id", "_metadata.file_name as f", "_metadata.row_index as i").orderBy("f", "i").collect()]
    assert order == written
    for s in range(8):
        own = [r for r in now.collect() if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == kept["sharding"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

"""Every query and stage on the awkward rows: nulls in any column, empty and very long texts, ties, repeated rows, clashing names, no rows."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from flankspark.llm import queries as llm

QUERIES = llm.queries()
#: Names that operators give to columns of their own, inside or in their results.
CLASHES = [
    *"size shard slot law text_crc32 grown_shard n_shingles component_id component node group id a b u v n sig odd chunk part is_left is_right first".split(),
    *"n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_hit n_items items_sha256 contaminated source_block mix_slot mix_offset mix_place".split(),
    *"spans n_assign n_access n_hex base_sha256 held_out n_tokens n_known train_tokens base_score score host path rule verdict body n_lines rendered".split(),
    *"n_turns turns_sha256 loss_chars loss_sha256 formatted_chars formatted c0 c1 fingerprint fp bits parts asks part own row rank weight n_features bucket at whitened deviation explained identity_error vector i j s d __text __doc __key __tie __id __gone __node __source __crc".split(),
]
KEYS = {"op2_url_filter": "page_id", "op5_html_extraction": "page_id", "op10_chat_formatting": "conv_id", "op12_whitening": "vec_id"}


def awkward():
    r = random.Random(31)
    prose = lambda n: " ".join(r.choice(["the", "of", "and", "is"]) if r.random() < 0.4 else "".join(r.choice("abcdefg") for _ in range(r.randrange(2, 7))) for _ in range(n))
    item = prose(40)
    texts = [prose(120) for _ in range(12)] + [None, "", " \n\t\n", "one", "a b c d", "token = abcdef123456 AKIA" + "A" * 30, prose(30) + " " + item]
    texts += [prose(150_000), "word " * 100_000, "x" * 400_000]
    docs = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    docs += [(None, texts[0], None, None, None), (None, texts[1] + " new", None, None, None), (None, None, None, None, None), (3, prose(100), "en", "s0", 1), *[docs[5]] * 3, *[(50 + k, texts[6], "en", "s1", 2) for k in range(4)]]
    bench = [(0, item), (1, None), (2, ""), (3, "lone words"), (None, texts[7][:300]), (0, item), (4, prose(50_000))]
    page = "<p>text <a href='http://b.example/x'>link</a>" * 20
    pages = [(0, "http://A.Example/en/x?q#f", page), (1, None, page), (2, "no scheme", None), (3, "https://", ""), (None, "http://b.example", page), (0, "http://A.Example/en/x?q#f", page), (4, "http://example.com/en/" + "y" * 300_000, "<div>" * 3000 + "deep" + "<td>cell" * 20_000)]
    talks = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes <|im_end|>"), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (2, None, "user", "x"), (None, 0, "user", "no id"), (3, 0, "assistant", ""), (4, 0, "assistant", "long <| " * 50_000)]
    vectors = [(0, [1.0, 2.0, 0.5]), (1, None), (2, []), (3, [float("nan"), 1.0, 1.0]), (4, [None, 1.0, 1.0]), (None, [0.0, -1.0, 3.0]), (5, [1.0] * 5000), *[(6 + k, [float(k % 4), float(k), -1.0 * k * k]) for k in range(9)], *[(0, [1.0, 2.0, 0.5])] * 2]
    return {"embeddings": (vectors, "vec_id long, embedding array<float>"), "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"), "benchmark": (bench, "item_id long, text string"), "pages": (pages, "page_id long, url string, html string"), "conversations": (talks, "conv_id long, turn long, role string, text string")}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The awkward tables; the same ones with clashing columns; the same ones without rows."""
    plain, wide, bare = (tmp_path_factory.mktemp(n) for n in ("plain", "wide", "bare"))
    for name, (rows, schema) in awkward().items():
        df = spark.createDataFrame(rows, schema).repartition(3)
        df.write.parquet(str(plain / f"{name}.parquet"))
        more = {c: F.lit(f"own {c}") for c in CLASHES if c not in df.columns}
        df.withColumns(more).write.parquet(str(wide / f"{name}.parquet"))
        df.where("false").write.parquet(str(bare / f"{name}.parquet"))
    return str(plain), str(wide), str(bare)


def rows_of(df, without=()):
    columns = sorted(c for c in df.columns if c not in without)
    return sorted((tuple(r) for r in df.select(*[F.col(f"`{c}`").cast("string") for c in columns]).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_awkward_rows(spark, folders, name):
    plain, wide, bare = folders
    source = {"page_id": "pages", "conv_id": "conversations", "vec_id": "embeddings"}.get(KEYS.get(name), "documents")
    own, got = spark.read.parquet(f"{plain}/{source}.parquet"), QUERIES[name](spark, plain)
    key = KEYS.get(name, "doc_id")
    if key == "conv_id":
        assert {r[0] for r in got.select(key).collect()} == {r[0] for r in own.select(key).distinct().collect()} | {-1}
    elif key == "vec_id":
        usable = own.where("size(embedding) = 3 and not exists(embedding, x -> x is null or isnan(x))")
        assert rows_of(got.where("component = 2").select(key)) == rows_of(usable.select(key))
    else:
        assert rows_of(got.select(key)) == rows_of(own.select(key))
    if key == "vec_id":
        whole = [c for c in got.columns if c not in ("whitened", "explained", "identity_error")]
        assert rows_of(got.select(*whole)) == rows_of(QUERIES[name](spark, wide).select(*whole))
    elif name == "op8_lm_scoring":
        # Weights are averaged over partitions, whose rows aren't the same ones.
        assert rows_of(got, ["score"]) == rows_of(QUERIES[name](spark, wide), ["score"])
    elif name == "op1_sharding":
        assert rows_of(got.groupBy("doc_id", "size", "text_crc32").count()) == rows_of(QUERIES[name](spark, wide).groupBy("doc_id", "size", "text_crc32").count())
    else:
        again = QUERIES[name](spark, wide)
        assert sorted(again.columns) == sorted(got.columns)
        assert rows_of(again) == rows_of(got)
    empty = QUERIES[name](spark, bare)
    assert empty.dtypes == got.dtypes
    assert empty.count() == (1 if key == "conv_id" else 0)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_rows(spark, folders, name, stage):
    plain, wide, bare = folders
    docs, more, none = (spark.read.parquet(f"{at}/documents.parquet") for at in folders)
    got, again = stage(spark, docs, plain), stage(spark, more, wide)
    last = name == corpus_pipeline.STAGES[-1][0]
    if last:
        assert rows_of(got.select("doc_id")) == rows_of(docs.select("doc_id")) == rows_of(again.select("doc_id"))
    else:
        assert got.dtypes == docs.dtypes and again.dtypes == more.dtypes
        assert rows_of(again.select(*docs.columns)) == rows_of(got)
        # Every row that a stage keeps is one of its input, as often at most; clashing columns keep their values.
        assert not Counter(rows_of(got)) - Counter(rows_of(docs))
        assert not Counter(rows_of(again)) - Counter(rows_of(more))
    assert stage(spark, none, bare).count() == 0
